"""The folder that all executors share, and cutting of lineage there."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; on a cluster it may come with ``--py-files``."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where none is set, a local one if everything runs in one process."""
    held = spark.sparkContext.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or held
    if not named:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="retrograph-")
    if not held:
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
