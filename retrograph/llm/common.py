"""What the operators of this subpackage share: input columns, written tables, labelled samples."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose workers don't see that path the package comes with
    ``--py-files`` and this changes nothing.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; where none is set, a local one is made if everything runs in one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        held = spark.sparkContext.getCheckpointDir()
        if held:
            return held
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="retrograph-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a table into the shared folder and read it again: lineage ends there and nothing is computed twice.  Also its path."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, label: str) -> DataFrame:
    """A table that stays in the shared folder, as the result is read from it."""
    return stored(df, label)[0]


def dropped(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that nothing reads any more."""
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]], schema: str | StructType) -> DataFrame:
    """mapInArrow with a function that is made once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield from step(batch)

    prepare(df.sparkSession)
    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, text: str, make: Callable[[], Callable[[pa.Array], np.ndarray]]) -> DataFrame:
    """The rows, with all their columns, for whose text the function gives True."""

    def maker():
        decide = make()

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            yield batch.filter(pa.array(decide(batch.column(batch.schema.names.index(text)))))

        return step

    return map_arrow(df, maker, df.schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, seed: int = 7, share: float = 0.5) -> tuple[pa.Array, np.ndarray]:
    """Texts and 0/1 labels of at most ``limit`` labelled documents, ``share`` of them of class 1 where there are so many.

    Of the labelled doc_ids that have a document, those with the least hash are
    taken, so the sample does not depend on partitioning.  Repeated label rows
    of a document count once, with the smaller label, and repeated documents
    with the least text.  Only this bounded sample reaches the driver.
    """
    known = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__y")).where("__id is not null and __y in (0, 1)")
    known = known.groupBy("__id").agg(F.min("__y").alias("__y"))
    texts = docs.select(F.col("doc_id").alias("__doc"), F.col("text").alias("__text"))
    known = known.join(texts.select("__doc"), F.col("__id") == F.col("__doc"), "left_semi")
    order = F.xxhash64("__id", F.lit(seed))
    picked = None
    for y in (0, 1):
        part = known.where(F.col("__y") == y).orderBy(order, "__id").limit(round(limit * (share if y else 1 - share)))
        picked = part if picked is None else picked.union(part)
    rows = texts.join(F.broadcast(picked), F.col("__doc") == F.col("__id")).groupBy("__id").agg(F.min("__text").alias("__text"), F.first("__y").alias("__y")).toArrow()
    rows = rows.sort_by("__id")
    text = rows["__text"].combine_chunks()
    if isinstance(text, pa.ChunkedArray):
        text = text.chunk(0) if text.num_chunks else pa.array([], pa.string())
    return text, rows["__y"].to_numpy().astype(np.int64)
