"""Counts of documents that arrive in a folder, added to the store batch by batch."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.policies import NgramPolicy
from ..sources.store import NgramStore


def document_stream(spark: SparkSession, path: str, lang: str, corpus: str, fmt: str = "txt", field: str = "text", files_per_trigger: int = 1000) -> DataFrame:
    """lang, corpus, text of new files, as a stream."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", True)
    rows = reader.text(path).select(F.col("value").alias("text")) if fmt == "txt" else reader.schema(f"`{field}` string").option("mode", "FAILFAST").json(path).select(F.col(f"`{field}`").alias("text")).where("text <> ''")
    return rows.select(F.lit(lang).alias("lang"), F.lit(corpus).alias("corpus"), "text")


def count_stream(docs: DataFrame, store: NgramStore, checkpoint: str, policy: NgramPolicy = NgramPolicy()) -> StreamingQuery:
    """Add what has arrived to the store, then stop.

    Batches have names, from the checkpoint's and their number.  One that is run
    again after a failure goes on where the store had got to with it, so it is
    counted once wherever the failure was.
    """
    name = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def add(batch: DataFrame, number: int) -> None:
        store.add_documents(batch, policy, batch=f"{name}-{number}")

    return docs.writeStream.foreachBatch(add).option("checkpointLocation", f"{checkpoint.rstrip('/')}/state").trigger(availableNow=True).start()
