"""Exact cosine search over embeddings, and a place for encoders that make them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries that are broadcast at once, and vectors compared with them at once.
QUERY_BLOCK = 16_384
_ROWS = 2048


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector has no length."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def _matrix(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lists of that many numbers that have a length, and their directions."""
    lists = column.cast(pa.list_(pa.float64()))
    whole = np.asarray(lists.value_lengths().fill_null(-1)) == size
    at = np.flatnonzero(whole)
    values = lists.take(pa.array(at)).flatten()
    rows = np.asarray(values.fill_null(np.nan), dtype=np.float64).reshape(len(at), size)
    norm = np.sqrt((rows * rows).sum(1))
    good = np.isfinite(norm) & (norm > 0)
    return at[good], rows[good] / norm[good, None]


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """query_id, vec_id, similarity, rank of the k vectors most like each query; ties (to 9 digits) by vec_id.

    Every vector is compared with every query, in blocks: at most ``QUERY_BLOCK``
    queries are broadcast at a time as a matrix, tasks multiply it with theirs
    and keep each query's best k, and only these are shuffled.  Vectors that are
    null, hold a null, have no length, or another size than the queries, have no
    similarity.  Both ids are whole numbers.
    """
    spark = vectors.sparkSession
    queries = queries.select(F.col("query_id").cast("bigint").alias("query_id"), "embedding").where("query_id is not null and embedding is not null")
    vectors = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where("vec_id is not null")
    schema = "query_id bigint, vec_id bigint, similarity double"
    blocks = max(1, -(-queries.count() // QUERY_BLOCK) * 5 // 4)  # a hash fills blocks unevenly
    best = None
    for block in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).toArrow()
        embedding = own["embedding"].combine_chunks()
        for size in np.unique(np.asarray(embedding.value_lengths(), dtype=np.int64)):
            at, unit = _matrix(embedding, int(size))
            if not len(at):
                continue
            shared = spark.sparkContext.broadcast((np.asarray(own["query_id"])[at], unit))

            def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                ids, unit = shared.value
                found = np.full((len(ids), 0), -np.inf), np.zeros((len(ids), 0), np.int64)
                for batch in batches:
                    for s in range(0, batch.num_rows, _ROWS):
                        part = batch.slice(s, _ROWS)
                        at, rows = _matrix(part.column(1), unit.shape[1])
                        if not len(at):
                            continue
                        value = np.concatenate((found[0], np.round(unit @ rows.T, 9)), axis=1)
                        name = np.concatenate((found[1], np.broadcast_to(np.asarray(part.column(0))[at], (len(ids), len(at)))), axis=1)
                        order = np.lexsort((name, -value), axis=1)[:, :k]
                        found = np.take_along_axis(value, order, 1), np.take_along_axis(name, order, 1)
                value, name = found
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, value.shape[1])), pa.array(name.ravel()), pa.array(value.ravel())], ["query_id", "vec_id", "similarity"])

            rows = vectors.mapInArrow(run, schema)
            best = rows if best is None else best.union(rows)
    if best is None:
        best = spark.createDataFrame([], schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).withColumn("similarity", F.round("similarity", 6))


#: Turns a batch of texts into as many vectors.
Encode = Callable[[list[str]], np.ndarray]


def encode(words: DataFrame, load: Callable[[], Encode], batch: int = 1024, prefix: str = "") -> DataFrame:
    """word, embedding of every distinct word that isn't blank.

    ``load`` runs once in each task and gives the function that encodes; models
    that tell passages from queries get what they expect by ``prefix``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for rows in batches:
            texts = rows.column(0).to_pylist()
            for s in range(0, len(texts), batch):
                model = model or load()
                part = texts[s : s + batch]
                out = np.asarray(model([prefix + t for t in part]), np.float32)
                if out.shape[:1] != (len(part),):
                    raise ValueError("the encoder must give one vector for each text")
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array(list(out), pa.list_(pa.float32()))], ["word", "embedding"])

    return words.select("word").where("trim(word) <> ''").distinct().mapInArrow(run, "word string, embedding array<float>")
