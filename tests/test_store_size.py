"""What the store writes follows its rows: few files, keys that follow from texts aren't held, one shuffle of texts."""

import random

from pyspark.sql import functions as F

from retrograph.operators import ngrams, stats
from retrograph.plans import queries
from retrograph.sources.store import RAW, TOTALS, NgramStore

COUNTS = "lang string, corpus string, text string, n int, count bigint, norm_key string"


def some_documents(spark, corpora):
    rnd = random.Random(6)
    rows = [("es", f"c{k % corpora}", " ".join(rnd.choice(["casa", "perro", "azul", "él", "coração", "mesa"]) for _ in range(30))) for k in range(4 * corpora)]
    return spark.createDataFrame(rows, "lang string, corpus string, text string").repartition(4)


def test_files_follow_partitions_and_not_tasks(spark, tmp_path):
    store = NgramStore(spark, str(tmp_path / "s"))
    store.add_documents(some_documents(spark, 30))
    assert len(list((tmp_path / "s" / RAW).rglob("*.parquet"))) == len(store.partitions(RAW)) == 90


def test_keys_that_follow_are_not_written(spark, tmp_path):
    store = NgramStore(spark, str(tmp_path / "s"))
    odd = [("es", "c", "casa", 1, 2, "own key"), ("es", "c", "casa", 1, 5, "casa"), ("es", "c", "él y casa", 2, 1, "elycasa"), ("es", "c", "él", 1, 1, "el")]
    for _ in range(2):
        store.append(spark.createDataFrame(odd, COUNTS))
    held = spark.read.parquet(str(tmp_path / "s" / RAW))
    assert {(r["text"], r["norm_key"]) for r in held.collect()} == {("casa", "own key"), ("casa", None), ("él y casa", "elycasa"), ("él", None)}
    assert {tuple(r) for r in store.raw().collect()} == set(odd)
    assert store.compact("es", "c") == 4
    want = {(*r[:4], 2 * r[4], r[5]) for r in odd}
    assert {tuple(r) for r in store.totals().collect()} == want
    assert {tuple(r) for r in ngrams.totals(store.raw()).collect()} == want


def test_a_store_with_all_keys_is_summed_too(spark, tmp_path):
    """As earlier versions wrote it, next to an append of this one."""
    rows = spark.createDataFrame([("es", "c", "él", 1, 2, "el")], COUNTS)
    rows.write.partitionBy("lang", "corpus", "n").parquet(str(tmp_path / "s" / RAW))
    store = NgramStore(spark, str(tmp_path / "s"))
    store.append(rows)
    assert store.compact("es", "c") == 1
    assert [tuple(r) for r in store.totals().collect()] == [("es", "c", "él", 1, 4, "el")]
    assert store.source("es", "c") == TOTALS


def test_totals_by_text(spark):
    counted = ngrams.count_ngrams(some_documents(spark, 3)).withColumn("corpus", F.lit("all"))
    fast, slow = ngrams.totals_by_text(counted), ngrams.totals(counted)
    assert {tuple(r) for r in fast.collect()} == {tuple(r) for r in slow.collect()}
    assert {tuple(r) for r in stats.stats_by_size(fast, summed=True).collect()} == {tuple(r) for r in stats.stats_by_size(slow, exact=True).collect()}


def test_totals_queries_shuffle_texts_once_more(spark, tmp_path):
    some_documents(spark, 3).withColumnRenamed("corpus", "source").write.parquet(f"{tmp_path}/documents.parquet")
    plan = queries.QUERIES["totals_stats_by_size"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 2 and plan.count("Aggregate") == 1
