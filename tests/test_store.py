import pytest

from retrograph.operators import ngrams, stats
from retrograph.plans.policies import ExportPolicy, NgramPolicy, SearchPolicy
from retrograph.sources.store import MARKS, RAW, TOTALS, NgramStore
from retrograph.streaming.ingest import count_stream, document_stream

SCHEMA = "lang string, corpus string, text string, n int, count bigint, norm_key string"


def rows(spark, *items, lang="es", corpus="test"):
    return spark.createDataFrame([(lang, corpus, t, len(t.split()), c, t.replace(" ", "")) for t, c in items], SCHEMA)


@pytest.fixture
def store(spark, tmp_path):
    return NgramStore(spark, str(tmp_path / "store"))


def exported(store, *args, **kw):
    return [(r["text"], r["count"]) for r in store.export(*args, **kw).collect()]


def test_partial_counts_are_summed(spark, store):
    assert store.append(rows(spark, ("la casa", 2))) == 1
    store.append(rows(spark, ("la casa", 3), ("casa", 7)))
    assert exported(store, "es", "test") == [("casa", 7), ("la casa", 5)]
    assert exported(store, "es", "test", ExportPolicy(limit=1, n=2)) == [("la casa", 5)]
    assert store.compact("es", "test", 2) == 1
    assert store.source("es", "test", 2) == TOTALS
    assert store.source("es", "test") == RAW  # n = 1 isn't compacted
    assert exported(store, "es", "test", ExportPolicy(n=2)) == [("la casa", 5)]


def test_export_filters(spark, store):
    store.append(rows(spark, ("casa", 10), ("la casa", 9), ("el largo camino", 8)))
    assert exported(store, "es", "test", ExportPolicy(n=2, min_norm_len=5, max_norm_len=8)) == [("la casa", 9)]


def test_append_invalidates(spark, store):
    store.append(rows(spark, ("casa", 2)))
    store.compact("es", "test", 1)
    store.append(rows(spark, ("casa", 3)))
    assert store.marks().count() == store.totals().count() == 0
    assert exported(store, "es", "test") == [("casa", 5)]


def test_compact_all_sizes_in_one_job(spark, store):
    store.append(rows(spark, ("casa", 2), ("la casa", 3), ("la casa azul", 4)))
    assert store.compact("es", "test") == 3
    assert {r["n"] for r in store.marks().collect()} == {1, 2, 3}
    assert store.source("es", "test") == TOTALS
    assert store.compact("es", "test") == 3  # again: the same
    assert store.totals().count() == 3


def test_delete(spark, store):
    store.append(rows(spark, ("casa", 2)))
    store.compact("es", "test")
    store.append(rows(spark, ("house", 4), lang="en"))
    assert sum(store.delete("es").values()) == 3
    assert [r["text"] for r in store.raw().collect()] == ["house"]
    assert store.delete("fr") == {RAW: 0, TOTALS: 0, MARKS: 0}


def test_statistics(spark, store):
    store.append(rows(spark, ("casa", 2)))
    store.compact("es", "test")
    store.append(rows(spark, ("house", 4), lang="en"))
    s = store.statistics(lang="fr", exact=True)
    assert [r["row_count"] for r in s["tables"].collect()] == [2, 1, 1]
    assert [r["row_count"] for r in s["tables_filtered"].collect()] == [0, 0, 0]
    assert {(r["lang"], r["occurrences"], r["distinct_texts"]) for r in s["by_corpus"].collect()} == {("es", 2, 1), ("en", 4, 1)}
    assert {(r["lang"], r["total_rows"], r["compacted_at"] is None) for r in s["compaction"].collect()} == {("es", 1, False), ("en", 0, True)}
    assert s["top"].first()["text"] == "house"
    assert stats.stats_by_corpus(store.raw()).count() == 2


def test_documents_accumulate_and_reset(spark, store):
    docs = spark.createDataFrame([("es", "c", "La casa. La casa.")], "lang string, corpus string, text string")
    store.add_documents(docs, NgramPolicy(max_n=2))
    assert exported(store, "es", "c", ExportPolicy(n=2)) == [("la casa", 2)]
    store.add_documents(docs, NgramPolicy(max_n=2))
    assert exported(store, "es", "c", ExportPolicy(n=2)) == [("la casa", 4)]
    store.add_documents(docs, NgramPolicy(max_n=2), reset=True)
    assert exported(store, "es", "c", ExportPolicy(n=2)) == [("la casa", 2)]


def test_odd_partition_values(spark, store):
    store.append(rows(spark, ("casa", 2), corpus="2020/a b=c"))
    assert store.compact("es", "2020/a b=c") == 1
    assert exported(store, "es", "2020/a b=c") == [("casa", 2)]


def test_empty_store(spark, store):
    assert store.raw().count() == 0
    assert store.compact("es", "c") == 0
    assert exported(store, "es", "c") == []


POLICY = dict(source_lang="es", source_corpus="wiki", target_lang="pt", target_corpus="wiki")


def fill(spark, store, es, pt):
    store.append(rows(spark, *es, corpus="wiki"))
    store.append(rows(spark, *pt, lang="pt", corpus="wiki"))


def test_search(spark, store):
    fill(spark, store, [("roda", 5), ("casa", 10)], [("a dor", 7), ("mesa", 8)])
    got = store.search(SearchPolicy(**POLICY, min_source_count=1, min_target_count=1)).collect()
    assert [(r["source_text"], r["target_text"]) for r in got] == [("roda", "a dor")]
    assert got[0]["pair_score"] == round(1.791759469228055 + 2.0794415416798357, 6)
    assert len(got[0]) == 13


def test_search_sums_partial_counts(spark, store):
    fill(spark, store, [("roda", 2)], [("a dor", 4)])
    store.append(rows(spark, ("roda", 3), corpus="wiki"))
    got = store.search(SearchPolicy(**POLICY, min_source_count=5, min_target_count=4)).first()
    assert (got["source_count"], got["target_count"]) == (5, 4)


def test_search_compacted(spark, store):
    fill(spark, store, [("roda", 5), ("la casa", 10)], [("a dor", 7), ("mesa", 8)])
    policy = SearchPolicy(**POLICY, counts_source="compact", source_n=1, target_n=2, min_norm_len=4, max_norm_len=4)
    store.compact("es", "wiki")
    with pytest.raises(RuntimeError, match="No compacted target counts found"):
        store.search(policy)
    store.compact("pt", "wiki")
    assert [(r["source_text"], r["target_text"]) for r in store.search(policy).collect()] == [("roda", "a dor")]
    with pytest.raises(RuntimeError, match="No source counts found"):
        store.search(SearchPolicy(**POLICY | {"source_lang": "xx"}, counts_source="compact"))


def test_palindromes_and_identical_texts(spark, store):
    store.append(rows(spark, ("ana", 3), ("roda", 3), ("ador", 3), corpus="wiki"))
    base = dict(source_lang="es", source_corpus="wiki", target_lang="es", target_corpus="wiki")
    pick = lambda **kw: {(r["source_text"], r["target_text"]) for r in store.search(SearchPolicy(**base, **kw)).collect()}
    assert pick() == {("roda", "ador"), ("ador", "roda")}
    assert pick(include_palindromes=True) == {("roda", "ador"), ("ador", "roda")}
    assert pick(include_palindromes=True, include_identical_text=True) == {("roda", "ador"), ("ador", "roda"), ("ana", "ana")}


def test_partition_filters_reach_the_scan(spark, store):
    store.append(rows(spark, ("casa", 2), ("la casa", 2)))
    plan = ngrams.select_counts(store.raw(), lang="es", corpus="test", n=2)._jdf.queryExecution().toString()
    filters = plan[plan.rindex("PartitionFilters: [") :].split("]")[0]
    assert all(f"isnotnull({c}#" in filters for c in ("lang", "corpus", "n"))


class Stop(Exception):
    pass


@pytest.mark.parametrize("where", ["_stage", "invalidate", "_move", "_move_half"])
def test_a_batch_that_breaks_off_is_added_once(spark, store, monkeypatch, where):
    store.append(rows(spark, ("casa", 1), ("la casa", 1)))
    store.compact("es", "test")
    counts = rows(spark, ("casa", 2), ("la casa", 3), ("la casa azul", 4))
    with monkeypatch.context() as m:

        def stop(*args):
            raise Stop

        if where == "_move_half":  # some files are moved, others aren't

            def half(stage, table):
                for (_, _, n), path in store.partitions(stage).items():
                    if n == 1:
                        target = store._path(f"{store.root}/{table}/{path.split(f'{stage}/', 1)[1]}")
                        for status in store._fs.listStatus(store._path(path)):
                            assert store._fs.rename(status.getPath(), store._path(target, status.getPath().getName()))
                raise Stop

            m.setattr(store, "_move", half)
        else:
            m.setattr(store, where, stop)
        with pytest.raises(Stop):
            store.append(counts, "b-1")
    for _ in range(2):
        store.append(counts, "b-1")
    assert dict(exported(store, "es", "test")) == {"casa": 3, "la casa": 4, "la casa azul": 4}
    assert store.source("es", "test", 1) == RAW
    store.append(counts, "b-2")
    assert dict(exported(store, "es", "test"))["casa"] == 5


def test_compaction_that_breaks_off_leaves_no_mark(spark, store, monkeypatch):
    store.append(rows(spark, ("casa", 2)))
    store.compact("es", "test")
    store.append(rows(spark, ("casa", 3)))
    for where in ("_stage", "invalidate", "_move"):
        with monkeypatch.context() as m:
            m.setattr(store, where, lambda *a: (_ for _ in ()).throw(Stop))
            with pytest.raises(Stop):
                store.compact("es", "test")
        assert exported(store, "es", "test") == [("casa", 5)]
        assert store.search(SearchPolicy("es", "test", "es", "test", 1, 1, source_n=1, target_n=1, include_palindromes=True)).count() == 0
    store.compact("es", "test")
    assert store.source("es", "test", 1) == TOTALS and exported(store, "es", "test") == [("casa", 5)]


def test_append_reads_only_its_own_rows(spark, store, monkeypatch):
    store.append(rows(spark, ("casa", 2), lang="en"))
    read = []
    table = store._table
    monkeypatch.setattr(store, "_table", lambda name: read.append(name) or table(name))
    store.append(rows(spark, ("casa", 2)))
    assert all(name.startswith("_staging/") for name in read)


def test_stream_adds_each_file_once(spark, store, tmp_path):
    folder, state = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()
    (folder / "a.txt").write_text("La casa azul\n\n# no\n")
    for text in (None, "La casa\n", None):
        if text:
            (folder / "b.txt").write_text(text)
        count_stream(document_stream(spark, str(folder), "es", "c"), store, state, NgramPolicy(max_n=2)).awaitTermination()
    assert dict(exported(store, "es", "c", ExportPolicy(n=2))) == {"la casa": 2, "casa azul": 1}
