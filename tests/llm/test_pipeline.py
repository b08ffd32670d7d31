import math
import os
import re
from collections import Counter

import pyarrow as pa
import pytest

import __spark_entry__
import corpus_pipeline
from retrograph.llm import bytescan, quality_classifier, quality_rules, queries

from .test_join_packing import count_tokens, kept_ids
from .test_models import label_frame, labelled


@pytest.fixture
def folder(spark, tmp_path):
    rows, labels = labelled(21, 120)
    rows = [(k, t, "en", "s", len(t)) for k, t in rows]
    rows += [(200 + k, rows[k][1], "en", "s", 1) for k in range(0, 40, 5)] + [(300, None, None, None, None), (301, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    label_frame(spark, labels).write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages_and_result(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "quality rules", "n-gram Jaccard join", "best-fit packing"]
    before = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, before, folder)
        assert after.columns == docs.columns
        rows, left = [(r["doc_id"], r["text"]) for r in before.collect()], [r["doc_id"] for r in after.collect()]
        assert set(left) <= {i for i, _ in rows}
        if k == 2:
            assert sorted([False, i] for i in left) == kept_ids(rows)
        else:
            assert len(left) < len(rows) or k == 1
        before = spark.createDataFrame(after.collect(), docs.schema)
    packed = corpus_pipeline.run(spark, folder).collect()
    want = {r["doc_id"]: count_tokens(r["text"]) for r in before.collect() if count_tokens(r["text"])}
    got: dict = {}
    for b in packed:
        for i, n in zip(b["doc_ids"], b["lengths"], strict=True):
            got[i] = got.get(i, 0) + n
    assert got == want


def slow_quality(text, model):
    total, n = 0.0, 0
    raw, at = bytescan.text_bytes(pa.array([text], pa.string()))
    for idx, _ in quality_classifier._families(raw, at):
        total += sum(float(model.table[i]) for i in idx.ravel())
        n += idx.size
    return 1 / (1 + math.exp(-(total / max(n, 1) + model.bias)))


def slow_rules(rows, labels):
    """Log ratios, thresholds and decisions from dictionaries of tokens, written out."""
    least = {}
    for i, q, *_ in labels:
        least[i] = min(q, least.get(i, 1))
    trusted = {i for i, q in least.items() if q == 1}
    token = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\t\n\x0b\x0c\r ]+")

    def grams(t):
        w = token.findall((t or "").encode())
        w = [b"<again>" if k and w[k] == w[k - 1] else w[k] for k in range(len(w))]
        return [(x,) for x in w] + list(zip(w, w[1:], strict=False))

    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if i in trusted:
            target.update(grams(t))
    share = quality_rules.PRIOR_SHARE
    ratio = {g: math.log(((target[g] / target.total()) / (n / raw.total()) + share) / (1 + share)) for g, n in raw.items()}
    return [sum(ratio[g] for g in grams(t)) / max(len(grams(t)), 1) for _, t in rows]


def test_run_against_a_slow_version(spark, tmp_path):
    rows, labels = labelled(31, 90)
    rows += [(500 + k, rows[k][1]) for k in range(0, 30, 6)] + [(None, rows[2][1]), (600, rows[3][1] + " tail"), (rows[4][0], "another text of a known document"), (700, None), (701, ""), rows[7]]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 2) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, quality string, bin_id int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    label_frame(spark, [*labels, (9999, 1, 0, "")]).write.parquet(str(tmp_path / "labels.parquet"))
    folder = str(tmp_path)
    known = label_frame(spark, labels)
    frame = docs.select(*corpus_pipeline.COLUMNS)
    model = quality_classifier.fit_quality(frame, known)
    left = [(i, t) for i, t in rows if slow_quality(t, model) >= model.threshold]
    first = corpus_pipeline.classify(spark, frame, folder)
    assert sorted(map(str, left)) == sorted(str((r["doc_id"], r["text"])) for r in first.collect())
    limit = quality_rules.fit_rules(first, known, quality_rules.PRIOR_SHARE).threshold
    scores = slow_rules(left, labels)
    assert min(abs(s - limit) for s in scores) > 1e-5
    left = [r for r, s in zip(left, scores, strict=True) if s >= limit]
    kept = {tuple(x) for x in kept_ids([r for r in left if r[1]])}
    want = Counter()
    for i, t in left:
        if t and (i is None, i or 0) in kept:
            want[i is None, i or 0] = max(want[i is None, i or 0], count_tokens(t))
    got = Counter()
    for b in corpus_pipeline.run(spark, folder).collect():
        for i, n in zip(b["doc_ids"], b["lengths"], strict=True):
            got[i is None, i or 0] += n
    assert set(got) == set(want)


def test_empty_tables(spark, tmp_path):
    rows, labels = labelled(5, 20)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    label_frame(spark, labels).write.parquet(str(tmp_path / "a" / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "a")).collect() == []
    spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], schema).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    label_frame(spark, []).write.parquet(str(tmp_path / "b" / "labels.parquet"))
    ids = sorted(i for b in corpus_pipeline.run(spark, str(tmp_path / "b")).collect() for i in set(b["doc_ids"]))
    assert sorted(set(ids)) == [i for _, i in kept_ids(rows)]


def test_registry():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no tables")
@pytest.mark.parametrize("name", ["op2_chat_formatting", "op5_ngram_jaccard_join"])
def test_sql_gives_the_same_rows(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    found = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001").select(*columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, found.fetchall()))
