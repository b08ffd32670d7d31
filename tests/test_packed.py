import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from retrograph.operators import ngrams, packed, pairs
from retrograph.plans import queries
from retrograph.plans.policies import NgramPolicy

SCHEMA = "lang string, corpus string, text string"


def batches(chunks):
    """Arrow batches of three chunks."""
    for i in range(0, len(chunks), 3):
        lang, corpus, tokens = zip(*chunks[i : i + 3], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(corpus, pa.string()), pa.array(tokens, pa.list_(pa.string()))], ["lang", "corpus", "tokens"])


@pytest.mark.parametrize("flush, held, buckets", [(7, 5, 3), (10**6, 10**6, 1), (50, 4, 2)])
def test_sums_of_small_parts_and_passes(monkeypatch, flush, held, buckets):
    """However a mapper's words and a bucket's blocks are divided, the counts are those of plain Python."""
    monkeypatch.setattr(packed, "FLUSH", flush)
    monkeypatch.setattr(packed, "HELD", held)
    rnd = random.Random(3)
    words = ["casa", "él", "a", "x", "coração", "ŝino", "de", "la", "z" * 31]
    chunks = [(rnd.choice(["es", "fr", None]), rnd.choice(["p", None]), [rnd.choice(words) for _ in range(rnd.randint(0, 9))]) for _ in range(60)]
    want = Counter()
    for lang, corpus, tokens in chunks:
        for n in (1, 2, 3):
            for i in range(len(tokens) - n + 1):
                w = tokens[i : i + n]
                good = all(len(t) <= 30 and (len(t) > 1 or (t == "a" and lang in ("es", "fr"))) for t in w)
                stop = lang is not None and all(t in ("él", "a", "de", "la") and not (t, lang) in (("él", "fr"), ("a", "fr")) for t in w)
                if good and not stop and len("".join(w)) >= 3:
                    want[lang, corpus, " ".join(w)] += 1
    found = pa.Table.from_batches(list(packed.blocks(NgramPolicy(), buckets)(batches(chunks))))
    got = Counter()
    for b in set(found.column("bucket").to_pylist()):
        for r in packed.unite(found.filter(pa.compute.equal(found.column("bucket"), b))).to_pylist():
            assert (r["lang"], r["corpus"], r["text"]) not in got  # a text is in one bucket and one pass
            got[r["lang"], r["corpus"], r["text"]] = r["count"]
    assert got == want


def test_many_words_do_not_run_over(monkeypatch):
    """Numbers of trigrams that don't fit an integer are made dense first."""
    real = packed.Words

    class Many(real):
        def __init__(self, table):
            super().__init__(table)
            self.words = pa.concat_arrays([self.words, pa.array([f"zz{i}" for i in range(3_000_000)], pa.string())])
            self.length = packed.pc.utf8_length(self.words).to_numpy()

    monkeypatch.setattr(packed, "Words", Many)
    table = pa.Table.from_batches(list(batches([("xx", "c", ["uno", "dos", "tres", "uno", "dos", "tres"])])))
    found = {n: (words, counts) for n, (_, words, counts) in enumerate(packed.windows(Many(table), NgramPolicy(), None), 1)}
    assert sorted(found[3][1].tolist()) == [1, 1, 2] and len(found[3][0]) == 3


def test_counting_shuffles_blocks(spark):
    docs = spark.createDataFrame([("es", "c", "la casa azul y el perro. la casa azul")], SCHEMA)
    plan = ngrams.count_ngrams(docs)._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "FlatMapGroupsInArrow" in physical and "HashAggregate" not in physical


def test_pairs_count_only_what_can_be_in_pairs(spark):
    rnd = random.Random(4)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9)))
    docs = [(lang, "c", " ".join(word(letters) for _ in range(40)) + extra) for lang, letters, extra in [("es", "abcdef", ". la coracao amor"), ("en", "uvwxyz", ". roma o acaroc al"), ("fr", "abc", "")] * 5]
    frame = spark.createDataFrame(docs, SCHEMA)
    whole = ngrams.count_ngrams(frame)
    some = ngrams.count_pairable(frame, "es", "en")
    held, every = {tuple(r) for r in some.collect()}, {tuple(r) for r in whole.collect()}
    assert held <= every and len(held) < 0.2 * len(every)
    for a, b in (("es", "en"), ("en", "es"), ("es", "es"), ("fr", "fr"), ("es", "xx")):
        found = [{tuple(r) for r in pairs.reverse_pairs(*(c.where(F.col("lang") == x) for x in (a, b)), palindromes=True, identical=True).collect()} for c in (ngrams.count_pairable(frame, a, b), whole)]
        assert found[0] == found[1]
        assert found[1] or b == "xx"


def test_pair_queries_count_with_the_filter(spark, tmp_path):
    rows = [("en", "s", "saw the live drab rats."), ("fr", "s", "was evil star bard.")]
    spark.createDataFrame(rows, "lang string, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["reverse_pairs_en_fr"](spark, str(tmp_path))
    assert ("saw", "was") in {(r["source_text"], r["target_text"]) for r in got.collect()}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") >= 1
