import json
import math

import pytest
from pyspark.sql import functions as F

from retrograph import jobs
from retrograph.operators import phrases, plausibility, review
from retrograph.plans.policies import PhrasePolicy
from retrograph.sources import readers


def lines(path):
    return [x for p in sorted(path.glob("part-*")) for x in p.read_text().splitlines()]


@pytest.fixture
def run(spark):
    return lambda *args: jobs.main([str(a) for a in args], spark)


def test_counting_to_phrases(run, spark, tmp_path):
    store = tmp_path / "store"
    (tmp_path / "es").mkdir()
    (tmp_path / "es" / "a.txt").write_text("roda la mesa\nroda otra vez\nsolo\n")
    (tmp_path / "pt.jsonl").write_text(json.dumps({"text": "a dor. a dor"}) + "\n")
    assert run("extract", "--store", store, "--lang", " ES ", "--corpus", "c", "--input", tmp_path / "es", "--limit-docs", 2)["compacted"] > 0
    assert run("extract", "--store", store, "--lang", "pt", "--corpus", "c", "--input", tmp_path / "pt.jsonl", "--no-compact")["compacted"] == 0
    assert run("compact", "--store", store, "--lang", "pt", "--corpus", "c", "--n", 2) == 1
    run("export", "--store", store, "--lang", "es", "--corpus", "c", "--out", tmp_path / "counts", "--n", 1, "--limit", 1)
    assert [x.split("\t")[2:5] for x in lines(tmp_path / "counts")] == [["text", "n", "count"], ["roda", "1", "2"]]
    options = ["--source-lang", "es", "--source-corpus", "c", "--target-lang", "pt", "--target-corpus", "c", "--min-source-count", 1, "--min-target-count", 1]
    run("search", "--store", store, "--out", tmp_path / "pairs", *options)
    assert [(r["source_text"], r["target_text"], r["source_count"]) for r in readers.read_pairs(spark, str(tmp_path / "pairs")).collect()] == [("roda", "a dor", 2)]
    with pytest.raises(Exception, match="(?i)exists"):
        run("search", "--store", store, "--out", tmp_path / "pairs", *options)
    run("search", "--store", store, "--out", tmp_path / "pairs", "--force", *options)
    run("phrases", "--input", tmp_path / "pairs", "--out", tmp_path / "phrases", "--min-source-count", 1, "--min-target-count", 1, "--min-pieces", 1)
    assert [x.split("\t")[:2] for x in lines(tmp_path / "phrases")][1:] == [["roda", "a dor"]]
    run("review", "--input", tmp_path / "pairs", "--out", tmp_path / "seen", "--source-contains", "ROD", "--target-words", tmp_path / "none")
    assert len(lines(tmp_path / "seen")) == 2
    found = run("stats", "--store", store)
    assert {r["table_name"]: r["row_count"] for r in found["tables"].collect()}["ngram_compactions"] == 4
    assert run("delete", "--store", store, "--lang", "pt")["ngram_counts"] > 0
    with pytest.raises(ValueError):
        run("extract", "--store", store, "--lang", " ", "--input", tmp_path / "es")
    with pytest.raises(ValueError):
        run("export", "--store", store, "--lang", "es", "--out", tmp_path / "x", "--min-count", 0)


def test_a_broken_line_is_named(run, tmp_path):
    (tmp_path / "bad.jsonl").write_text('{"text": "uno"}\n{"text": "dos"\n')
    with pytest.raises(ValueError, match="bad.jsonl, line 2"):
        run("extract", "--store", tmp_path / "s", "--lang", "es", "--input", tmp_path / "bad.jsonl")


def test_word_lists(run, spark, tmp_path):
    (tmp_path / "w.txt").write_text("roda\nÁrbol\nador\na\ndor\n")
    run("find", "--source", tmp_path / "w.txt", "--out", tmp_path / "found", "--pieces", 2)
    got = [json.loads(x) for x in lines(tmp_path / "found")]
    assert {"roda": {"1": ["ador"], "2": ["a dor"]}} in got
    keys = [next(iter(x)) for x in got]
    assert keys == sorted(keys)
    (tmp_path / "dicc").write_text("casa casa NCFS000\nla el DA0FS0\nel el DA0MS0\na-b x NCFS000\n")
    run("lexicon", "--dictionary", tmp_path / "dicc", "--out", tmp_path / "lex")
    assert {"casa": ["NOUN"]} in [json.loads(x) for x in lines(tmp_path / "lex")]
    (tmp_path / "l.json").write_text(json.dumps({f: [{"source": "s", "lemma": f, "pos": "P", "tag": t}] for f, t in (("casa", "NCFS000"), ("la", "DA0FS0"), ("el", "DA0MS0"), ("a-b", "NCFS000"))}, indent=1))
    run("candidates", "--lexicon", tmp_path / "l.json", "--pattern", "DXXXXX NCXXXXX", "--filter", "--out", tmp_path / "cand")
    assert lines(tmp_path / "cand") == ["la casa"]
    run("candidates", "--lexicon", tmp_path / "l.json", "--words-only", "--out", tmp_path / "only")
    assert sorted(lines(tmp_path / "only")) == ["a-b", "casa", "el", "la"]
    with pytest.raises(ValueError):
        run("lexicon", "--out", tmp_path / "no")


ARPA = """\\data\\
ngram 1=5
ngram 2=3

\\1-grams:
-1.0 <unk>
-99 <s> -0.5
-0.9 </s>
-0.6 la -0.3
-0.8 casa -0.2

\\2-grams:
-0.2 <s> la
-0.4 la casa
-0.1 casa </s>

\\end\\
"""


def test_plausibility(spark, tmp_path):
    (tmp_path / "m.arpa").write_text(ARPA)
    model = plausibility.ArpaModel(str(tmp_path / "m.arpa"))
    assert model.score("la casa") == pytest.approx(-0.2 - 0.4 - 0.1)
    assert model.score("casa x") == pytest.approx((-0.5 - 0.8) + (-0.2 - 1.0) - 0.9)
    (tmp_path / "empty.arpa").write_text("")
    with pytest.raises(ValueError):
        plausibility.ArpaModel(str(tmp_path / "empty.arpa"))
    scorer = plausibility.arpa_scorer({"es": str(tmp_path / "m.arpa")})
    rows = spark.createDataFrame([("la casa", "es"), ("la casa", "pt"), ("", "es"), (None, "es")], "t string, lang string")
    assert [round(r[0], 6) for r in rows.select(scorer(F.col("t"), F.col("lang"))).collect()] == [-0.35, 0.0, 0.0, 0.0]
    pieces = [(k, s, t, 5.0, 9, 9, 1, 1, s, s[::-1], "es", "pt") for k, (s, t) in enumerate((("la", "al"), ("casa", "asac")))]
    held = spark.createDataFrame(pieces, ", ".join(f"{c} {k}" for c, k in zip(phrases.PIECE, ("bigint", "string", "string", "double", "bigint", "bigint", "int", "int", "string", "string", "string", "string"), strict=True)))
    policy = PhrasePolicy(min_source_count=1, min_target_count=1, plausibility_weight=1.0, collapse_permutations=False)
    got = {r["source_phrase"]: r["source_plausibility"] for r in phrases.generate_phrases(held, policy, scorer=scorer).collect()}
    assert got["la casa"] == pytest.approx(-0.35) and got["casa la"] < got["la casa"]


def test_word_frequencies_that_repeat_count_once(spark):
    pieces = [(0, "la casa", "asac al", 5.0, 9, 9, 2, 2, "lacasa", "asacal", "es", "pt")]
    held = spark.createDataFrame(pieces, ", ".join(f"{c} {k}" for c, k in zip(phrases.PIECE, ("bigint", "string", "string", "double", "bigint", "bigint", "int", "int", "string", "string", "string", "string"), strict=True)))
    policy = PhrasePolicy(min_source_count=1, min_target_count=1, min_pieces=1, max_pieces=1)
    scores = []
    for rows in ([], [("es", "casa", 4.0)], [("es", "casa", 4.0), ("es", "casa", 4.0), ("pt", "casa", 9.0)]):
        zipf = spark.createDataFrame(rows, "lang string, token string, zipf double")
        scores.append(phrases.generate_phrases(held, policy, zipf).first()["phrase_score"])
    assert scores[1] == scores[2] and math.isclose(scores[1] - scores[0], 0.35 * 4.0 / 2, abs_tol=1e-6)


def test_word_views(spark):
    listed = spark.createDataFrame([("b c",), ("zz",), ("a",), ("b",)], "word string")
    assert [r[0] for r in review.in_view_order(listed).collect()] == ["a", "b", "zz", "b c"]
    zipf = spark.createDataFrame([("es", "B", 3.0), ("es", "b", 1.0), ("es", "zz", 2.9), ("pt", "a", 7.0)], "lang string, token string, zipf double")
    assert [r[0] for r in review.common_words(listed, zipf, "es").collect()] == ["b"]
    assert review.common_words(listed, zipf, "es", 0).count() == 4


def test_lists_in_place_and_joined(spark, monkeypatch):
    texts = ["la mar", "de la mar", "lamar", "mar", "a b c", "", None, "la  mar"]
    pairs = spark.createDataFrame([(t, k) for k, t in enumerate(texts)], "source_text string, k int")
    for listed in ([], ["la mar"], ["b", "a b"], ["x", None, "", " la", "la mar ", "mar"], ["a b c", "a b c"]):
        words = spark.createDataFrame([(w,) for w in listed], "word string")
        found = []
        for most in (review.LIST_IN_PLACE, -1):
            with monkeypatch.context() as m:
                m.setattr(review, "LIST_IN_PLACE", most)
                found.append(sorted(r["k"] for r in review.drop_listed(pairs, words, "source").collect()))
        assert found[0] == found[1]
