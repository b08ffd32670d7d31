import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from retrograph.functions import text as T
from retrograph.operators import ngrams
from retrograph.plans.policies import ExportPolicy, NgramPolicy, PhrasePolicy, SearchPolicy


def column(spark, texts, expression):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, x string")
    return [r[1] for r in rows.select("k", expression(F.col("x"))).orderBy("k").collect()]


def plain_clean(text):
    """The cleaning rules in plain Python."""

    def rest(m):
        url = m.group(0)
        kept = url.rstrip(".!?;:…")
        return f" {url[len(kept):]} "

    text = re.sub(r"https?://\S+|www\.\S+", rest, text)
    text = re.sub(r"\[\[?[^\]\n]+\]?\]|\{\{[^}\n]+\}\}", " ", text)
    return re.sub(r"\s+", " ", text).strip()


def test_clean_against_plain_python(spark):
    rnd = random.Random(5)
    parts = ["http://", "https://a.b", "www.", "www.x", "[[", "]]", "[", "]", "{{", "}}", ".", "!", "…", ":", " ", "\n", " ", "\x1d", "a", "é", "#", "http:/"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(1500)]
    assert column(spark, texts, T.clean) == [plain_clean(t) for t in texts]


def test_keys(spark):
    texts = ["coração", "À dor", "ñandú ÑU", "å š ç ő", "a b\tc", ""]
    assert column(spark, texts, T.norm_key) == ["coracao", "ador", "nandunu", "åšcő", "abc", ""]
    assert column(spark, texts, lambda x: T.norm_key(x, fold_nasal_letters=True)) == column(spark, texts, T.norm_key)


def test_accents_follow_the_definition(spark):
    letters = [chr(c) for c in range(0xC0, 0x180) if chr(c) not in "×÷"]
    want = [unicodedata.normalize("NFC", "".join(m for m in unicodedata.normalize("NFD", c) if m not in "́̀̂̃̈")) for c in letters]
    assert column(spark, letters, T.strip_accents) == want
    assert column(spark, [*letters, "ấ", None], T.strip_accents_general) == [*want, "a", None]


def tokens(spark, text, lang="es"):
    docs = spark.createDataFrame([(lang, "c", text)], "lang string, corpus string, text string")
    return [r["tokens"] for r in ngrams.token_rows(docs).collect()]


@pytest.mark.parametrize(
    "text, want",
    [
        ("La casa. El camino", [["la", "casa"], ["el", "camino"]]),
        ("A casa {{marca}} https://example.com. O caminho [[nota]]", [["a", "casa"], ["o", "caminho"]]),
        ("# title. not counted", []),
        ("one\ntwo, three-four", [["one", "two", "three", "four"]]),
        ("éa 12 b", [["e", "a", "b"]]),
        ("...", []),
        ("", []),
    ],
)
def test_tokens(spark, text, want):
    assert tokens(spark, text) == want


def test_null_text_has_no_chunks(spark):
    assert tokens(spark, None) == []


@pytest.mark.parametrize("lang, words, want", [("en", ["the", "and"], True), ("fr", ["de", "la"], True), ("gl", ["de", "a"], True), ("fr", ["à", "la"], False), ("es", ["él"], True), ("de", ["der"], False)])
def test_all_stopwords(spark, lang, words, want):
    rows = spark.createDataFrame([(lang, words)], "lang string, w array<string>")
    assert rows.select(ngrams.all_stopwords(F.col("w"), F.col("lang"))).first()[0] is want


def brute_counts(docs, max_n=3, stopwords=True):
    from collections import Counter

    from retrograph.functions import lang as L

    strip = lambda t: unicodedata.normalize("NFC", "".join(m for m in unicodedata.normalize("NFD", t) if m not in "́̀̂̃̈"))
    out = Counter()
    for lang, corpus, text in docs:
        cleaned = plain_clean(text)
        if cleaned.startswith("#"):
            continue
        for chunk in re.split(r"[.!?;:¡¿…]+", cleaned):
            words = re.findall("[A-Za-zÀ-ÖØ-öø-ÿĀ-ſ]+", chunk.lower())
            for n in range(1, max_n + 1):
                for i in range(len(words) - n + 1):
                    w = words[i : i + n]
                    if any(len(t) > 30 or (len(t) < 2 and strip(t) not in L.ONE_LETTER.get(lang, ())) for t in w):
                        continue
                    key = strip("".join(w)).replace("ç", "c")
                    if len(key) < 3 or (stopwords and all(strip(t) in L.STOPWORDS.get(lang, ()) for t in w)):
                        continue
                    out[lang, corpus, " ".join(w), n, key] += 1
    return out


def test_counts_against_plain_python(spark):
    rnd = random.Random(2)
    words = ["la", "casa", "à", "dor", "El", "a", "i", "x", "camiño", "y", "the", "saw", "coração", "z" * 30, "z" * 31, ".", "#", "12", "https://u.v.", "[[n]]", "ŝ", "de"]
    docs = [(rnd.choice(["es", "en", "fr", "de", "gl", "pt"]), rnd.choice("pq"), " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 25)))) for _ in range(120)]
    frame = spark.createDataFrame(docs, "lang string, corpus string, text string")
    for stop in (True, False):
        got = ngrams.count_ngrams(frame, NgramPolicy(include_all_stopword_ngrams=not stop)).collect()
        assert {(r["lang"], r["corpus"], r["text"], r["n"], r["norm_key"]): r["count"] for r in got} == dict(brute_counts(docs, stopwords=stop))


def test_plan_reads_two_columns_and_shuffles_once(spark, tmp_path):
    spark.createDataFrame([("es", "c", "la casa", 1)], "lang string, corpus string, text string, other int").write.parquet(str(tmp_path / "d"))
    counted = ngrams.count_ngrams(spark.read.parquet(str(tmp_path / "d")))
    plan = counted._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Exchange hashpartitioning") == 1
    assert "other" not in physical
    assert physical.count("regexp_extract_all") == 1


def test_score(spark):
    rows = spark.createDataFrame([("es", "a la casa", 9), ("es", "el", 0), ("es", "camino", 2)], "lang string, t string, c bigint")
    got = [r[0] for r in rows.select(ngrams.ngram_score(F.split("t", " "), F.col("c"), F.col("lang"))).collect()]
    assert got == [round(2.302585093 - 0.5 - 0.25 + 0.2, 6), -0.75, round(1.0986122887 + 0.2, 6)]


@pytest.mark.parametrize(
    "make",
    [
        lambda: NgramPolicy(max_n=4),
        lambda: NgramPolicy(min_token_len=5, max_token_len=4),
        lambda: ExportPolicy(min_count=0),
        lambda: ExportPolicy(min_norm_len=9, max_norm_len=3),
        lambda: SearchPolicy("es", "c", "pt", "c", counts_source="other"),
        lambda: PhrasePolicy(min_pieces=3, max_pieces=2),
    ],
)
def test_policies_refuse(make):
    with pytest.raises(ValueError):
        make()
