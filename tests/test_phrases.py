import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from retrograph.functions import lang as L
from retrograph.operators import pairs, phrases, review
from retrograph.plans.policies import PhrasePolicy, ReviewPolicy

SCHEMA = "id bigint, source_text string, target_text string, pair_score double, source_count bigint, target_count bigint, source_n int, target_n int, source_norm_key string, target_norm_key string, source_lang string, target_lang string"


def piece(k, s, t, score=5.0, sc=200, tc=300, langs=("es", "pt")):
    return (k, s, t, score, sc, tc, len(s.split()), len(t.split()), s.replace(" ", ""), t.replace(" ", ""), *langs)


BASE = [piece(0, "se le", "eles"), piece(1, "no se", "e son"), piece(2, "roma", "amor"), piece(3, "amor", "roma"), piece(4, "aires", "seria")]


def brute(rows, p):
    """The beam search in plain Python."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    items = [dict(zip(names, r, strict=True)) for r in rows]
    items = [i for i in items if i["source_norm_key"] == i["target_norm_key"][::-1] and i["source_count"] >= p.min_source_count and i["target_count"] >= p.min_target_count and i["pair_score"] >= p.min_pair_score and i["source_n"] <= p.max_source_n and i["target_n"] <= p.max_target_n]
    lg = lambda x: math.log(x + 1)
    items.sort(key=lambda i: -round(i["pair_score"] + lg(i["source_count"]) + lg(i["target_count"]), 9))
    items = items[: p.piece_limit]

    def ends(words, lang):
        return (0.5 * (words[0] in L.WEAK_FIRST.get(lang, ())) + (words[-1] in L.WEAK_LAST.get(lang, ()))) * p.edge_penalty

    def fragment(text, lang):
        w = text.split()
        return p.fragment_penalty * (all(x in L.FUNCTION_WORDS.get(lang, ()) for x in w) + 0.5 * (w[-1] in L.WEAK_LAST.get(lang, ())) + 0.25 * (w[0] in L.WEAK_FIRST.get(lang, ())))

    def score(c):
        n = len(c)
        s = sum(i["pair_score"] for i in c) / n + sum(lg(i["source_count"]) for i in c) / n + sum(lg(i["target_count"]) for i in c) / n + 0.25 * min(lg(i["source_count"]) + lg(i["target_count"]) for i in c)
        s -= 0.75 * max(n - 2, 0) + 10 * (n - len({i["id"] for i in c}))
        seen = set()
        for i in c:
            s -= p.reciprocal_penalty * ((i["target_norm_key"], i["source_norm_key"]) in seen)
            seen.add((i["source_norm_key"], i["target_norm_key"]))
            s -= fragment(i["source_text"], i["source_lang"]) + fragment(i["target_text"], i["target_lang"])
        s -= ends(" ".join(i["source_text"] for i in c).split(), c[0]["source_lang"]) + ends(" ".join(i["target_text"] for i in c[::-1]).split(), c[-1]["target_lang"])
        return round(s, 6)

    beam, found = [((), 0.0)], []
    for size in range(1, p.max_pieces + 1):
        beam = [((*c, i), score((*c, i))) for (c, _), i in itertools.product(beam, items) if p.allow_repeated_pieces or i["id"] not in {x["id"] for x in c}]
        beam = sorted(beam, key=lambda x: -x[1])[: p.beam_size]
        if size >= p.min_pieces:
            found += beam
    best = {}
    for c, s in found:
        key = tuple(sorted(i["id"] for i in c)) if p.collapse_permutations else ("".join(i["source_norm_key"] for i in c), "".join(i["target_norm_key"] for i in c[::-1]))
        if key not in best or s > best[key][1]:
            best[key] = (c, s)
    return [([i["id"] for i in c], s) for c, s in sorted(best.values(), key=lambda x: -x[1])[: p.max_results]]


@pytest.mark.parametrize(
    "policy",
    [
        PhrasePolicy(),
        PhrasePolicy(min_pieces=1, max_pieces=3, beam_size=9, max_results=20),
        PhrasePolicy(collapse_permutations=False, beam_size=30),
        PhrasePolicy(allow_repeated_pieces=True, min_pieces=2, max_pieces=3, piece_limit=5, beam_size=12),
    ],
)
def test_beam_against_plain_python(spark, policy):
    rnd = random.Random(3)
    rows = list(BASE)
    for k in range(5, 14):
        s = "".join(rnd.choice("abde ") for _ in range(5)).strip() or "x"
        s = " ".join(s.split())
        rows.append(piece(k, s, s.replace(" ", "")[::-1], rnd.choice([3.0, 4.0, 5.5]), rnd.choice([100, 200]), rnd.choice([100, 400]), rnd.choice([("es", "pt"), ("es", "es"), ("fr", "pt")])))
    got = phrases.generate_phrases(spark.createDataFrame(rows, SCHEMA), policy).select("piece_ids", "phrase_score").collect()
    assert [(r[0], r[1]) for r in got] == brute(rows, policy)


def run(spark, rows, **kw):
    return phrases.generate_phrases(spark.createDataFrame(rows, SCHEMA), PhrasePolicy(**kw)).collect()


def test_target_is_in_reverse_order_and_reverses(spark):
    for r in run(spark, BASE, collapse_permutations=False):
        assert r["formal_ok"] and r["source_norm_key"] == r["target_norm_key"][::-1]
        assert r["source_phrase"].replace(" ", "") == r["target_phrase"].replace(" ", "")[::-1]


def test_rare_pieces_give_nothing(spark):
    assert run(spark, [piece(0, "roma", "amor", sc=1), piece(1, "aires", "seria", sc=1)]) == []


def test_permutations_collapse(spark):
    two = [piece(0, "aires", "seria"), piece(1, "roma", "amor")]
    assert len(run(spark, two)) == 1
    assert len(run(spark, two, collapse_permutations=False)) == 2


def test_plausibility_adds_its_weight(spark):
    frame = spark.createDataFrame(BASE, SCHEMA)
    plain = {tuple(r["piece_ids"]): r["phrase_score"] for r in phrases.generate_phrases(frame, PhrasePolicy(collapse_permutations=False)).collect()}
    scored = phrases.generate_phrases(frame, PhrasePolicy(collapse_permutations=False, plausibility_weight=1.0), scorer=lambda text, lang: F.lit(5.0)).collect()
    assert all(round(r["phrase_score"] - plain[tuple(r["piece_ids"])], 6) == 10.0 for r in scored)


def test_word_frequencies(spark):
    zipf = spark.createDataFrame([("es", "aires", 4.0), ("pt", "seria", 2.0)], "lang string, token string, zipf double")
    two = spark.createDataFrame([piece(0, "aires", "seria")], SCHEMA)
    policy = PhrasePolicy(min_pieces=1, max_pieces=1)
    a, b = (phrases.generate_phrases(two, policy, z).first()["phrase_score"] for z in (None, zipf))
    assert round(b - a, 6) == round(0.35 * 6, 6)


def test_decomposition_against_plain_python(spark):
    rnd = random.Random(1)
    make = lambda n, k: list({"".join(rnd.choice("abé") for _ in range(rnd.randint(1, k))) for _ in range(n)})
    source, target = [*make(40, 6), "a ba"], make(12, 3)
    strip = lambda s: s.replace("é", "e").replace(" ", "")
    want = set()
    for s in source:
        for k in (1, 2, 3):
            for combo in itertools.product(target, repeat=k):
                if "".join(map(strip, combo)) == strip(s)[::-1]:
                    want.add((s, k, " ".join(combo)))
    frames = [spark.createDataFrame([(x,) for x in xs], "text string") for xs in (source, target)]
    got = {tuple(r) for r in pairs.decompose(*frames, 3).collect()}
    assert got == want and want
    one = pairs.grouped(pairs.decompose(*frames, 2)).first()
    assert one["phrases"] == sorted(one["phrases"])


@pytest.mark.parametrize("ngram, listed, dropped", [("a b", ["a"], True), ("a b c", ["a b"], True), ("a", ["a"], True), ("a b c d", ["b", "c d"], True), ("a b c", ["a c"], False), ("a", ["b"], False), ("a b", [], False), ("", ["a"], False), ("a b c", ["b a"], False), ("A b", ["a"], False)])
def test_word_list(spark, ngram, listed, dropped):
    rows = spark.createDataFrame([(ngram, "x")], "source_text string, target_text string")
    words = spark.createDataFrame([(w,) for w in listed], "word string")
    assert (review.drop_listed(rows, words, "source").count() == 0) is dropped


PAIRS = [("es", "wiki", "roda", 1, 5, "roda", "pt", "wiki", "a dor", 2, 7, "ador", 4.2), ("es", "wiki", "casa", 1, 10, "casa", "pt", "wiki", "mesa", 1, 8, "mesa", 1.0)]
PAIR_SCHEMA = "source_lang string, source_corpus string, source_text string, source_n int, source_count bigint, source_norm_key string, target_lang string, target_corpus string, target_text string, target_n int, target_count bigint, target_norm_key string, pair_score double"


def test_review(spark):
    rows = spark.createDataFrame(PAIRS, PAIR_SCHEMA)
    kept = review.filter_review(rows, ReviewPolicy(source_contains=" ROD ", min_pair_score=2.0, min_source_count=3, target_n=2)).collect()
    assert [r["source_text"] for r in kept] == ["roda"]
    assert [r["status"] for r in review.key_check(rows).orderBy("source_text").collect()] == ["mismatch", "match"]
    text = review.detail(rows.where("source_text = 'roda'")).first()["detail"]
    assert "`reverse(roda) = ador`" in text and "Key check: **match**" in text and "| Corpus | `wiki` | `wiki` |" in text
    assert review.filter_pairs(rows, target_n=2).count() == 1
    words = spark.createDataFrame([("a",)], "word string")
    assert [r[0] for r in review.add_words(words, spark.createDataFrame([("a",), ("b",), (" ",)], "word string")).orderBy("word").collect()] == ["a", "b"]
