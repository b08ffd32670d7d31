import itertools

import pytest

from retrograph.plans import queries

WORDS = ["".join(w) for w in itertools.islice(itertools.product("bcdfghjklm", repeat=4), 0, None, 3) if w != w[::-1]][:2300]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Thousands of pairs; the rarest have a target of two words, and so the greatest numbers."""
    path = str(tmp_path_factory.mktemp("pairs"))
    rows = [(lang, "s", "\n".join(f"{w}." for w in (WORDS if lang == "es" else [x[::-1] for x in WORDS]) for _ in range(2))) for lang in ("es", "en")]
    rows += [("es", "s", "qzvtx."), ("en", "s", "xt vzq.")]
    spark.createDataFrame(rows, "lang string, source string, text string").write.parquet(f"{path}/documents.parquet")
    return path


def test_no_pair_is_left_out(spark, folder):
    got = queries.QUERIES["review_key_check"](spark, folder).collect()
    assert {(r["source_norm_key"], r["target_norm_key"]) for r in got} == {(w, w[::-1]) for w in WORDS} | {("qzvtx", "xtvzq")}
    assert sorted(r["id"] for r in got) == list(range(len(WORDS) + 1))
    ranked = [r["source_norm_key"] for r in sorted(got, key=lambda r: r["id"])]
    assert ranked == sorted(WORDS) + ["qzvtx"]


def test_rare_pair_of_two_words(spark, folder):
    assert [(r["source_text"], r["target_text"]) for r in queries.QUERIES["ngram_size_filter"](spark, folder).collect()] == [("qzvtx", "xt vzq")]
