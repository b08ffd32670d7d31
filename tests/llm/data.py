"""Small documents with every awkward case: nulls, empty and very long texts, ties, repeats, clashing columns."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, __id int, __text string, __gone string, keep string, quality int, bin_id int, part int, bucket int, key string, node int"
EXTRA = (1, "t", "g", "k", 2, 3, 4, 5, "y", 6)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None, *EXTRA) for i, t in rows], SCHEMA)


def words(rnd, n, letters="abcdefg"):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 6))) for _ in range(n))


def awkward(seed=1, n=40):
    rnd = random.Random(seed)
    rows = [(k, words(rnd, rnd.randint(1, 60))) for k in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "  \n"), (None, "no id here"), (None, None), (n + 3, "!!! ..."), (n + 4, words(rnd, 30_000)), (n + 5, "x" * 200_000), (n + 6, "héé ßß 日本語 😀 \x00 nul")]
    return rows + [rows[0], rows[0], rows[3], (n, None)]
