"""Part-of-speech tags: labels, features, patterns, agreement, candidates, form rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lang as L


def coarse_pos(tag: Column) -> Column:
    out = F.lit("UNK")
    for letter, name in L.COARSE_POS.items():
        out = F.when(F.substring(tag, 1, 1) == letter, name).otherwise(out)
    return out


def pos_label(tag: Column) -> Column:
    """The Spanish label of the first prefix that fits; null where none does."""
    out = F.lit(None).cast("string")
    for prefix, name in reversed(L.POS_LABELS):
        out = F.when(tag.startswith(prefix), name).otherwise(out)
    return out


def feature(tag: Column, name: str, lang: str) -> Column:
    """A feature's letter in the tag; null where the tag has no such place, is short, or has 0."""
    slot = F.lit(None).cast("int")
    for pos, slots in L.FEATURE_SLOTS[lang].items():
        if name in slots:
            slot = F.when(F.substring(tag, 1, 1) == pos, F.lit(slots[name] + 1)).otherwise(slot)
    value = F.substring(tag, slot, F.lit(1))
    return F.when((value != "") & (value != "0"), value)


def features(tag: Column, lang: str) -> Column:
    """Map of the part of speech and all features the tag gives."""
    names = sorted({n for slots in L.FEATURE_SLOTS[lang].values() for n in slots})
    pairs = [F.struct(F.lit("pos").alias("k"), F.when(tag != "", F.substring(tag, 1, 1)).alias("v"))]
    pairs += [F.struct(F.lit(n).alias("k"), feature(tag, n, lang).alias("v")) for n in names]
    return F.map_from_entries(F.filter(F.array(*pairs), lambda x: x["v"].isNotNull()))


def matches(tag: Column, pattern: Column) -> Column:
    """Equal length, and every letter equal or X in the pattern."""
    at = F.sequence(F.lit(1), F.length(pattern))
    same = F.forall(at, lambda i: (F.substring(pattern, i, F.lit(1)) == "X") | (F.substring(pattern, i, F.lit(1)) == F.substring(tag, i, F.lit(1))))
    return (F.length(tag) == F.length(pattern)) & ((F.length(pattern) == 0) | same)


def agree(left: Column, right: Column, lang: str) -> Column:
    """Whether neighbouring tags agree; only determiners, nouns and adjectives must."""
    ok = F.lit(True)
    for name, wild in L.WILDCARDS[lang].items():
        a, b = feature(left, name, lang), feature(right, name, lang)
        ok &= F.coalesce((a == b) | a.isin(*wild) | b.isin(*wild), F.lit(True))
    bound = F.substring(left, 1, 1).isin(*L.AGREEING) & F.substring(right, 1, 1).isin(*L.AGREEING)
    return ~bound | ok


def tag_index(lexicon: DataFrame) -> DataFrame:
    """Distinct (tag, form) of a lexicon with columns form and tag."""
    return lexicon.where("tag is not null and tag <> ''").select("tag", "form").distinct()


def expand_pattern(index: DataFrame, pattern: str) -> DataFrame:
    """The tags there are that match the pattern."""
    return index.select("tag").distinct().where(matches(F.col("tag"), F.lit(pattern)))


def candidates(index: DataFrame, patterns: list[str] | None, lang: str) -> DataFrame:
    """tags, candidate: a form for each pattern, neighbours in agreement.  Without patterns every tag stands alone.

    Tags are combined and checked before forms are joined to them, so no
    combination of forms is made that agreement rules out.
    """
    if not patterns:
        return index.select(F.array("tag").alias("tags"), F.col("form").alias("candidate"))
    tags = expand_pattern(index, patterns[0]).select(F.array("tag").alias("tags"))
    for pattern in patterns[1:]:
        tags = tags.join(expand_pattern(index, pattern), agree(F.element_at("tags", -1), F.col("tag"), lang)).select(F.concat("tags", F.array("tag")).alias("tags"))
    rows = tags
    for k in range(len(patterns)):
        side = index.select(F.col("tag").alias("__tag"), F.col("form").alias("__form"))
        rows = rows.join(side, F.col("tags")[k] == F.col("__tag")).select("tags", (F.concat_ws(" ", "candidate", "__form") if k else F.col("__form")).alias("candidate"))
    return rows


def form_reasons(form: Column) -> Column:
    """Why a form is refused: any of hyphenated, dotted, unicode_symbol."""
    tests = {"hyphenated": form.contains("-"), "dotted": form.contains("."), "unicode_symbol": ~form.rlike(r"^[\p{L}\p{N}\p{Z}]*$")}
    return F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in tests.items())))


def apply_form_rules(lexicon: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid forms, and (form, reason) of the refused ones."""
    forms = lexicon.select("form").distinct().withColumn("reasons", form_reasons(F.col("form")))
    return forms.where(F.size("reasons") == 0).select("form"), forms.select("form", F.explode("reasons").alias("reason"))


def parse_tagger(lines: DataFrame) -> DataFrame:
    """token, lemma, pos, conf of tagger output (``line``, ``ord``); the last line of a token counts."""
    parts = F.split(F.trim(F.regexp_replace("value", r"(?U)\s+", " ")), " ")
    rows = lines.withColumn("parts", parts).where(F.size("parts") >= 3)
    rows = rows.select(F.col("parts")[0].alias("token"), "ord", F.struct(F.col("parts")[1].alias("lemma"), F.col("parts")[2].alias("pos"), F.get("parts", F.lit(3)).cast("double").alias("conf")).alias("found"))
    return rows.groupBy("token").agg(F.max_by("found", "ord").alias("found")).select("token", "found.lemma", "found.pos", "found.conf")


def enrich(words: DataFrame, analyses: DataFrame) -> DataFrame:
    """word, original_pos, pos, lemma, conf, label: every word, with its analysis where there is one."""
    return words.join(analyses, words["word"] == analyses["token"], "left").select("word", "original_pos", "pos", "lemma", "conf", pos_label(F.col("pos")).alias("label"))


