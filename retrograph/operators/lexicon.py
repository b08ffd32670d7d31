"""Lexicons from wiki pages and dictionary files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .tags import coarse_pos

CATEGORIES = ("adjetivo", "adverbio", "conjunción", "determinante", "forma", "interjección", "locución", "numeral", "onomatopeya", "preposición", "pronombre", "sustantivo", "verbo")
_ES_SECTION = r"(?m)^==\s*\{\{lengua\|es\}\}\s*==\s*$"
_ES_NEXT = r"(?m)^==[^=].*==\s*$"
_ES_HEADER = r"(?m)^(={3,5})\s*(?:\{\{\s*([^}|]+).*?\}\}|([^=\n]+))\s*\1\s*$"
_GL_SECTION = r"(?i)\{\{-(?:gl|glref)-\}\}"
_GL_SOUND = r"(?i)\{\{son\|\|\|gl\}\}"
_GL_POS = r"(?i)\{\{-(verbo|subst|adx|adv|prep|conx|interx|pron|num)[a-z]*-(?:\|gl)?\}\}"
_GL_CALL = r"(?i)\{\{\s*(conx\.gl[^|}]+)\|([^}]*)\}\}"
GL_POS = {"subst": "sustantivo", "verbo": "verbo", "adx": "adjetivo", "adv": "adverbio", "prep": "preposición", "conx": "conjunción", "interx": "interjección", "pron": "pronombre", "num": "numeral"}
TEMPLATE_PREFIX = "Modelo:"


def _position(text: Column, part: Column) -> Column:
    return F.call_function("instr", text, part)


def _after(text: Column, pattern: str) -> Column:
    """What follows the first match; null without one."""
    found = F.regexp_extract(text, pattern, 0)
    return F.when(found != "", F.substring(text, _position(text, found) + F.length(found), F.length(text)))


def _before(text: Column, pattern: str) -> Column:
    """What comes before the first match, or all of it."""
    found = F.regexp_extract(text, pattern, 0)
    return F.when(found == "", text).otherwise(F.substring(text, F.lit(1), _position(text, found) - 1))


def base_category(label: Column) -> Column:
    """First word of a heading, in lower case."""
    return F.split(T.normalize_spacing(F.lower(label)), " ")[0]


def spanish_section(text: Column) -> Column:
    """The Spanish part of an entry; null where there is none."""
    return _before(_after(text, _ES_SECTION), _ES_NEXT)


def spanish_pos(section: Column) -> Column:
    """Base categories of the part's headings."""
    labels = [F.regexp_extract_all(section, F.lit(_ES_HEADER), F.lit(k)) for k in (2, 3)]
    names = F.transform(F.concat(*labels), base_category)
    return F.array_distinct(F.filter(names, lambda n: n.isin(*CATEGORIES)))


def galician_section(text: Column) -> Column:
    return _after(text, _GL_SECTION)


def galician_pos(section: Column) -> Column:
    """The category of the first heading after the sound mark."""
    root = F.lower(F.regexp_extract(_after(section, _GL_SOUND), _GL_POS, 1))
    out = F.array().cast("array<string>")
    for name, label in GL_POS.items():
        out = F.when(root == name, F.array(F.lit(label))).otherwise(out)
    return out


def clean_word(word: Column) -> Column:
    return word.rlike("(?iu)^[a-záéíóúüñ]+$")


def _entries(pages: DataFrame, section: Column, pos) -> DataFrame:
    """lemma, section, pos of the articles that have both."""
    rows = pages.where("ns = '0'").select("title", T.once(section).alias("section")).where("section is not null and section <> ''")
    return rows.select(F.lower(T.normalize_spacing(F.col("title"))).alias("lemma"), "section", T.once(pos(F.col("section"))).alias("pos")).where(F.size("pos") > 0)


def spanish_lexicon(pages: DataFrame) -> DataFrame:
    """word, pos (distinct) of wiki pages (ns, title, text)."""
    return _entries(pages, spanish_section(F.col("text")), spanish_pos).select(F.col("lemma").alias("word"), F.explode("pos").alias("pos")).distinct()


def conjugation_templates(pages: DataFrame) -> DataFrame:
    """name, kind, forms, rules (param, ending) of the Galician conjugation templates."""
    text = F.coalesce("text", F.lit(""))
    rows = pages.where((F.col("ns") == "10") & F.col("title").startswith(TEMPLATE_PREFIX + "conx.gl"))
    forms = F.filter(F.regexp_extract_all(text, F.lit(r"\{\{gl\|([^}|]+)\}\}"), F.lit(1)), lambda x: x.rlike(r"^\p{L}+$"))
    pattern = F.lit(r"\{\{gl\|\{\{\{(\d+)\}\}\}([^}]+)\}\}")
    rules = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(1)).alias("param"), F.transform(F.regexp_extract_all(text, pattern, F.lit(2)), F.trim).alias("ending"))
    return rows.select(
        F.replace("title", F.lit(TEMPLATE_PREFIX), F.lit("")).alias("name"),
        F.when(text.rlike(r"\{\{\{\s*\d+"), "pattern").otherwise("lexical").alias("kind"),
        F.array_sort(F.array_distinct(forms)).alias("forms"),
        F.filter(F.transform(rules, lambda r: F.struct(r["param"].cast("int").alias("param"), r["ending"].alias("ending"))), lambda r: r["ending"] != "").alias("rules"),
    )


def galician_lexicon(pages: DataFrame) -> DataFrame:
    """word, pos (distinct), with the forms of verbs whose conjugation template is known.

    A template without parameters in the call takes its stem from the lemma.
    """
    entries = _entries(pages, galician_section(F.col("text")), galician_pos)
    plain = entries.select(F.col("lemma").alias("word"), F.explode("pos").alias("pos"))
    verbs = entries.where(F.array_contains("pos", "verbo")).select("lemma", F.regexp_extract("section", _GL_CALL, 1).alias("name"), F.regexp_extract("section", _GL_CALL, 2).alias("raw"))
    given = F.filter(F.transform(F.split("raw", r"\|"), F.trim), lambda s: s != "")
    stem = F.when(F.col("lemma").rlike("(ar|er|ir)$"), F.expr("substring(lemma, 1, length(lemma) - 2)")).otherwise(F.col("lemma"))
    verbs = verbs.where("name <> ''").select("lemma", "name", F.when(F.size(given) > 0, given).otherwise(F.array(stem)).alias("stems"))
    joined = verbs.join(conjugation_templates(pages), "name")
    fitting = F.filter("rules", lambda r: (r["param"] >= 1) & (r["param"] <= F.size("stems")))
    made = F.transform(fitting, lambda r: F.concat(F.get("stems", r["param"] - 1), r["ending"]))
    forms = joined.select(F.explode(F.when(F.col("kind") == "lexical", F.col("forms")).otherwise(made)).alias("word"), F.lit("forma_verbal").alias("pos"))
    return plain.union(forms).distinct()


def collected(lexicon: DataFrame) -> DataFrame:
    """word and its sorted categories, in order of words."""
    return lexicon.groupBy("word").agg(F.sort_array(F.collect_set("pos")).alias("pos")).orderBy("word")


def dictionary_entries(lines: DataFrame) -> DataFrame:
    """form, source, lemma, pos, tag, ord of dictionary lines (``value``, ``ord``): a form, then lemma and tag again and again.

    Lines with an odd rest are left out.
    """
    parts = F.split(T.normalize_spacing(F.col("value")), " ")
    rows = lines.select("ord", T.once(parts).alias("parts")).where((F.col("parts")[0] != "") & (F.size("parts") % 2 == 1) & (F.size("parts") > 1))
    pair = F.transform(F.sequence(F.lit(1), F.expr("(size(parts) - 1) div 2").cast("int")), lambda k: F.struct(F.get("parts", 2 * k - 1).alias("lemma"), F.get("parts", 2 * k).alias("tag")))
    rows = rows.select("ord", F.col("parts")[0].alias("form"), F.posexplode(pair).alias("k", "pair"))
    return rows.select("form", F.lit("freeling").alias("source"), "pair.lemma", coarse_pos(F.col("pair.tag")).alias("pos"), "pair.tag", F.struct("ord", "k").alias("ord"))


def malformed_lines(lines: DataFrame) -> DataFrame:
    """Dictionary lines with an odd rest."""
    parts = F.split(T.normalize_spacing(F.col("value")), " ")
    return lines.where((F.trim("value") != "") & (F.size(parts) % 2 == 0))


def analyses(entries: DataFrame) -> DataFrame:
    """form and the list of its analyses, in the order of the file."""
    held = F.sort_array(F.collect_list(F.struct("ord", "source", "lemma", "pos", "tag")))
    return entries.groupBy("form").agg(F.transform(held, lambda x: F.struct(x["source"].alias("source"), x["lemma"].alias("lemma"), x["pos"].alias("pos"), x["tag"].alias("tag"))).alias("analyses"))
