"""Writers.  A folder that exists is refused unless ``force`` is given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions import text as T


def _mode(force: bool) -> str:
    return "overwrite" if force else "errorifexists"


def write_tsv(df: DataFrame, path: str, force: bool = False, single: bool = False) -> None:
    """Tab-separated with a header, arrays as JSON; ``single`` makes one file in the order of the rows."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    df = df.select(*(F.to_json(c).alias(c) if c in arrays else F.col(c) for c in df.columns))
    (df.coalesce(1) if single else df).write.mode(_mode(force)).option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def write_decompositions(decomposed: DataFrame, path: str, force: bool = False) -> None:
    """A JSON line for each source: {source: {word count: sorted phrases}}, in order of the sources' keys, then of themselves."""
    by = decomposed.groupBy("source", "word_count").agg(F.sort_array(F.collect_set("phrase")).alias("phrases"))
    rows = by.groupBy("source").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("word_count").cast("string"), "phrases")))).alias("m"))
    rows.orderBy(T.norm_key(F.col("source")), "source").select(F.to_json(F.create_map("source", "m")).alias("value")).write.mode(_mode(force)).text(path)


def write_lexicon(lexicon: DataFrame, path: str, force: bool = False) -> None:
    """A JSON line for each word, in order of words: {word: sorted categories} of (word, pos)."""
    rows = lexicon.groupBy("word").agg(F.sort_array(F.collect_set("pos")).alias("pos")).orderBy("word")
    rows.select(F.to_json(F.create_map("word", "pos")).alias("value")).write.mode(_mode(force)).text(path)


def _renamed(spark: SparkSession, path: str, old: str, new: str) -> None:
    """Give the files of a folder another ending, by which readers know their format."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(where):
        file = status.getPath()
        if file.getName().endswith(old):
            fs.rename(file, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where, file.getName().removesuffix(old) + new))


def write_corpus_jsonl(rows: DataFrame, path: str, force: bool = False) -> None:
    """id, url, title, text as JSON lines, nulls written."""
    have = rows.columns
    rows.select(*(F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in ("id", "url", "title", "text"))).write.mode(_mode(force)).option("ignoreNullFields", False).json(path)
    _renamed(rows.sparkSession, path, ".json", ".jsonl")


def write_corpus_text(rows: DataFrame, path: str, force: bool = False) -> None:
    """Texts with a '# title' line before each that has a title; empty ones are left out."""
    text, title = (F.trim(F.coalesce(c, F.lit(""))) if c in rows.columns else F.lit("") for c in ("text", "title"))
    rows.where(text != "").select(F.concat(F.when(title != "", F.concat(F.lit("\n\n# "), title, F.lit("\n\n"))).otherwise(""), text).alias("value")).write.mode(_mode(force)).text(path)


def write_lines(df: DataFrame, column: str, path: str, force: bool = False) -> None:
    """One column as lines: candidate lists, filter lists."""
    df.select(F.col(column).cast("string").alias("value")).write.mode(_mode(force)).text(path)


def write_removed(refused: DataFrame, path: str, force: bool = False) -> None:
    """Refused forms (form, reason): by reason as JSON under ``removed``, and the sorted list under ``automatic.filter``."""
    by = refused.groupBy("reason").agg(F.sort_array(F.collect_set("form")).alias("forms"))
    by.select(F.to_json(F.create_map("reason", "forms")).alias("value")).write.mode(_mode(force)).text(f"{path}/removed")
    refused.select(F.col("form").alias("value")).distinct().orderBy("value").write.mode(_mode(force)).text(f"{path}/automatic.filter")


def write_visible_pairs(pairs: DataFrame, path: str, force: bool = False) -> None:
    """'source ↔ target' lines."""
    pairs.select(F.concat_ws(" ↔ ", "source_text", "target_text").alias("value")).write.mode(_mode(force)).text(path)


def write_embeddings(vectors: DataFrame, path: str, force: bool = False) -> bool:
    """Parquet; what is there is kept and reused unless ``force`` is given.  Whether it was written."""
    spark = vectors.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where) and not force:
        return False
    vectors.write.mode(_mode(True)).parquet(path)
    return True


def write_enriched(enriched: DataFrame, path: str, force: bool = False) -> None:
    """word, original {pos}, estimated {pos, lemma, conf} as JSON lines."""
    rows = enriched.select("word", F.struct(F.col("original_pos").alias("pos")).alias("original"), F.struct("pos", "lemma", "conf").alias("estimated"))
    rows.write.mode(_mode(force)).option("ignoreNullFields", False).json(path)
