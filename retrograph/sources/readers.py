"""Readers with fixed schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FORMATS = ("auto", "txt", "jsonl")
_PAIR_TYPES = {"pair_score": "double", **{f"{s}_{c}": t for s in ("source", "target") for c, t in (("lang", "string"), ("corpus", "string"), ("text", "string"), ("n", "int"), ("count", "bigint"), ("norm_key", "string"))}}
#: Columns of a phrase file under the names a pair file has.
_PHRASE_NAMES = {"source_text": "source_phrase", "target_text": "target_phrase", "pair_score": "phrase_score", "source_count": "min_source_count", "target_count": "min_target_count"}


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        raise FileNotFoundError(path)
    return fs, where


def _formats(spark: SparkSession, path: str, fmt: str) -> list[str]:
    """Formats to read of a file or folder, by the file's name; nothing is listed."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}")
    fs, where = _files(spark, path)
    if fs.getFileStatus(where).isFile():
        if fmt != "auto":
            return [fmt]
        found = [k for k in ("jsonl", "txt") if path.endswith(f".{k}")]
        if not found:
            raise ValueError(f"can't tell the format of {path}")
        return found
    return ["jsonl", "txt"] if fmt == "auto" else [fmt]


def numbered_lines(spark: SparkSession, path: str, fmt: str = "auto") -> DataFrame:
    """file, kind, line, value: the lines of a file, or of a folder's files and all below it.

    Spark lists the files and splits large ones.  A line's number is its place in
    its split and the number of lines in the splits before it.
    """
    out = None
    single = _files(spark, path)[0].getFileStatus(_files(spark, path)[1]).isFile()
    for kind in _formats(spark, path, fmt):
        reader = spark.read.option("recursiveFileLookup", True)
        rows = (reader if single else reader.option("pathGlobFilter", f"*.{kind}")).text(path)
        rows = rows.select("value", F.lit(kind).alias("kind"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
        out = rows if out is None else out.union(rows)
    splits = out.groupBy("file", "start").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start")) - F.col("n")
    splits = splits.select("file", "start", (before - F.col("first") + 1).alias("shift"))
    return out.join(splits, ["file", "start"]).select("file", "kind", (F.col("at") + F.col("shift")).alias("line"), "value")


def _is_object(value: Column) -> Column:
    read = F.from_json(value, "`\t` string, broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    return F.ltrim(value).startswith("{") & read["broken"].isNull()


def invalid_json_lines(spark: SparkSession, path: str, fmt: str = "auto") -> DataFrame:
    """file, line, value of lines of jsonl files that are neither blank nor JSON objects."""
    rows = numbered_lines(spark, path, fmt).where("kind = 'jsonl' and trim(value) <> ''")
    return rows.where(~_is_object(F.col("value"))).select("file", "line", "value")


def read_corpus(spark: SparkSession, path: str, fmt: str = "auto", field: str = "text", limit_docs: int = 0) -> DataFrame:
    """text, file: a record for each line of txt files (blank ones too) and for each jsonl line whose field has text.

    A jsonl line that isn't JSON fails the job; ``invalid_json_lines`` says which
    line it is.  With ``limit_docs`` only the first records are read: jsonl before
    txt, files by depth and path, lines in order.
    """
    single = _files(spark, path)[0].getFileStatus(_files(spark, path)[1]).isFile()
    if limit_docs:
        lines = numbered_lines(spark, path, fmt)
        name = field.replace("`", "``")
        held = F.from_json("value", f"`{name}` string", {"mode": "FAILFAST"})[field]
        text = F.when(F.col("kind") == "txt", F.col("value")).when(F.trim("value") != "", held)
        rows = lines.select("kind", "file", "line", text.alias("text")).where("kind = 'txt' or text <> ''")
        depth = F.length("file") - F.length(F.replace("file", F.lit("/"), F.lit("")))
        return rows.orderBy("kind", depth, "file", "line").limit(limit_docs).select("text", "file")
    out = None
    for kind in _formats(spark, path, fmt):
        reader = spark.read.option("recursiveFileLookup", True)
        reader = reader if single else reader.option("pathGlobFilter", f"*.{kind}")
        if kind == "txt":
            rows = reader.text(path).select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"))
        else:
            rows = reader.schema(f"`{field}` string").option("mode", "FAILFAST").json(path).select(F.col(f"`{field}`").alias("text"), F.col("_metadata.file_path").alias("file")).where("text <> ''")
        out = rows if out is None else out.union(rows)
    return out


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """word: every line that isn't blank, without white space around it."""
    return spark.read.text(path).select(F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("word")).where("word <> ''")


def _objects(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """m: the JSON objects of files, one in each line, or else one in each file."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    if lines.where(~_is_object(F.col("value"))).isEmpty():
        return lines.select(F.from_json("value", kind, {"mode": "FAILFAST"}).alias("m"))
    return spark.read.text(path, wholetext=True).select(F.from_json("value", kind, {"mode": "FAILFAST"}).alias("m"))


def read_json_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """form, source, lemma, pos, tag of one JSON object from forms to lists of analyses."""
    kind = "map<string, array<struct<source: string, lemma: string, pos: string, tag: string>>>"
    rows = _objects(spark, path, kind)
    return rows.select(F.explode("m").alias("form", "held")).select("form", F.explode_outer("held").alias("a")).select("form", "a.*")


def read_wiki_dump(spark: SparkSession, path: str, max_pages: int = 0) -> DataFrame:
    """ns, title, text of the pages of a MediaWiki dump; bz2 files are split and read in parallel."""
    schema = "ns string, title string, revision struct<text: string>"
    text = "revision struct<text: struct<_VALUE: string>>"
    df = spark.read.format("xml").option("rowTag", "page").schema(schema.replace("revision struct<text: string>", text)).load(path)
    rows = df.select("ns", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("revision.text._VALUE", F.lit("")).alias("text"))
    return rows.limit(max_pages) if max_pages else rows


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """value, ord: lines of a dictionary file in order."""
    return spark.read.text(path).select("value", F.monotonically_increasing_id().alias("ord"))


def _lenient(name: str, kind: str, have: list[str]) -> Column:
    if name not in have:
        return (F.lit("") if kind == "string" else F.lit(0)).cast(kind).alias(name)
    if kind == "string":
        return F.coalesce(name, F.lit("")).alias(name)
    value = F.expr(f"try_cast(trim(`{name}`) as double)")
    return F.coalesce(value.cast(kind), F.lit(0).cast(kind)).alias(name)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """The pair columns and id of a pair or phrase file; missing columns and blank numbers give '' and 0."""
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("mode", "PERMISSIVE").csv(path)
    for name, other in _PHRASE_NAMES.items():
        if name not in raw.columns and other in raw.columns:
            raw = raw.withColumnRenamed(other, name)
    return raw.select(F.monotonically_increasing_id().alias("id"), *(_lenient(n, k, raw.columns) for n, k in _PAIR_TYPES.items()))


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """word, embedding: parquet, or an npz file with ``words`` and ``embeddings`` on the driver."""
    if not path.endswith(".npz"):
        return spark.read.parquet(path).select("word", "embedding")
    import numpy as np
    import pyarrow as pa

    with np.load(path, allow_pickle=False) as held:
        table = pa.table({"word": pa.array(held["words"].tolist(), pa.string()), "embedding": pa.array(list(held["embeddings"].astype(np.float32)), pa.list_(pa.float32()))})
    return spark.createDataFrame(table)


def read_decompositions(spark: SparkSession, path: str) -> DataFrame:
    """source, word_count, phrase of JSON objects word -> {count -> phrases}."""
    rows = _objects(spark, path, "map<string, map<string, array<string>>>")
    rows = rows.select(F.explode("m").alias("source", "by_count")).select("source", F.explode("by_count").alias("n", "phrases"))
    return rows.select("source", F.col("n").cast("int").alias("word_count"), F.explode("phrases").alias("phrase"))


def read_filter_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct words of a filter file; a missing file is an empty list."""
    try:
        _files(spark, path)
    except FileNotFoundError:
        return spark.createDataFrame([], "word string")
    return read_lexicon(spark, path).distinct()
