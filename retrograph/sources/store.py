"""The count store: raw partial counts, compacted totals and marks of what is compacted, as partitioned parquet."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ngrams, pairs, stats
from ..plans.policies import COUNT_SOURCES, ExportPolicy, NgramPolicy, SearchPolicy

RAW, TOTALS, MARKS = "ngram_counts", "ngram_totals", "ngram_compactions"
STAGING, BATCHES = "_staging", "_batches"
COUNTS_SCHEMA = "text string, count bigint, norm_key string, lang string, corpus string, n int"
MARKS_SCHEMA = "compacted_at timestamp, lang string, corpus string, n int"
PARTITION = ["lang", "corpus", "n"]


def _follows() -> Column:
    """Whether a count's key and size follow from its text, as they do for all that ``count_ngrams`` makes."""
    return (F.col("norm_key").eqNullSafe(ngrams.key_of("text"))) & F.col("n").eqNullSafe(ngrams.size_of("text"))


class NgramStore:
    """Tables under ``root``, partitioned by language, corpus and size, so filters on these never open other files.

    A compacted partition is valid while its mark is there.  Rows are written to
    a staging folder first and moved into the tables by renaming.  Appending
    drops marks and totals of the partitions it touches before rows are moved,
    and compacting makes marks last, so a job that breaks off leaves no mark of
    totals that are out of date.  What an append costs depends on its own rows
    and partitions, not on what the store holds.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _files(self, name: str) -> DataFrame:
        """A table as it is written; the key of a count is null where it follows from the text."""
        schema = MARKS_SCHEMA if name == MARKS else COUNTS_SCHEMA
        path = f"{self.root}/{name}"
        if not self.partitions(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _table(self, name: str) -> DataFrame:
        rows = self._files(name)
        return rows if name == MARKS else rows.withColumn("norm_key", F.coalesce("norm_key", ngrams.key_of("text")))

    def raw(self) -> DataFrame:
        return self._table(RAW).select("lang", "corpus", "text", "n", "count", "norm_key")

    def totals(self) -> DataFrame:
        return self._table(TOTALS).select("lang", "corpus", "text", "n", "count", "norm_key")

    def marks(self) -> DataFrame:
        return self._table(MARKS).select("lang", "corpus", "n", "compacted_at")

    def partitions(self, name: str, lang: str | None = None, corpus: str | None = None, n: int = 0) -> dict[tuple[str, str, int], str]:
        """Folders of a table's partitions, from file names alone."""
        found = self._fs.globStatus(self._path(f"{self.root}/{name}/lang=*/corpus=*/n=*"))  # folders only
        out = {}
        for status in found or []:
            path = status.getPath().toString()
            a, b, c = (unquote(p.split("=", 1)[1]) for p in path.rsplit("/", 3)[1:])
            if lang in (None, a) and corpus in (None, b) and (not n or n == int(c)):
                out[a, b, int(c)] = path
        return out

    def _drop(self, name: str, keys: set[tuple[str, str, int]]) -> None:
        for key, path in self.partitions(name).items():
            if key in keys:
                self._fs.delete(self._path(path), True)

    def _stage(self, rows: DataFrame, name: str) -> str:
        """Write rows, partitioned, to a staging folder; one that is complete is kept as it is."""
        stage = f"{STAGING}/{name}"
        if not self._fs.exists(self._path(f"{self.root}/{stage}/_SUCCESS")):
            key = F.when(~_follows(), F.col("norm_key")).alias("norm_key")
            rows.select("text", "count", key, *PARTITION).write.mode("overwrite").option("compression", "zstd").partitionBy(*PARTITION).parquet(f"{self.root}/{stage}")
        return stage

    def _move(self, stage: str, table: str) -> None:
        """Move a staging folder's files into a table and delete the folder.  Moved files are gone from it, so this can be done again."""
        for (lang, corpus, n), path in self.partitions(stage).items():
            target = self._path(f"{self.root}/{table}/{path.split(f'{stage}/', 1)[1]}")
            self._fs.mkdirs(target)
            for status in self._fs.listStatus(self._path(path)):
                file = status.getPath()
                if not self._fs.rename(file, self._path(target, file.getName())):
                    raise OSError(f"can't move {file.toString()} of {lang}, {corpus}, {n}")
        self._fs.delete(self._path(f"{self.root}/{stage}"), True)

    def append(self, counts: DataFrame, batch: str | None = None) -> int:
        """Add partial counts; totals and marks of what they touch are dropped.  The number of rows.

        A batch with a name is added once: if an earlier call broke off, this one
        goes on with what it had staged, and if it was added, nothing happens.
        """
        done = self._path(f"{self.root}/{BATCHES}/{batch}")
        if batch is not None and self._fs.exists(done):
            return 0
        stage = self._stage(counts, f"raw-{uuid.uuid4().hex if batch is None else batch}")
        added = sum(self._rows(stage).values())
        self.invalidate(set(self.partitions(stage)))
        self._move(stage, RAW)
        if batch is not None:
            self._fs.mkdirs(done)
        return added

    def _rows(self, name: str, lang: str | None = None, corpus: str | None = None, n: int = 0) -> dict[tuple[str, str, int], int]:
        """Rows of every partition, from the files' footers."""
        rows = self._table(name)
        for column, value in (("lang", lang), ("corpus", corpus), ("n", n or None)):
            if value is not None:
                rows = rows.where(F.col(column) == value)
        return {(r[0], r[1], r[2]): r[3] for r in rows.groupBy(*PARTITION).count().collect()}

    def invalidate(self, keys: set[tuple[str, str, int]]) -> None:
        self._drop(MARKS, keys)
        self._drop(TOTALS, keys)

    def add_documents(self, docs: DataFrame, policy: NgramPolicy = NgramPolicy(), *, reset: bool = False, batch: str | None = None) -> int:
        """Count documents (lang, corpus, text) and add the counts; ``reset`` first deletes what their corpora had."""
        found = docs.groupBy("lang", "corpus").agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).collect()
        if reset:
            for lang, corpus, _ in found:
                self.delete(lang, corpus)
        return self.append(ngrams.count_ngrams(docs, policy, {(r[0], r[1]): r[2] for r in found}), batch)

    def compact(self, lang: str, corpus: str, n: int = 0) -> int:
        """Sum up one size, or all sizes in one job; the number of rows made."""
        keys = set(self.partitions(RAW, lang, corpus, n))
        old = set(self.partitions(TOTALS, lang, corpus, n)) | keys
        if not keys:
            self.invalidate(old)
            return 0
        stage = self._stage(self._summed(lang, corpus, n), f"totals-{uuid.uuid4().hex}")
        made = sum(self._rows(stage).values())
        self.invalidate(old)
        self._move(stage, TOTALS)
        now = datetime.now(timezone.utc)
        self.spark.createDataFrame([(now, *k) for k in sorted(keys)], MARKS_SCHEMA).write.mode("append").partitionBy(*PARTITION).parquet(f"{self.root}/{MARKS}")
        return made

    def _summed(self, lang: str, corpus: str, n: int) -> DataFrame:
        """Sums of raw counts; keys and sizes travel only where they don't follow from the text."""
        rows = self._files(RAW).where((F.col("lang") == lang) & (F.col("corpus") == corpus))
        if n:
            rows = rows.where(F.col("n") == n)
        plain = F.col("norm_key").isNull() | _follows()
        return ngrams.totals_by_text(rows.where(plain)).unionByName(ngrams.totals(rows.where(~plain)))

    def delete(self, lang: str, corpus: str | None = None) -> dict[str, int]:
        """Delete a language or one of its corpora; rows deleted of each table."""
        out = {}
        for name in (RAW, TOTALS, MARKS):
            out[name] = sum(self._rows(name, lang, corpus).values())
            self._drop(name, set(self.partitions(name, lang, corpus)))
        return out

    def _sizes(self, name: str, lang: str, corpus: str) -> set[int]:
        return {k[2] for k in self.partitions(name, lang, corpus)}

    def _all_compacted(self, lang: str, corpus: str) -> bool:
        have = self._sizes(MARKS, lang, corpus)
        return bool(have) and self._sizes(RAW, lang, corpus) <= have

    def source(self, lang: str, corpus: str, n: int = 0, counts_source: str = "auto") -> str:
        """Which table counts are read from; 'auto' takes totals where marks say they are complete."""
        if counts_source not in COUNT_SOURCES:
            raise ValueError(f"counts_source must be one of: {', '.join(COUNT_SOURCES)}")
        if counts_source != "auto":
            return TOTALS if counts_source == "compact" else RAW
        ready = n in self._sizes(MARKS, lang, corpus) if n else self._all_compacted(lang, corpus)
        return TOTALS if ready else RAW

    def export(self, lang: str, corpus: str, policy: ExportPolicy = ExportPolicy(), counts_source: str = "auto") -> DataFrame:
        name = self.source(lang, corpus, policy.n, counts_source)
        return ngrams.export_ngrams(self._table(name), policy, lang=lang, corpus=corpus, compacted=name == TOTALS)

    def _usable(self, lang: str, corpus: str, n: int) -> bool:
        """For searches: with a size, whether totals have rows of it and its mark; else whether marks are complete."""
        return n in self._sizes(TOTALS, lang, corpus) & self._sizes(MARKS, lang, corpus) if n else self._all_compacted(lang, corpus)

    def search(self, policy: SearchPolicy) -> DataFrame:
        """Reverse-key pairs; which table is read is decided, and errors are raised, at once."""
        sides = [("source", policy.source_lang, policy.source_corpus, policy.source_n), ("target", policy.target_lang, policy.target_corpus, policy.target_n)]
        ready = [self._usable(*s[1:]) for s in sides]
        name = {"raw": RAW, "compact": TOTALS}.get(policy.counts_source, TOTALS if all(ready) else RAW)
        if name == TOTALS:
            for (side, lang, corpus, n), ok in zip(sides, ready, strict=True):
                if ok:
                    continue
                what = f"{side} counts found for lang={lang!r} corpus={corpus!r}" + (f" n={n}" if n else "")
                rows = sum(self._rows(RAW, lang, corpus, n).values())
                if rows:
                    raise RuntimeError(f"No compacted {what}, but {rows} raw rows exist; compact them first or read raw counts.")
                raise RuntimeError(f"No {what}.")
        return pairs.search(self._table(name), policy, compacted=name == TOTALS)

    def statistics(self, lang: str | None = None, corpus: str | None = None, exact: bool = False) -> dict[str, DataFrame]:
        """Tables of statistics by name."""
        raw, compacted, marks = self.raw(), self.totals(), self.marks()
        return {
            "tables": stats.table_counts(raw, compacted, marks),
            "tables_filtered": stats.table_counts(raw, compacted, marks, lang, corpus),
            "by_corpus": stats.stats_by_corpus(raw, exact),
            "by_size": stats.stats_by_size(raw, exact),
            "totals_by_size": stats.stats_by_size(compacted, exact),
            "top": stats.top_rows(raw),
            "compaction": stats.compaction_state(raw, compacted, marks),
        }
