"""Jobs by command line: ``python -m retrograph.jobs <job> --help``.

Options of a job are the fields of its policy, checked when the policy is made,
and where it reads and writes.  Results are folders that Spark writes.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from dataclasses import MISSING, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import lexicon, pairs, phrases, review, tags
from .operators.plausibility import arpa_scorer
from .plans.policies import COUNT_SOURCES, ExportPolicy, NgramPolicy, PhrasePolicy, ReviewPolicy, SearchPolicy
from .sources import readers, writers
from .sources.store import NgramStore

Job = Callable[[SparkSession, argparse.Namespace], object]
_KINDS = {"int": int, "float": float, "str": str, "int | None": int}


def _policy_options(parser: argparse.ArgumentParser, kind: type) -> None:
    for f in fields(kind):
        flag = "--" + f.name.replace("_", "-")
        if f.type == "bool":
            parser.add_argument(flag, action=argparse.BooleanOptionalAction, default=f.default)
        else:
            parser.add_argument(flag, type=_KINDS[f.type], required=f.default is MISSING, default=None if f.default is MISSING else f.default)


def _policy(kind: type, args: argparse.Namespace):
    return kind(**{f.name: getattr(args, f.name) for f in fields(kind)})


def _lang(args: argparse.Namespace) -> str:
    lang = (args.lang or "").strip().lower()
    if not lang:
        raise ValueError("a language is required")
    return lang


def extract(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """Count a file or folder into the store, and compact what it touched."""
    store, lang = NgramStore(spark, args.store), _lang(args)
    docs = readers.read_corpus(spark, args.input, args.format, args.field, args.limit_docs)
    docs = docs.select(F.lit(lang).alias("lang"), F.lit(args.corpus).alias("corpus"), "text")
    policy = _policy(NgramPolicy, args)
    if args.reset:
        store.delete(lang, args.corpus)
    try:
        added = store.add_documents(docs, policy)
    except Exception as e:
        bad = readers.invalid_json_lines(spark, args.input, args.format).orderBy("file", "line").first()
        if bad is None:
            raise
        raise ValueError(f"{bad['file']}, line {bad['line']}: not a JSON object") from e
    return {"added": added, "compacted": store.compact(lang, args.corpus) if args.compact else 0}


def export(spark: SparkSession, args: argparse.Namespace) -> None:
    """Scored counts as tab-separated values, most frequent first."""
    store = NgramStore(spark, args.store)
    writers.write_tsv(store.export(_lang(args), args.corpus, _policy(ExportPolicy, args), args.counts_source), args.out, args.force)


def stats(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    """Statistics of the store, shown and returned."""
    found = NgramStore(spark, args.store).statistics(args.lang, args.corpus, args.exact)
    for name, rows in found.items():
        if args.verbose or name != "top":
            print(name)
            rows.show(100, truncate=False)
    return found


def delete(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """Delete a language's corpus, or all of them."""
    return NgramStore(spark, args.store).delete(_lang(args), args.corpus)


def compact(spark: SparkSession, args: argparse.Namespace) -> int:
    """Sum up one size or all."""
    return NgramStore(spark, args.store).compact(_lang(args), args.corpus, args.n)


def search(spark: SparkSession, args: argparse.Namespace) -> None:
    """Reverse-key pairs of two corpora as tab-separated values."""
    writers.write_tsv(NgramStore(spark, args.store).search(_policy(SearchPolicy, args)), args.out, args.force)


def compose(spark: SparkSession, args: argparse.Namespace) -> None:
    """Phrases of a pair file's pieces; language models weigh 1 unless another weight is given."""
    models = {lang: path for lang, path in ((args.source_lang, args.source_lm), (args.target_lang, args.target_lm)) if path}
    if args.plausibility_weight is None:
        args.plausibility_weight = 1.0 if models else 0.0
    held = readers.read_pairs(spark, args.input)
    for side in ("source", "target"):
        lang = F.col(f"{side}_lang")
        held = held.withColumn(f"{side}_lang", F.when(lang == "", F.lit(getattr(args, f"{side}_lang"))).otherwise(lang))
    zipf = spark.read.schema("lang string, token string, zipf double").option("sep", "\t").csv(args.zipf) if args.zipf else None
    rows = phrases.generate_phrases(held, _policy(PhrasePolicy, args), zipf, arpa_scorer(models) if models else None)
    writers.write_tsv(rows, args.out, args.force, single=True)


def find(spark: SparkSession, args: argparse.Namespace) -> None:
    """Words of a list whose reversal is up to k words of another, or of the same."""
    source, target = (readers.read_lexicon(spark, x).withColumnRenamed("word", "text") for x in (args.source, args.target or args.source))
    writers.write_decompositions(pairs.decompose(source, target, args.pieces), args.out, args.force)


def words(spark: SparkSession, args: argparse.Namespace) -> None:
    """A lexicon from a wiki dump or a dictionary file."""
    if bool(args.dump) == bool(args.dictionary):
        raise ValueError("give a dump or a dictionary")
    if args.dictionary:
        found = lexicon.dictionary_entries(readers.read_dictionary(spark, args.dictionary)).select(F.col("form").alias("word"), "pos")
    else:
        build = {"es": lexicon.spanish_lexicon, "gl": lexicon.galician_lexicon}.get(args.language)
        if build is None:
            raise ValueError(f"no rules for {args.language!r}")
        found = build(readers.read_wiki_dump(spark, args.dump, args.max_pages))
    writers.write_lexicon(found, args.out, args.force)


def candidates(spark: SparkSession, args: argparse.Namespace) -> None:
    """Word sequences that fit tag patterns and agree; what form rules refuse is written beside them."""
    entries = readers.read_json_lexicon(spark, args.lexicon)
    forms = entries.select("form").distinct()
    if args.filter:
        forms, refused = tags.apply_form_rules(entries)
        writers.write_removed(refused, f"{args.out}-filtered", args.force)
    if args.words_only:
        writers.write_lines(forms, "form", args.out, args.force)
        return
    index = tags.tag_index(entries.join(forms, "form", "left_semi"))
    writers.write_lines(tags.candidates(index, (args.pattern or "").split() or None, args.language), "candidate", args.out, args.force)


def reviewed(spark: SparkSession, args: argparse.Namespace) -> None:
    """A pair file within filters, as a reviewer sees it."""
    listed = [readers.read_filter_words(spark, x) if x else None for x in (args.source_words, args.target_words)]
    held = review.filter_pairs(readers.read_pairs(spark, args.input), *listed)
    writers.write_tsv(review.review_table(review.filter_review(held, _policy(ReviewPolicy, args))), args.out, args.force, single=True)


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("retrograph")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run: Job, *policies: type, store: bool = False, out: bool = False, corpus: bool = False) -> argparse.ArgumentParser:
        p = jobs.add_parser(name, help=run.__doc__)
        p.set_defaults(run=run)
        if store:
            p.add_argument("--store", required=True, help="folder of the count store")
        if corpus:
            p.add_argument("--lang", required=True)
            p.add_argument("--corpus", default=None if run is delete else "default")
        if out:
            p.add_argument("--out", required=True)
            p.add_argument("--force", action="store_true", help="overwrite what is there")
        for kind in policies:
            _policy_options(p, kind)
        return p

    p = job("extract", extract, NgramPolicy, store=True, corpus=True)
    p.add_argument("--input", required=True)
    p.add_argument("--format", choices=readers.FORMATS, default="auto")
    p.add_argument("--field", default="text", help="field of jsonl records that holds the text")
    p.add_argument("--limit-docs", type=int, default=0)
    p.add_argument("--reset", action="store_true", help="delete what the corpus has first")
    p.add_argument("--compact", action=argparse.BooleanOptionalAction, default=True)
    job("export", export, ExportPolicy, store=True, corpus=True, out=True).add_argument("--counts-source", choices=COUNT_SOURCES, default="auto")
    p = job("stats", stats, store=True)
    for flag in ("--lang", "--corpus"):
        p.add_argument(flag)
    for flag in ("--exact", "--verbose"):
        p.add_argument(flag, action="store_true")
    job("delete", delete, store=True, corpus=True)
    job("compact", compact, store=True, corpus=True).add_argument("--n", type=int, choices=(0, 1, 2, 3), default=0)
    job("search", search, SearchPolicy, store=True, out=True)
    p = job("phrases", compose, PhrasePolicy, out=True)
    p.set_defaults(plausibility_weight=None)
    p.add_argument("--input", required=True)
    p.add_argument("--zipf", help="word frequencies: language, word, frequency, tab-separated")
    for side, lang in (("source", "es"), ("target", "pt")):
        p.add_argument(f"--{side}-lang", default=lang)
        p.add_argument(f"--{side}-lm", help="ARPA file")
    p = job("find", find, out=True)
    p.add_argument("--source", required=True)
    p.add_argument("--target")
    p.add_argument("--pieces", type=int, default=1)
    p = job("lexicon", words, out=True)
    for flag in ("--dump", "--dictionary"):
        p.add_argument(flag)
    p.add_argument("--language", default="es")
    p.add_argument("--max-pages", type=int, default=0)
    p = job("candidates", candidates, out=True)
    p.add_argument("--lexicon", required=True)
    p.add_argument("--language", default="es")
    p.add_argument("--pattern", help="tag patterns between blanks; none takes every tag")
    for flag in ("--filter", "--words-only"):
        p.add_argument(flag, action="store_true")
    p = job("review", reviewed, ReviewPolicy, out=True)
    p.add_argument("--input", required=True)
    for flag in ("--source-words", "--target-words"):
        p.add_argument(flag, help="texts with these words are left out")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> object:
    """Run a job; its result, where it has one."""
    args = _parser().parse_args(argv)
    own = spark is None
    spark = spark or SparkSession.builder.appName(f"retrograph-{args.job}").getOrCreate()
    try:
        return args.run(spark, args)
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    result = main(sys.argv[1:])
    if isinstance(result, (int, dict)) and not isinstance(result, bool):
        print(result)
