"""The engine's own queries over the tables of a folder, and SQL with the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lang as L
from ..functions import text as T
from ..operators import lexicon, ngrams, pairs, phrases, review, stats, tags, vectors
from ..sources import readers, scratch, writers
from ..sources.store import NgramStore
from ..streaming.ingest import count_stream, document_stream
from . import oracle as O
from .policies import ExportPolicy, NgramPolicy, PhrasePolicy, ReviewPolicy, SearchPolicy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

_DOCS = "SELECT lang, 'docs' AS corpus, text FROM documents"


def _of(*langs: str) -> str:
    return _DOCS + f" WHERE lang IN ({', '.join(repr(x) for x in sorted(set(langs)))})"


_BY_SOURCE = "SELECT lang, source AS corpus, text FROM documents"


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(docs: DataFrame) -> DataFrame:
    """Enough partitions for the work that follows, where the input came as a few large files."""
    spark = docs.sparkSession
    wanted = spark.sparkContext.defaultParallelism
    return docs.repartition(2 * wanted) if docs.rdd.getNumPartitions() < wanted else docs


def documents(spark: SparkSession, sf: str, corpus: str | None = None) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select("lang", "source", "text"))
    return docs.select("lang", (F.col("source") if corpus is None else F.lit(corpus)).alias("corpus"), "text")


def counts(spark: SparkSession, sf: str, corpus: str | None = "docs", policy: NgramPolicy = NgramPolicy(), langs: tuple[str, ...] = ()) -> DataFrame:
    docs = documents(spark, sf, corpus)
    return ngrams.count_ngrams(docs.where(F.col("lang").isin(*langs)) if langs else docs, policy)


def sides(spark: SparkSession, sf: str, source: str, target: str) -> DataFrame:
    """Counts of two languages, as far as they can be in pairs."""
    return ngrams.count_pairable(documents(spark, sf, "docs"), source, target)


# Text


@query(f"SELECT doc_id, {O.clean('text')} AS cleaned FROM documents")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", T.clean(F.col("text")).alias("cleaned"))


@query(f"SELECT page_id, {O.spaced(O.no_urls('url'))} AS url_rest, md5({O.no_urls('html')}) AS html_without_urls, md5({O.clean('html')}) AS html_cleaned FROM pages")
def url_marker_cleaning(spark: SparkSession, sf: str) -> DataFrame:
    url, html = F.col("url"), F.col("html")
    return table(spark, sf, "pages").select("page_id", T.normalize_spacing(T.remove_urls(url)).alias("url_rest"), F.md5(T.remove_urls(html)).alias("html_without_urls"), F.md5(T.clean(html)).alias("html_cleaned"))


LITERALS = ["A casa {{marca}} https://example.com. O caminho [[nota]]", "see http://x.y/a... then www.b.c/d?e!", "www.... [a\nb] [[c]] {{d\ne}}", "# title", "tab\tand nbsp em", "http://", "[http://x]", "  ", "ÀÉ Ñandú coração å š ő"]


@query(
    f"SELECT k, {O.no_urls('s')} AS no_urls, {O.no_markers('s')} AS no_markers, {O.spaced('s')} AS spaced, {O.clean('s')} AS cleaned, {O.plain('lower(s)')} AS plain, {O.key('s')} AS norm_key, reverse({O.key('s')}) AS reversed_key FROM (VALUES "
    + ", ".join("({}, {})".format(k, "'" + s.replace("'", "''") + "'") for k, s in enumerate(LITERALS))
    + ") v(k, s)"
)
def cleaning_literals(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("s")
    rows = spark.createDataFrame(list(enumerate(LITERALS)), "k int, s string")
    return rows.select("k", T.remove_urls(s).alias("no_urls"), T.remove_markers(s).alias("no_markers"), T.normalize_spacing(s).alias("spaced"), T.clean(s).alias("cleaned"), T.strip_accents(F.lower(s)).alias("plain"), T.norm_key(s).alias("norm_key"), T.reversed_key(T.norm_key(s)).alias("reversed_key"))


@query(f"WITH {O.chunks(_DOCS)} SELECT lang, chunk, count(*) AS occurrences FROM chunked GROUP BY ALL")
def sentence_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return ngrams.chunk_rows(documents(spark, sf, "docs")).groupBy("lang", "chunk").agg(F.count("*").alias("occurrences"))


_TOKENS = f"WITH {O.chunks(_DOCS)}, words AS (SELECT lang, unnest(regexp_extract_all(lower(chunk), '{O._WORD}')) AS token FROM chunked)"


@query(f"{_TOKENS} SELECT lang, token, count(*) AS occurrences FROM words GROUP BY ALL")
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ngrams.token_rows(documents(spark, sf, "docs")).select("lang", F.explode("tokens").alias("token")).groupBy("lang", "token").agg(F.count("*").alias("occurrences"))


@query(
    f"{_TOKENS} SELECT DISTINCT lang, token, {O.key('token')} AS norm_key, {O.plain('token')} AS plain, length(token) <= 30 AND (length(token) >= 2 OR list_contains({O.by_language(L.ONE_LETTER, 'lang')}, {O.plain('token')})) AS valid, list_contains({O.by_language(L.STOPWORDS, 'lang')}, {O.plain('token')}) AS stopword FROM words"
)
def norm_key_tokens(spark: SparkSession, sf: str) -> DataFrame:
    words = ngrams.token_rows(documents(spark, sf, "docs")).select("lang", F.explode("tokens").alias("token")).distinct()
    token, lang = F.col("token"), F.col("lang")
    return words.select("lang", "token", T.norm_key(token).alias("norm_key"), T.strip_accents(token).alias("plain"), ngrams.token_valid(token, lang).alias("valid"), ngrams.is_stopword(token, lang).alias("stopword"))


# Counts


@query(f"WITH {O.counts(_DOCS)} SELECT * FROM counts")
def ngram_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts(spark, sf)


@query(f"WITH {O.counts(_DOCS, stopwords=False)} SELECT * FROM counts")
def ngram_counts_with_stopword_ngrams(spark: SparkSession, sf: str) -> DataFrame:
    return counts(spark, sf, policy=NgramPolicy(include_all_stopword_ngrams=True))


_PARTIAL = O.counts(_BY_SOURCE)


@query(f"WITH {_PARTIAL} SELECT lang, 'docs' AS corpus, text, n, CAST(sum(count) AS BIGINT) AS count, norm_key FROM counts GROUP BY ALL")
def ngram_partial_compaction(spark: SparkSession, sf: str) -> DataFrame:
    """Partial counts of each source, summed up as one corpus."""
    return ngrams.totals_by_text(counts(spark, sf, None).withColumn("corpus", F.lit("docs")))


@query(f"WITH {O.counts(_DOCS)} SELECT lang, corpus, text, n, count, {O.score('string_split(text, chr(32))', 'count', 'lang')} AS score, norm_key FROM counts WHERE lang = 'es' AND count >= 2")
def ngram_scored_export(spark: SparkSession, sf: str) -> DataFrame:
    return ngrams.export_ngrams(counts(spark, sf), ExportPolicy(min_count=2), lang="es", corpus="docs", compacted=True)


@query(f"WITH {O.counts(_DOCS)} SELECT lang, corpus, text, n, count, {O.score('string_split(text, chr(32))', 'count', 'lang')} AS score, norm_key FROM counts WHERE lang = 'en' AND n = 2 AND length(norm_key) BETWEEN 5 AND 8 ORDER BY count DESC, text, n, norm_key LIMIT 200")
def ngram_export_n_normlen(spark: SparkSession, sf: str) -> DataFrame:
    return ngrams.export_ngrams(counts(spark, sf), ExportPolicy(limit=200, n=2, min_norm_len=5, max_norm_len=8), lang="en", corpus="docs")


def _stats_sql(keys: str) -> str:
    return f"WITH {_PARTIAL} SELECT {keys}, count(*) AS row_count, CAST(sum(count) AS BIGINT) AS occurrences, count(DISTINCT text) AS distinct_texts FROM counts GROUP BY {keys}"


@query(_stats_sql("lang, corpus"))
def stats_by_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return stats.stats_by_corpus(counts(spark, sf, None), exact=True, summed=True)


@query(_stats_sql("lang, corpus, n"))
def stats_by_size(spark: SparkSession, sf: str) -> DataFrame:
    return stats.stats_by_size(counts(spark, sf, None), exact=True, summed=True)


@query(f"WITH {_PARTIAL}, t AS (SELECT lang, 'docs' AS corpus, text, n, sum(count) AS count FROM counts GROUP BY ALL) SELECT lang, corpus, n, count(*) AS row_count, CAST(sum(count) AS BIGINT) AS occurrences, count(DISTINCT text) AS distinct_texts FROM t GROUP BY ALL")
def totals_stats_by_size(spark: SparkSession, sf: str) -> DataFrame:
    return stats.stats_by_size(ngram_partial_compaction(spark, sf), exact=True, summed=True)


@query(f"WITH {_PARTIAL} SELECT * FROM counts ORDER BY count DESC, lang, corpus, text, n, norm_key LIMIT 20")
def top_raw_rows(spark: SparkSession, sf: str) -> DataFrame:
    return stats.top_rows(counts(spark, sf, None), 20)


@query(f"WITH {_PARTIAL}, t AS (SELECT lang, text, n FROM counts GROUP BY ALL), m AS (SELECT DISTINCT lang, n FROM counts) SELECT 'ngram_counts' AS table_name, count(*) AS row_count FROM counts UNION ALL SELECT 'ngram_totals', count(*) FROM t UNION ALL SELECT 'ngram_compactions', count(*) FROM m")
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.compacted_counts(counts(spark, sf, None))


@query(f"WITH {_PARTIAL} SELECT DISTINCT lang, corpus, n FROM counts")
def distinct_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return stats.sizes(counts(spark, sf, None))


# Pairs


def _pair_query(name: str, source: str, target: str, limit: int = 0, least: tuple[int, int] = (1, 1), n: tuple[int, int] = (0, 0), lengths: tuple[int, int] = (0, 0), palindromes: bool = False, identical: bool = False) -> None:
    tests = [f"{a}.n = {k}" for a, k in zip("ab", n, strict=True) if k] + [f"length({a}.norm_key) {op} {v}" for a in "ab" for op, v in ((">=", lengths[0]), ("<=", lengths[1])) if v]
    sql = f"WITH {O.counts(_of(source, target), paired=True)} " + O.pairs(source, target, least=least, palindromes=palindromes, identical=identical, where=" AND ".join(tests) or "TRUE")
    if limit:
        sql += f" ORDER BY {O.PAIR_ORDER} LIMIT {limit}"

    def run(spark: SparkSession, sf: str) -> DataFrame:
        own = sides(spark, sf, source, target)
        both = [ngrams.select_counts(own, lang=lang, n=k, min_norm_len=lengths[0], max_norm_len=lengths[1], min_count=c, compacted=True) for lang, k, c in zip((source, target), n, least, strict=True)]
        return pairs.ordered_pairs(pairs.reverse_pairs(*both, palindromes=palindromes, identical=identical), limit)

    query(sql, name)(run)


_pair_query("reverse_pairs_es_en", "es", "en")
_pair_query("reverse_pairs_es_fr", "es", "fr")
_pair_query("reverse_pairs_en_fr", "en", "fr")
_pair_query("reverse_pairs_with_palindromes", "es", "en", palindromes=True)
_pair_query("reverse_pairs_same_language_identical", "en", "en", palindromes=True, identical=True)
_pair_query("reverse_pairs_same_language", "en", "en", palindromes=True)
_pair_query("reverse_pairs_same_language_without_palindromes", "en", "en")
_pair_query("reverse_pairs_palindromes_across", "es", "fr", palindromes=True)
_pair_query("reverse_pairs_top_k", "en", "fr", limit=25, least=(2, 2))
_pair_query("reverse_pairs_sizes_lengths", "en", "fr", n=(1, 2), lengths=(4, 8))


def _word_sql(lang: str) -> str:
    return f"SELECT DISTINCT token AS text FROM words WHERE lang = '{lang}' AND length(token) >= 2"


def _words(spark: SparkSession, sf: str, lang: str) -> DataFrame:
    docs = documents(spark, sf, "docs").where(F.col("lang") == lang)
    return ngrams.token_rows(docs).select(F.explode("tokens").alias("text")).distinct().where(F.length("text") >= 2)


def _decompose_query(name: str, source: str, target: str, k: int) -> None:
    inner = O.decompositions(_word_sql(source), _word_sql(target), k)
    sql = _TOKENS.replace("WITH ", "WITH RECURSIVE ", 1) + ", " + inner.removeprefix("WITH RECURSIVE ")
    query(sql, name)(lambda spark, sf: pairs.decompose(_words(spark, sf, source), _words(spark, sf, target), k))


_decompose_query("decompose_k1", "en", "fr", 1)
_decompose_query("decompose_k2", "en", "fr", 2)
_decompose_query("decompose_k3", "es", "en", 3)


@query(f"WITH d AS ({_TOKENS.replace('WITH ', 'WITH RECURSIVE ', 1)}, {O.decompositions(_word_sql('en'), _word_sql('fr'), 2).removeprefix('WITH RECURSIVE ')}) SELECT source, word_count, CAST(to_json(list_sort(list(phrase))) AS VARCHAR) AS phrases FROM d GROUP BY source, word_count")
def decompose_grouped(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.grouped(pairs.decompose(_words(spark, sf, "en"), _words(spark, sf, "fr"), 2)).withColumn("phrases", F.to_json("phrases"))


# Phrases

#: Phrase generation and review start from all pairs.
_PIECES_SQL = f"WITH {O.counts(_of('es', 'en'), paired=True)}, pairs AS ({O.pairs('es', 'en')}), pieces_in AS (SELECT CAST(row_number() OVER (ORDER BY {O.PAIR_ORDER}) - 1 AS BIGINT) AS id, * FROM pairs)"
_LOW = dict(min_source_count=1, min_target_count=1)


def _all_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs, numbered from 0 in their order; the order's ranges are numbered apart and then put end to end."""
    own = sides(spark, sf, "es", "en")
    found = pairs.reverse_pairs(*(ngrams.select_counts(own, lang=x, compacted=True) for x in ("es", "en")))
    rows = scratch.cut(pairs.ordered_pairs(found).withColumn("at", F.monotonically_increasing_id()))
    rows = rows.withColumn("range", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    before = F.sum("size").over(Window.orderBy("range")) - F.col("size")  # a row for each range
    starts = rows.groupBy("range").agg(F.count("*").alias("size")).select("range", before.alias("start"))
    return rows.join(F.broadcast(starts), "range").withColumn("id", F.col("start") + F.col("at")).drop("range", "at", "start")


@query(f"{_PIECES_SQL}, u AS ({O.pieces(PhrasePolicy(**_LOW))}) SELECT id, source_text, target_text, pair_score, source_count, target_count, source_n, target_n, source_norm_key, target_norm_key, round(quality, 6) AS quality FROM u")
def piece_filter_topk(spark: SparkSession, sf: str) -> DataFrame:
    kept = phrases.filter_pieces(_all_pairs(spark, sf), PhrasePolicy(**_LOW))
    return kept.select(*phrases.PIECE[:10], F.round("quality", 6).alias("quality"))


@query(f"{_PIECES_SQL} SELECT id, CAST({O.fragment('source_text', 'source_lang', 6.0)} AS DOUBLE) AS source_fragment, CAST({O.fragment('target_text', 'target_lang', 6.0)} AS DOUBLE) AS target_fragment FROM pieces_in")
def piece_penalties(spark: SparkSession, sf: str) -> DataFrame:
    return _all_pairs(spark, sf).select("id", *(phrases.fragment_penalty(F.col(f"{s}_text"), F.col(f"{s}_lang"), PhrasePolicy()).alias(f"{s}_fragment") for s in ("source", "target")))


def _phrase_query(name: str, policy: PhrasePolicy) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = phrases.generate_phrases(_all_pairs(spark, sf), policy)
        return out.select(*(F.to_json(c).alias(c) if c in ("pieces", "piece_ids", "source_counts", "target_counts") else F.col(c) for c in out.columns))

    query(f"{_PIECES_SQL}, {O.phrases(policy)}", name)(run)


_phrase_query("phrase_k2", PhrasePolicy(**_LOW))
_phrase_query("phrase_k3", PhrasePolicy(**_LOW, min_pieces=1, max_pieces=3))
_phrase_query("phrase_keep_permutations", PhrasePolicy(**_LOW, collapse_permutations=False))
_phrase_query("phrase_repeated_pieces", PhrasePolicy(**_LOW, allow_repeated_pieces=True))


# Review


@query(f"{_PIECES_SQL} SELECT {', '.join(review.TABLE)} FROM pieces_in WHERE contains(lower(source_text), 'a') AND pair_score >= 1.5 AND target_n = 1 ORDER BY pair_score DESC, source_count DESC, target_count DESC, source_text, target_text LIMIT 500")
def review_filter(spark: SparkSession, sf: str) -> DataFrame:
    return review.review_table(review.filter_review(_all_pairs(spark, sf), ReviewPolicy(source_contains=" A ", min_pair_score=1.5, target_n=1)))


@query(f"{_PIECES_SQL} SELECT id, source_norm_key, target_norm_key, reverse(source_norm_key) AS reversed_source_key, CASE WHEN reverse(source_norm_key) = target_norm_key THEN 'match' ELSE 'mismatch' END AS status FROM pieces_in")
def review_key_check(spark: SparkSession, sf: str) -> DataFrame:
    return review.key_check(_all_pairs(spark, sf)).select("id", "source_norm_key", "target_norm_key", "reversed_source_key", "status")


@query(
    f"{_PIECES_SQL} SELECT id, '## ' || source_text || ' ⇄ ' || target_text || chr(10) || chr(10) || '| Count | `' || source_count || '` | `' || target_count || '` |' AS part FROM pieces_in"
)
def review_detail(spark: SparkSession, sf: str) -> DataFrame:
    lines = F.split("detail", "\n")
    return review.detail(_all_pairs(spark, sf)).select("id", F.concat_ws("\n", lines[0], lines[1], lines[8 + 1]).alias("part"))


LISTED = ["de", "la", "on", "no", "te", "se", "la mar"]
_LISTED_SQL = O.strings(LISTED)


@query(f"WITH {O.counts(_DOCS)} SELECT lang, text FROM counts WHERE n > 1 AND len(list_filter(flatten([[array_to_string(string_split(text, ' ')[i:j], ' ') FOR j IN range(i, n + 1)] FOR i IN range(1, n + 1)]), lambda x: list_contains({_LISTED_SQL}, x))) = 0")
def word_list_filter(spark: SparkSession, sf: str) -> DataFrame:
    """N-grams of several words without a listed stretch of words."""
    rows = counts(spark, sf).where("n > 1").select("lang", F.col("text").alias("source_text"))
    return review.drop_listed(rows, spark.createDataFrame([(w,) for w in LISTED], "word string"), "source").select("lang", F.col("source_text").alias("text"))


@query(f"{_PIECES_SQL} SELECT id, source_text, target_text FROM pieces_in WHERE len(string_split(source_text, ' ')) = 1 AND len(string_split(target_text, ' ')) = 2")
def ngram_size_filter(spark: SparkSession, sf: str) -> DataFrame:
    return review.filter_pairs(_all_pairs(spark, sf), source_n=1, target_n=2).select("id", "source_text", "target_text")


# Tags and lexicons

LEXICON = [("el", "el", "DA0MS0"), ("la", "el", "DA0FS0"), ("los", "el", "DA0MP0"), ("su", "su", "DP3CSN"), ("casa", "casa", "NCFS000"), ("casas", "casa", "NCFP000"), ("perro", "perro", "NCMS000"), ("crisis", "crisis", "NCFN000"), ("azul", "azul", "AQ0CS0"), ("rojo", "rojo", "AQ0MS0"), ("roja", "rojo", "AQ0FS0"), ("correr", "correr", "VMN0000"), ("corre", "correr", "VMIP3S0"), ("rápido", "rápido", "RG"), ("ex-novio", "ex-novio", "NCMS000"), ("sr.", "sr.", "NCMS000"), ("a€", "a€", "Zu"), ("x-y.z€", "x", "W"), ("3", "3", "Z"), ("de", "de", "SP"), ("y", "y", "CC"), ("ay", "ay", "I"), ("él", "él", "PP3MSN0"), ("raro", "raro", "")]
_LEX_SQL = "(SELECT * FROM (VALUES " + ", ".join(f"('{f}', '{m}', '{t}')" for f, m, t in LEXICON) + ") v(form, lemma, tag))"


def inline_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "form string, lemma string, tag string")


def _feature_sql(name: str, lang: str, tag: str) -> str:
    cases = " ".join(f"WHEN '{pos}' THEN {slots[name] + 1}" for pos, slots in sorted(L.FEATURE_SLOTS[lang].items()) if name in slots)
    return f"nullif(nullif(substr({tag}, CASE {tag}[1] {cases} END, 1), ''), '0')"


def _agree_sql(a: str, b: str, lang: str) -> str:
    tests = []
    for name, wild in L.WILDCARDS[lang].items():
        x, y = _feature_sql(name, lang, a), _feature_sql(name, lang, b)
        tests.append(f"coalesce({x} = {y} OR {x} IN {tuple(wild) if len(wild) > 1 else f'({wild[0]!r})'} OR {y} IN {tuple(wild) if len(wild) > 1 else f'({wild[0]!r})'}, TRUE)")
    return f"({a}[1] NOT IN ('A', 'D', 'N') OR {b}[1] NOT IN ('A', 'D', 'N') OR ({' AND '.join(tests)}))"


@query("SELECT form, tag, CASE tag[1] " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.COARSE_POS.items()) + f" ELSE 'UNK' END AS pos, CASE {' '.join(f'WHEN starts_with(tag, {p!r}) THEN {n!r}' for p, n in L.POS_LABELS)} END AS label FROM {_LEX_SQL}")
def pos_names(spark: SparkSession, sf: str) -> DataFrame:
    return inline_lexicon(spark).select("form", "tag", tags.coarse_pos(F.col("tag")).alias("pos"), tags.pos_label(F.col("tag")).alias("label"))


@query(f"SELECT form, {', '.join(f'{_feature_sql(n, lang, chr(116) + chr(97) + chr(103))} AS {n}_{lang}' for lang in ('es', 'gl') for n in ('gender', 'number', 'person', 'type'))} FROM {_LEX_SQL}")
def tag_features(spark: SparkSession, sf: str) -> DataFrame:
    return inline_lexicon(spark).select("form", *(tags.feature(F.col("tag"), n, lang).alias(f"{n}_{lang}") for lang in ("es", "gl") for n in ("gender", "number", "person", "type")))


@query(f"SELECT form, array_to_string(list_filter([CASE WHEN contains(form, '-') THEN 'hyphenated' END, CASE WHEN contains(form, '.') THEN 'dotted' END, CASE WHEN NOT regexp_full_match(form, '[\\p{{L}}\\p{{N}}\\p{{Z}}]*') THEN 'unicode_symbol' END], lambda x: x IS NOT NULL), ',') AS reasons FROM {_LEX_SQL}")
def form_rules(spark: SparkSession, sf: str) -> DataFrame:
    return inline_lexicon(spark).select("form", F.array_join(tags.form_reasons(F.col("form")), ",").alias("reasons"))


PATTERNS = ["NCXSXXX", "DXXXXX", "AQ0XS0", "RG", "X", "VMIP3S0"]


@query(f"SELECT DISTINCT p AS pattern, tag FROM {_LEX_SQL}, (SELECT unnest({O.strings(PATTERNS)}) AS p) WHERE tag LIKE replace(p, 'X', '_') AND tag <> ''")
def tag_pattern_match(spark: SparkSession, sf: str) -> DataFrame:
    index = tags.tag_index(inline_lexicon(spark)).select("tag").distinct()
    wanted = spark.createDataFrame([(p,) for p in PATTERNS], "pattern string")
    return index.crossJoin(F.broadcast(wanted)).where(tags.matches(F.col("tag"), F.col("pattern"))).select("pattern", "tag")  # a handful of patterns


@query(f"WITH t AS (SELECT DISTINCT tag FROM {_LEX_SQL} WHERE tag <> '') SELECT a.tag AS left_tag, b.tag AS right_tag, {_agree_sql('a.tag', 'b.tag', 'es')} AS agree_es, {_agree_sql('a.tag', 'b.tag', 'gl')} AS agree_gl FROM t a, t b")
def agreement_pairs(spark: SparkSession, sf: str) -> DataFrame:
    t = tags.tag_index(inline_lexicon(spark)).select("tag").distinct()
    both = t.select(F.col("tag").alias("left_tag")).crossJoin(t.select(F.col("tag").alias("right_tag")))
    return both.select("left_tag", "right_tag", *(tags.agree(F.col("left_tag"), F.col("right_tag"), x).alias(f"agree_{x}") for x in ("es", "gl")))


@query(f"WITH t AS (SELECT DISTINCT tag, form FROM {_LEX_SQL} WHERE tag <> '') SELECT a.form || ' ' || b.form || ' ' || c.form AS candidate FROM t a, t b, t c WHERE a.tag LIKE 'D_____' AND b.tag LIKE 'NC_____' AND c.tag LIKE 'AQ____' AND {_agree_sql('a.tag', 'b.tag', 'es')} AND {_agree_sql('b.tag', 'c.tag', 'es')}")
def pattern_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return tags.candidates(tags.tag_index(inline_lexicon(spark)), ["DXXXXX", "NCXXXXX", "AQXXXX"], "es").select("candidate")


TAGGED = ["casa casa NCFS000 0.9", "corre correr VMIP3S0 0.8", "casa casar VMIP3S0 0.1", "", "short line", "azul azul AQ0CS0"]
_TAGGED_SQL = "SELECT w, lemma, pos, conf FROM (VALUES ('casa', 'casar', 'VMIP3S0', 0.1::DOUBLE), ('corre', 'correr', 'VMIP3S0', 0.8::DOUBLE), ('azul', 'azul', 'AQ0CS0', NULL)) v(w, lemma, pos, conf)"


@query(f"SELECT l.form AS word, l.tag AS original_pos, t.pos, t.lemma, t.conf, CASE WHEN t.pos LIKE 'VMN%' THEN 'verbo' WHEN t.pos LIKE 'VM%' THEN 'forma' WHEN t.pos LIKE 'AQ%' THEN 'adjetivo' END AS label FROM {_LEX_SQL} l LEFT JOIN ({_TAGGED_SQL}) t ON l.form = t.w")
def tag_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    lines = spark.createDataFrame(list(enumerate(TAGGED)), "ord bigint, value string")
    words = inline_lexicon(spark).select(F.col("form").alias("word"), F.col("tag").alias("original_pos"))
    return tags.enrich(words, tags.parse_tagger(lines))


DICTIONARY = ["casa casa NCFS000 casar VMIP3S0", "odd lemma", "  azul  azul AQ0CS0 ", "", "casa casa NP00000", "solo"]


@query("SELECT * FROM (VALUES ('casa', 'freeling', 'casa', 'NOUN', 'NCFS000'), ('casa', 'freeling', 'casar', 'VERB', 'VMIP3S0'), ('azul', 'freeling', 'azul', 'ADJ', 'AQ0CS0'), ('casa', 'freeling', 'casa', 'NOUN', 'NP00000')) v(form, source, lemma, pos, tag)")
def dictionary_analyses(spark: SparkSession, sf: str) -> DataFrame:
    lines = spark.createDataFrame(list(enumerate(DICTIONARY)), "ord bigint, value string")
    return lexicon.dictionary_entries(lines).drop("ord")


WIKI = [
    ("0", " Casa ", "== {{lengua|es}} ==\n=== {{sustantivo femenino|es}} ===\ntext\n==== Forma verbal ====\n=== Etimología ===\n== {{lengua|fr}} ==\n=== Verbo ===\n"),
    ("0", "rien", "== {{lengua|fr}} ==\n=== Adverbio ===\n"),
    ("10", "Plantilla", "== {{lengua|es}} ==\n=== Verbo ===\n"),
    ("0", "cantar", "{{-gl-}}\n{{son|||gl}}\n{{-verbo-|gl}}\n{{conx.gl.ar|cant}}"),
    ("0", "partir", "{{-gl-}}\n{{son|||gl}}\n{{-verbo-}}\n{{conx.gl.ir|}}"),
    ("0", "ser", "{{-glref-}}\n{{son|||gl}}\n{{-verboirr-|gl}}\n{{conx.gl.ser|}}"),
    ("0", "can", "{{-gl-}}\n{{son|||gl}}\n{{-substm-|gl}}"),
    ("10", "Modelo:conx.gl.ar", "{{gl|{{{1}}}o}} {{gl|{{{1}}}as}} {{gl|{{{2}}}ei}}"),
    ("10", "Modelo:conx.gl.ir", "{{gl|{{{1}}}o}} {{gl|{{{1}}}es}}"),
    ("10", "Modelo:conx.gl.ser", "{{gl|son}} {{gl|es}} {{gl|é}} {{gl|no-pe}}"),
]


@query("SELECT * FROM (VALUES ('casa', 'sustantivo'), ('casa', 'forma')) v(word, pos)")
def spanish_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon.spanish_lexicon(spark.createDataFrame(WIKI, "ns string, title string, text string"))


@query("SELECT * FROM (VALUES ('cantar', 'verbo'), ('canto', 'forma_verbal'), ('cantas', 'forma_verbal'), ('partir', 'verbo'), ('parto', 'forma_verbal'), ('partes', 'forma_verbal'), ('ser', 'verbo'), ('son', 'forma_verbal'), ('es', 'forma_verbal'), ('é', 'forma_verbal'), ('can', 'sustantivo')) v(word, pos)")
def galician_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon.galician_lexicon(spark.createDataFrame(WIKI, "ns string, title string, text string"))


# The store and files

_STORE = f"WITH {O.counts(_DOCS)}"
_HALVES = ("n_chars < 500", "n_chars >= 500 OR n_chars IS NULL")
_HALF_SQL = [f"SELECT lang, 'docs' AS corpus, text FROM documents WHERE {half}" for half in _HALVES]


def _folder(spark: SparkSession, label: str) -> str:
    """A new folder that all executors share."""
    return f"{scratch.shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _halves(spark: SparkSession, sf: str) -> list[DataFrame]:
    """All documents, the short ones and then the others, as they would come one after another."""
    rows = spread(table(spark, sf, "documents").select("lang", "n_chars", "text"))
    return [rows.where(half).select("lang", F.lit("docs").alias("corpus"), "text") for half in _HALVES]


def _filled(spark: SparkSession, sf: str) -> NgramStore:
    store = NgramStore(spark, _folder(spark, "store"))
    for docs in _halves(spark, sf):
        store.add_documents(docs)
    return store


@query(f"{_STORE} SELECT lang, corpus, text, n, count, norm_key FROM counts")
def store_append_compact(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends, compacted one size of one language first and then all, read as totals."""
    store = _filled(spark, sf)
    store.compact("en", "docs", 2)
    for lang in sorted({lang for lang, *_ in store.partitions("ngram_counts")}):
        store.compact(lang, "docs")
    return store.totals()


@query(f"{_STORE} SELECT lang, corpus, text, n, count, {O.score('string_split(text, chr(32))', 'count', 'lang')} AS score, norm_key FROM counts WHERE lang = 'en' AND count >= 2")
def store_export_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Raw partial counts of two appends, summed up by the export."""
    return _filled(spark, sf).export("en", "docs", ExportPolicy(min_count=2))


@query(f"""WITH first AS (WITH {O.counts(_HALF_SQL[0])} SELECT lang, corpus, n, count(*) AS rows FROM counts GROUP BY ALL),
second AS (WITH {O.counts(_HALF_SQL[1])} SELECT lang, corpus, n, count(*) AS rows FROM counts GROUP BY ALL)
SELECT lang, corpus, n, coalesce(f.rows, 0) + coalesce(s.rows, 0) AS raw_rows, CASE WHEN s.rows IS NULL THEN f.rows ELSE 0 END AS total_rows, s.rows IS NULL AS compacted FROM first f FULL JOIN second s USING (lang, corpus, n)""")
def store_append_invalidates(spark: SparkSession, sf: str) -> DataFrame:
    """Compacted after the first append; the second drops what it touches."""
    store = NgramStore(spark, _folder(spark, "store"))
    first, second = _halves(spark, sf)
    store.add_documents(first)
    for lang in sorted({lang for lang, *_ in store.partitions("ngram_counts")}):
        store.compact(lang, "docs")
    store.add_documents(second)
    state = store.statistics()["compaction"]
    return state.select("lang", "corpus", "n", "raw_rows", "total_rows", F.col("compacted_at").isNotNull().alias("compacted"))


@query(f"WITH {O.counts(_BY_SOURCE)} SELECT lang, corpus, n, count(*) AS row_count FROM counts WHERE lang <> 'en' GROUP BY ALL")
def store_delete(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of all corpora without one language."""
    store = NgramStore(spark, _folder(spark, "store"))
    store.add_documents(documents(spark, sf))
    store.delete("en")
    return store.raw().groupBy("lang", "corpus", "n").agg(F.count("*").alias("row_count"))


@query(f"{_STORE} SELECT lang, corpus, text, n, count, norm_key FROM counts")
def store_reset(spark: SparkSession, sf: str) -> DataFrame:
    """Added twice, the second time after a reset."""
    store = NgramStore(spark, _folder(spark, "store"))
    for reset in (False, True):
        store.add_documents(documents(spark, sf, "docs"), reset=reset)
    return store.raw()


@query(f"WITH {O.counts(_of('es', 'en'), paired=True)} " + O.pairs("es", "en", where="a.n = 1"))
def store_search(spark: SparkSession, sf: str) -> DataFrame:
    """Reverse-key pairs of the store, one side compacted: 'auto' reads raw counts."""
    store = _filled(spark, sf)
    store.compact("es", "docs")
    return store.search(SearchPolicy("es", "docs", "en", "docs", 1, 1, source_n=1))


@query(f"WITH {O.counts(_of('en', 'fr'), paired=True)} " + O.pairs("en", "fr", least=(2, 2)))
def store_search_compacted(spark: SparkSession, sf: str) -> DataFrame:
    store = _filled(spark, sf)
    for lang in ("en", "fr"):
        store.compact(lang, "docs")
    return store.search(SearchPolicy("en", "docs", "fr", "docs", 2, 2, counts_source="compact"))


_LINES = "SELECT lang, 'docs' AS corpus, unnest(string_split_regex(text, '\\r\\n|\\n|\\r')) AS text FROM documents WHERE lang = 'fr'"


@query(f"WITH {O.counts(_LINES)} SELECT lang, corpus, text, n, count, norm_key FROM counts")
def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Text files of all French documents, taken into a store as a stream in several batches, then compacted."""
    folder = _folder(spark, "arriving")
    rows = table(spark, sf, "documents").where("lang = 'fr' and text is not null")
    rows.select(F.col("text").alias("value")).repartition(4).write.text(folder)
    store = NgramStore(spark, _folder(spark, "store"))
    arriving = document_stream(spark, folder, "fr", "docs", files_per_trigger=2)
    count_stream(arriving, store, _folder(spark, "progress")).awaitTermination()
    store.compact("fr", "docs")
    return store.totals()


@query("SELECT text, count(*) AS records FROM documents WHERE text <> '' GROUP BY text")
def corpus_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    """All documents through a jsonl corpus."""
    path = _folder(spark, "corpus")
    writers.write_corpus_jsonl(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), path)
    return readers.read_corpus(spark, path).groupBy("text").agg(F.count("*").alias("records"))


@query("SELECT text, count(*) AS records FROM (SELECT unnest(string_split_regex(trim(text, ' '), '\\r\\n|\\n|\\r')) AS text FROM documents WHERE trim(text, ' ') <> '') GROUP BY text")
def corpus_text(spark: SparkSession, sf: str) -> DataFrame:
    """All documents through a text corpus: a record for each line."""
    path = _folder(spark, "corpus")
    writers.write_corpus_text(table(spark, sf, "documents").select("text"), path)
    return readers.read_corpus(spark, path, "txt").groupBy("text").agg(F.count("*").alias("records"))


@query("SELECT k AS line, 'record ' || k AS text FROM range(1, 26) r(k)")
def corpus_first_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The first records of a corpus in the order of its lines, with their numbers."""
    path = _folder(spark, "corpus")
    spark.range(1, 1001, 1, 1).select(F.concat(F.lit("record "), "id").alias("value")).write.text(path)
    first = readers.read_corpus(spark, path, limit_docs=25).select("text")
    return readers.numbered_lines(spark, path).join(first, F.col("value") == F.col("text"), "left_semi").select("line", F.col("value").alias("text"))


@query(f"{_STORE} SELECT lang, corpus, text, n, count, {O.score('string_split(text, chr(32))', 'count', 'lang')} AS score, norm_key FROM counts WHERE lang = 'fr' AND count >= 2")
def ngram_file(spark: SparkSession, sf: str) -> DataFrame:
    """Scored counts through a file of tab-separated values."""
    path = _folder(spark, "ngrams")
    rows = ngrams.export_ngrams(counts(spark, sf, langs=("fr",)), ExportPolicy(min_count=2), lang="fr", corpus="docs", compacted=True)
    writers.write_tsv(rows, path)
    return spark.read.schema(rows.schema).option("sep", "\t").option("header", True).option("quote", "").csv(path)


@query(f"WITH {O.counts(_of('en', 'fr'), paired=True)} " + O.pairs("en", "fr"))
def pair_file(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs through a pair file."""
    path = _folder(spark, "pairs")
    own = sides(spark, sf, "en", "fr")
    writers.write_tsv(pairs.reverse_pairs(*(ngrams.select_counts(own, lang=x, compacted=True) for x in ("en", "fr"))), path)
    return readers.read_pairs(spark, path).drop("id")


@query(f"{_TOKENS} SELECT DISTINCT token AS word FROM words WHERE lang = 'fr' AND length(token) >= 2")
def lexicon_file(spark: SparkSession, sf: str) -> DataFrame:
    """Words through a word list, to which two that it has and one that it hasn't are added."""
    path = _folder(spark, "words")
    writers.write_lines(_words(spark, sf, "fr"), "text", path)
    held = readers.read_filter_words(spark, path)
    return review.add_words(held, held.limit(2).union(spark.createDataFrame([(" ",)], "word string")))


@query(_TOKENS.replace("WITH ", "WITH RECURSIVE ", 1) + ", " + O.decompositions(_word_sql("fr"), _word_sql("en"), 2).removeprefix("WITH RECURSIVE "))
def decomposition_file(spark: SparkSession, sf: str) -> DataFrame:
    """Decompositions through a JSON file."""
    path = _folder(spark, "decompositions")
    writers.write_decompositions(pairs.decompose(_words(spark, sf, "fr"), _words(spark, sf, "en"), 2), path)
    return readers.read_decompositions(spark, path)


@query("SELECT CAST(vec_id AS VARCHAR) AS word, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total FROM embeddings")
def embedding_file(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors through a file of vectors; a second write doesn't replace the first."""
    path = _folder(spark, "vectors")
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("word"), F.col("embedding").cast("array<float>").alias("embedding"))
    writers.write_embeddings(rows, path)
    writers.write_embeddings(rows.limit(0), path)
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return readers.read_embeddings(spark, path).select("word", F.round(total, 4).alias("total"))


@query("SELECT CAST(doc_id AS VARCHAR) AS title, '0' AS ns, length(text) > 0 AS has_text FROM documents WHERE doc_id IS NOT NULL")
def wiki_file(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as pages of a wiki dump."""
    path = _folder(spark, "dump")
    clean = F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\t\n\x20-\x{D7FF}\x{E000}-\x{FFFD}]", "?")
    rows = table(spark, sf, "documents").where("doc_id is not null").select(F.lit("0").alias("ns"), F.col("doc_id").cast("string").alias("title"), F.struct(clean.alias("text")).alias("revision"))
    rows.write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").save(path)
    return readers.read_wiki_dump(spark, path).select("title", "ns", (F.length("text") > 0).alias("has_text"))


# Vectors


@query("""WITH q AS (SELECT CAST(vec_id AS BIGINT) AS query_id, embedding AS e FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT query_id, CAST(vec_id AS BIGINT) AS vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(e AS DOUBLE[])), 9) AS similarity FROM embeddings, q),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
def cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The ten vectors most like each one whose id is divisible by 50, of all."""
    held = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return vectors.top_k(held.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), held, 10)
