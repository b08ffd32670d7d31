"""Pieces of DuckDB SQL that say the same as the operators, written apart from them."""

from __future__ import annotations

from ..functions import lang as L
from .policies import PhrasePolicy

_WS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_END = ".!?;:…"
_URL = rf"(?:https?://|www\.)[^{_WS}]*[^{_WS}{_END}]([{_END}]*)|https?://([{_END}]+)|www(\.[{_END}]+)"
_FROM = "àáâãäèéêëìíîïñòóôõöùúûüýÿćĉĝĥĩĵĺńŕśŝũŵŷź"
_TO = "aaaaaeeeeiiiinooooouuuuyyccghijlnrssuwyz"
_WORD = "[A-Za-zÀ-ÖØ-öø-ÿĀ-ſ]+"


def strings(items) -> str:
    """A list literal."""
    quoted = ", ".join("'" + str(x).replace("'", "''") + "'" for x in sorted(items))
    return f"CAST([{quoted}] AS VARCHAR[])"


def by_language(lists: dict[str, frozenset[str]], lang: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {strings(v)}" for k, v in sorted(lists.items()))
    return f"CASE {lang} {cases} ELSE CAST([] AS VARCHAR[]) END"


def no_urls(x: str) -> str:
    return rf"regexp_replace({x}, '{_URL}', ' \1\2\3 ', 'g')"


def no_markers(x: str) -> str:
    return rf"regexp_replace({x}, '\[\[?[^\]\n]+\]?\]|\{{\{{[^}}\n]+\}}\}}', ' ', 'g')"


def spaced(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{_WS}]+', ' ', 'g'))"


def clean(x: str) -> str:
    return spaced(no_markers(no_urls(x)))


def plain(x: str) -> str:
    return f"translate({x}, '{_FROM}', '{_TO}')"


def key(x: str) -> str:
    return f"regexp_replace(translate(lower({x}), '{_FROM}ç', '{_TO}c'), '[{_WS}]+', '', 'g')"


def chunks(source: str) -> str:
    """CTE ``chunked`` (lang, corpus, chunk)."""
    return f"""cleaned AS (SELECT lang, corpus, {clean("text")} AS c FROM ({source}) WHERE text IS NOT NULL),
chunked AS (SELECT * FROM (SELECT lang, corpus, trim(unnest(regexp_split_to_array(c, '[.!?;:¡¿…]+'))) AS chunk FROM cleaned WHERE NOT starts_with(c, '#')) WHERE chunk <> '')"""


def counts(source: str, stopwords: bool = True, paired: bool = False) -> str:
    """CTEs up to ``counts`` (lang, corpus, text, n, count, norm_key); with ``paired`` only of texts whose reversed key there is."""
    some = f"AND len(list_filter(w, lambda x: NOT list_contains({by_language(L.STOPWORDS, 'lang')}, {plain('x')}))) > 0" if stopwords else ""
    return f"""{chunks(source)},
words AS MATERIALIZED (SELECT lang, corpus, regexp_extract_all(lower(chunk), '{_WORD}') AS t FROM chunked),
spread AS (SELECT lang, corpus, unnest(t || [t[i] || ' ' || t[i + 1] FOR i IN range(1, len(t))] || [t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] FOR i IN range(1, len(t) - 1)]) AS text FROM words),
occurring AS (SELECT lang, corpus, text, count(*) AS count FROM spread GROUP BY ALL),
{"keyed AS MATERIALIZED (SELECT *, " + key("text") + " AS found_key FROM occurring WHERE length(replace(text, ' ', '')) >= 3)," if paired else ""}
apart AS (SELECT *, string_split(text, ' ') AS w FROM {"keyed WHERE found_key IN (SELECT reverse(found_key) FROM keyed)" if paired else "occurring"}),
counts AS MATERIALIZED (SELECT lang, corpus, text, CAST(len(w) AS INTEGER) AS n, CAST(count AS BIGINT) AS count, {key("text")} AS norm_key FROM apart
  WHERE len(list_filter(w, lambda x: length(x) > 30 OR (length(x) < 2 AND NOT list_contains({by_language(L.ONE_LETTER, 'lang')}, {plain('x')})))) = 0
  AND length(replace(text, ' ', '')) >= 3 {some})"""


def score(words: str, count: str, lang: str) -> str:
    return f"""round(ln({count} + 1) - 0.5 * len(list_filter({words}, lambda x: length(x) = 1)) - CASE WHEN len({words}) = 3 THEN 0.25 ELSE 0 END
  - CASE WHEN len(list_filter({words}, lambda x: NOT list_contains({by_language(L.STOPWORDS, lang)}, {plain('x')}))) = 0 THEN 0.75 ELSE 0 END
  + CASE WHEN length(array_to_string({words}, '')) BETWEEN 4 AND 12 THEN 0.2 ELSE 0 END, 6)"""


PAIR_ORDER = "(source_count + target_count) DESC, source_text, target_text, source_norm_key, target_norm_key, source_n, target_n"


def pairs(source: str, target: str, *, least: tuple[int, int] = (1, 1), palindromes: bool = False, identical: bool = False, where: str = "TRUE") -> str:
    """A query for the pairs of two languages of ``counts``."""
    side = lambda a, p: ", ".join(f"{a}.{c} AS {p}_{c}" for c in ("lang", "corpus", "text", "n", "count", "norm_key"))
    return f"""SELECT {side("a", "source")}, {side("b", "target")}, round(ln(a.count + 1) + ln(b.count + 1), 6) AS pair_score
FROM counts a JOIN counts b ON reverse(a.norm_key) = b.norm_key
WHERE a.lang = '{source}' AND b.lang = '{target}' AND a.count >= {least[0]} AND b.count >= {least[1]} AND {where}
{"" if palindromes else "AND a.norm_key <> b.norm_key"} {"" if identical else "AND NOT (a.lang = b.lang AND a.corpus = b.corpus AND a.text = b.text)"}"""


def decompositions(source: str, target: str, k: int) -> str:
    """A query for sources (text) whose reversed key is up to k target (text) keys."""
    return f"""WITH RECURSIVE origin AS (SELECT DISTINCT text, {key("text")} AS key FROM ({target}) WHERE {key("text")} <> ''),
part AS (SELECT DISTINCT key FROM origin),
walk AS (
  SELECT DISTINCT text AS source, reverse({key("text")}) AS rest, CAST([] AS VARCHAR[]) AS path FROM ({source}) WHERE {key("text")} <> ''
  UNION ALL
  SELECT w.source, substr(w.rest, length(p.key) + 1), list_append(w.path, p.key) FROM
    (SELECT *, unnest(range(1, length(rest) + 1)) AS size FROM walk WHERE len(path) < {k} AND rest <> '') w JOIN part p ON p.key = w.rest[1:w.size]
),
spell AS (
  SELECT source, path, 0 AS k, '' AS phrase FROM walk WHERE rest = '' AND len(path) > 0
  UNION ALL
  SELECT s.source, s.path, s.k + 1, CASE WHEN s.k = 0 THEN o.text ELSE s.phrase || ' ' || o.text END FROM spell s JOIN origin o ON o.key = s.path[s.k + 1] WHERE s.k < len(s.path)
)
SELECT DISTINCT source, CAST(len(string_split(phrase, ' ')) AS INTEGER) AS word_count, phrase FROM spell WHERE k = len(path)"""


def _in(lists: dict[str, frozenset[str]], lang: str, word: str) -> str:
    return f"coalesce(list_contains({by_language(lists, lang)}, {word}), FALSE)"


def fragment(text: str, lang: str, p: float) -> str:
    w = f"list_filter(regexp_split_to_array(lower({text}), '[{_WS}]+'), lambda x: x <> '')"
    return f"""CASE WHEN len({w}) = 0 THEN {p} ELSE CASE WHEN len(list_filter({w}, lambda x: NOT {_in(L.FUNCTION_WORDS, lang, "x")})) = 0 THEN {p} ELSE 0 END
  + CASE WHEN {_in(L.WEAK_LAST, lang, f"({w})[-1]")} THEN {0.5 * p} ELSE 0 END + CASE WHEN {_in(L.WEAK_FIRST, lang, f"({w})[1]")} THEN {0.25 * p} ELSE 0 END END"""


def pieces(policy: PhrasePolicy) -> str:
    """A query for the usable pieces from ``pieces_in``, with ranks."""
    return f"""SELECT *, row_number() OVER (ORDER BY quality DESC, id) AS piece_rank FROM (
SELECT *, round(pair_score + ln(source_count + 1) + ln(target_count + 1), 9) AS quality FROM pieces_in WHERE source_norm_key = reverse(target_norm_key)
AND source_count >= {policy.min_source_count} AND target_count >= {policy.min_target_count} AND pair_score >= {policy.min_pair_score}
AND source_n <= {policy.max_source_n} AND target_n <= {policy.max_target_n}) ORDER BY quality DESC, id LIMIT {policy.piece_limit}"""


def phrases(policy: PhrasePolicy) -> str:
    """CTEs and query of the beam search over ``pieces_in``; texts have no empty sides."""
    p = policy
    out = f"""usable AS ({pieces(p)}),
u AS (SELECT *, ln(source_count + 1) AS sl, ln(target_count + 1) AS tl, {fragment("source_text", "source_lang", p.fragment_penalty)} + {fragment("target_text", "target_lang", p.fragment_penalty)} AS frag,
  string_split(source_text, ' ') AS sw, string_split(target_text, ' ') AS tw FROM usable)"""
    union = []
    for size in range(1, p.max_pieces + 1):
        if size == 1:
            rows = """SELECT [u] AS held, pair_score AS ps, sl AS ss, tl AS ts, sl + tl AS least, frag AS fs, 0 AS again, 0 AS rec, 0 AS beam_rank, piece_rank AS place FROM u"""
        else:
            repeats = "TRUE" if p.allow_repeated_pieces else "len(list_filter(c.held, lambda x: x.id = u.id)) = 0"
            rows = f"""SELECT list_append(c.held, u) AS held, c.ps + u.pair_score AS ps, c.ss + u.sl AS ss, c.ts + u.tl AS ts, least(c.least, u.sl + u.tl) AS least, c.fs + u.frag AS fs,
  c.again + CASE WHEN len(list_filter(c.held, lambda x: x.id = u.id)) > 0 THEN 1 ELSE 0 END AS again,
  c.rec + CASE WHEN len(list_filter(c.held, lambda x: x.source_norm_key = u.target_norm_key AND x.target_norm_key = u.source_norm_key)) > 0 THEN 1 ELSE 0 END AS rec,
  c.rank AS beam_rank, u.piece_rank AS place FROM beam{size - 1} c, u WHERE {repeats}"""
        edge = " + ".join(f"CASE WHEN {_in(lists, lang, word)} THEN {cost} ELSE 0 END" for lists, lang, word, cost in ((L.WEAK_FIRST, "held[1].source_lang", "held[1].sw[1]", 0.5 * p.edge_penalty), (L.WEAK_LAST, "held[1].source_lang", "held[-1].sw[-1]", p.edge_penalty), (L.WEAK_FIRST, "held[-1].target_lang", "held[-1].tw[1]", 0.5 * p.edge_penalty), (L.WEAK_LAST, "held[-1].target_lang", "held[1].tw[-1]", p.edge_penalty)))
        out += f""",
row{size} AS ({rows}),
beam{size} AS (SELECT *, row_number() OVER (ORDER BY score DESC, beam_rank, place) AS rank FROM (SELECT *, round(ps / {size}.0 + ss / {size}.0 + ts / {size}.0 + 0.25 * least - {0.75 * max(size - 2, 0)} - 10.0 * again - {p.reciprocal_penalty} * rec - ({edge}) - fs, 6) AS score FROM row{size}) ORDER BY score DESC, beam_rank, place LIMIT {p.beam_size})"""
        if size >= p.min_pieces:
            union.append(f"SELECT held, score, {size} AS size, rank FROM beam{size}")
    name = "CAST(list_sort([x.id FOR x IN held]) AS VARCHAR)" if p.collapse_permutations else "array_to_string([x.source_norm_key FOR x IN held], '') || chr(9) || array_to_string([x.target_norm_key FOR x IN list_reverse(held)], '')"
    each = lambda c, o="held": f"[x.{c} FOR x IN {o}]"
    return f"""{out},
found AS (SELECT *, {name} AS result_key FROM ({" UNION ALL ".join(union)})),
one AS (SELECT *, min(size * 1000000 + rank) OVER (PARTITION BY result_key) AS seen, row_number() OVER (PARTITION BY result_key ORDER BY score DESC, size, rank) AS place FROM found),
best AS (SELECT * FROM one WHERE place = 1 ORDER BY score DESC, seen LIMIT {p.max_results})
SELECT array_to_string({each("source_text")}, ' ') AS source_phrase, array_to_string({each("target_text", "list_reverse(held)")}, ' ') AS target_phrase, score AS phrase_score,
CAST(0 AS DOUBLE) AS source_plausibility, CAST(0 AS DOUBLE) AS target_plausibility, CAST(len(held) AS INTEGER) AS piece_count, TRUE AS formal_ok,
array_to_string({each("source_norm_key")}, '') AS source_norm_key, array_to_string({each("target_norm_key", "list_reverse(held)")}, '') AS target_norm_key,
round(list_sum({each("pair_score")}), 6) AS pair_score_sum, CAST(list_sum({each("source_count")}) AS BIGINT) AS source_count_sum, CAST(list_sum({each("target_count")}) AS BIGINT) AS target_count_sum,
list_min({each("source_count")}) AS min_source_count, list_min({each("target_count")}) AS min_target_count,
CAST(to_json([x.source_text || ' / ' || x.target_text FOR x IN held]) AS VARCHAR) AS pieces, CAST(to_json({each("id")}) AS VARCHAR) AS piece_ids,
CAST(to_json({each("source_count")}) AS VARCHAR) AS source_counts, CAST(to_json({each("target_count")}) AS VARCHAR) AS target_counts FROM best"""
