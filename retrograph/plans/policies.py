"""Parameters of jobs, checked when they are made.  A limit or filter of 0 is off."""

from __future__ import annotations

from dataclasses import dataclass

COUNT_SOURCES = ("auto", "raw", "compact")


def _at_least(least: int, **values: float) -> None:
    for name, value in values.items():
        if value < least:
            raise ValueError(f"{name} must be at least {least}")


def _ordered(low: int, high: int, name: str) -> None:
    if high and low > high:
        raise ValueError(f"min_{name} must not exceed max_{name}")


@dataclass(frozen=True)
class NgramPolicy:
    """What counts as an n-gram.  ``fold_nasal_letters`` is accepted and changes nothing."""

    max_n: int = 3
    min_token_len: int = 2
    max_token_len: int = 30
    min_norm_len: int = 3
    include_all_stopword_ngrams: bool = False
    fold_nasal_letters: bool = False

    def __post_init__(self) -> None:
        if self.max_n not in (1, 2, 3):
            raise ValueError("max_n must be 1, 2 or 3")
        _at_least(1, min_token_len=self.min_token_len, max_token_len=self.max_token_len, min_norm_len=self.min_norm_len)
        _ordered(self.min_token_len, self.max_token_len, "token_len")


@dataclass(frozen=True)
class ExportPolicy:
    """Which counts are exported, and how many."""

    min_count: int = 1
    limit: int = 0
    n: int = 0
    min_norm_len: int = 0
    max_norm_len: int = 0

    def __post_init__(self) -> None:
        _at_least(1, min_count=self.min_count)
        _at_least(0, limit=self.limit, n=self.n, min_norm_len=self.min_norm_len, max_norm_len=self.max_norm_len)
        _ordered(self.min_norm_len, self.max_norm_len, "norm_len")


@dataclass(frozen=True)
class SearchPolicy:
    """Both sides of a reverse-key search."""

    source_lang: str
    source_corpus: str
    target_lang: str
    target_corpus: str
    min_source_count: int = 3
    min_target_count: int = 3
    max_results: int = 0
    source_n: int = 0
    target_n: int = 0
    min_norm_len: int = 0
    max_norm_len: int = 0
    counts_source: str = "auto"
    include_palindromes: bool = False
    include_identical_text: bool = False

    def __post_init__(self) -> None:
        if self.counts_source not in COUNT_SOURCES:
            raise ValueError(f"counts_source must be one of: {', '.join(COUNT_SOURCES)}")
        _at_least(1, min_source_count=self.min_source_count, min_target_count=self.min_target_count)
        _at_least(0, max_results=self.max_results, source_n=self.source_n, target_n=self.target_n, min_norm_len=self.min_norm_len, max_norm_len=self.max_norm_len)
        _ordered(self.min_norm_len, self.max_norm_len, "norm_len")


@dataclass(frozen=True)
class PhrasePolicy:
    """Thresholds, sizes and penalties of phrase generation."""

    min_source_count: int = 100
    min_target_count: int = 100
    min_pair_score: float = 0.0
    max_source_n: int = 3
    max_target_n: int = 3
    piece_limit: int = 1000
    min_pieces: int = 2
    max_pieces: int = 2
    beam_size: int = 500
    max_results: int = 500
    allow_repeated_pieces: bool = False
    collapse_permutations: bool = True
    reciprocal_penalty: float = 12.0
    edge_penalty: float = 3.0
    fragment_penalty: float = 6.0
    wordfreq_weight: float = 0.35
    plausibility_weight: float = 0.0

    def __post_init__(self) -> None:
        _at_least(1, piece_limit=self.piece_limit, min_pieces=self.min_pieces, beam_size=self.beam_size, max_results=self.max_results)
        _at_least(0, reciprocal_penalty=self.reciprocal_penalty, edge_penalty=self.edge_penalty, fragment_penalty=self.fragment_penalty)
        if self.min_pieces > self.max_pieces:
            raise ValueError("min_pieces must not exceed max_pieces")


@dataclass(frozen=True)
class ReviewPolicy:
    """Which pairs a reviewer sees.  None for a size is any."""

    source_contains: str = ""
    target_contains: str = ""
    min_pair_score: float = 0.0
    min_source_count: int = 0
    min_target_count: int = 0
    source_n: int | None = None
    target_n: int | None = None
    limit: int = 500
