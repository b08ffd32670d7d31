"""Language-model plausibility of phrases, from ARPA files of back-off n-gram models."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scores that a worker remembers.
REMEMBERED = 100_000


class ArpaModel:
    """Log10 probabilities and back-off weights of an ARPA file."""

    def __init__(self, path: str) -> None:
        self.held: dict[tuple[str, ...], tuple[float, float]] = {}
        self.order = size = 0
        with open(path, encoding="utf-8") as f:
            for line in f:
                line = line.strip()
                if line.startswith("\\") and line.endswith("-grams:"):
                    size = int(line[1:].split("-", 1)[0])
                    self.order = max(self.order, size)
                elif line == "\\end\\":
                    break
                elif size and line:
                    cells = line.split()
                    if len(cells) < size + 1:
                        raise ValueError(f"{path}: {line!r} has too few columns")
                    self.held[tuple(cells[1 : size + 1])] = (float(cells[0]), float(cells[size + 1]) if len(cells) > size + 1 else 0.0)
        if not self.order:
            raise ValueError(f"{path} has no n-grams")

    def _word(self, context: tuple[str, ...], word: str) -> float:
        """Log10 P(word | context), shortening the context until the n-gram is known."""
        backed = 0.0
        while True:
            found = self.held.get((*context, word))
            if found is not None:
                return backed + found[0]
            if not context:
                return backed + self.held.get(("<unk>",), (-100.0, 0.0))[0]
            backed += self.held.get(context, (0.0, 0.0))[1]
            context = context[1:]

    def score(self, text: str) -> float:
        """Log10 probability of the text with its beginning and end."""
        known = [w if (w,) in self.held else "<unk>" for w in text.split()]
        context, total = ("<s>",), 0.0
        for word in (*known, "</s>"):
            total += self._word(context[max(0, len(context) - self.order + 1) :], word)
            context = (*context, word)
        return total


@lru_cache(maxsize=None)
def _model(path: str) -> ArpaModel:
    return ArpaModel(path)


@lru_cache(maxsize=REMEMBERED)
def _score(text: str, path: str) -> float:
    words = text.split()
    return _model(path).score(text) / len(words) if words else 0.0


def arpa_scorer(models: dict[str, str]) -> Callable[[Column, Column], Column]:
    """A scorer for phrases: log10 probability for each token by the model of the language; 0 without a model or tokens.

    Paths must be readable by all executors.  The candidates of a beam are few,
    so a Pandas function over them is no hot path.
    """
    paths = dict(models)

    @F.pandas_udf("double")
    def scores(text: pd.Series, lang: pd.Series) -> pd.Series:
        return pd.Series([_score(t, paths[x]) if t and x in paths else 0.0 for t, x in zip(text, lang, strict=True)])

    return scores
