"""Column functions on text: cleaning, comparison keys, chunks, tokens.

White space means what Python's ``\\s`` means.  All but
``strip_accents_general`` are built-in expressions that stay in the JVM.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

_ENDS = ".!?;:…"
_SPACE = r"\s\x1c-\x1f"
URL = rf"(?U)(?:https?://|www\.)[^{_SPACE}]*[^{_SPACE}{_ENDS}]([{_ENDS}]*)|https?://([{_ENDS}]+)|www(\.[{_ENDS}]+)"
MARKER = r"\[\[?[^\]\n]+\]?\]|\{\{[^}\n]+\}\}"
WHITE = rf"(?U)[{_SPACE}]+"
BOUNDARY = "[.!?;:¡¿…]+"
TOKEN = "[A-Za-zÀ-ÖØ-öø-ÿĀ-ſ]+"

#: Acute, grave, circumflex, tilde, diaeresis.
_MARKS = "́̀̂̃̈"
ACCENTED = "àáâãäèéêëìíîïñòóôõöùúûüýÿćĉĝĥĩĵĺńŕśŝũŵŷź"
PLAIN = "aaaaaeeeeiiiinooooouuuuyyccghijlnrssuwyz"


def remove_urls(x: Column) -> Column:
    """URLs become a blank; sentence marks at their end stay."""
    return F.regexp_replace(x, URL, " $1$2$3 ")


def remove_markers(x: Column) -> Column:
    """[[...]], [...] and {{...}} on one line become a blank."""
    return F.regexp_replace(x, MARKER, " ")


def normalize_spacing(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, WHITE, " "))


def clean(x: Column) -> Column:
    """URLs, then markers, then white space."""
    return normalize_spacing(remove_markers(remove_urls(x)))


def strip_accents(x: Column) -> Column:
    """Drop the five accent marks, for composed letters up to U+017F."""
    return F.translate(x, ACCENTED + ACCENTED.upper(), PLAIN + PLAIN.upper())


@pandas_udf(StringType())
def strip_accents_general(x: pd.Series) -> pd.Series:
    """Drop the five accent marks from any text; for words outside the token alphabet."""

    def plain(s: str | None) -> str | None:
        if s is None:
            return None
        return unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", s) if c not in _MARKS))

    return x.map(plain)


def norm_key(x: Column, fold_nasal_letters: bool = False) -> Column:
    """Lower case, no accents, c for ç, no white space.

    ``fold_nasal_letters`` changes nothing: the tilde of ñ is an accent mark and
    is gone already.
    """
    return F.regexp_replace(F.translate(F.lower(x), ACCENTED + "ç", PLAIN + "c"), WHITE, "")


def once(x: Column) -> Column:
    """A generator of one row: the optimiser can't copy what is in it into later expressions."""
    return F.explode(F.array(x))


def chunks(cleaned: Column) -> Column:
    """Array of the pieces between strong punctuation; the record is dropped if it begins with '#'."""
    parts = F.filter(F.transform(F.split(cleaned, BOUNDARY), lambda c: F.trim(c)), lambda c: c != "")
    return F.when(cleaned.startswith("#"), F.array().cast("array<string>")).otherwise(parts)


def tokens(chunk: Column) -> Column:
    """Array of lower-case words."""
    return F.regexp_extract_all(F.lower(chunk), F.lit(f"({TOKEN})"), F.lit(1))


def reversed_key(x: Column) -> Column:
    return F.reverse(x)
