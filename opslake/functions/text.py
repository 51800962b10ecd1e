"""Column expressions over text."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letters kept, stop words on top of a supplied list, marks of vocabulary pieces.
ALPHABET = "a-zA-ZəƏıIöÖüÜğĞçÇşŞ"
EXTRA_STOPWORDS = ["i", "b", "ivqd", "maddə", "nömrəli", "si"]
SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
MIN_PARAGRAPH = 33


def words(text: Column) -> Column:
    """Whitespace-separated words; none for blank text."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def clean_whitespace(text: Column) -> Column:
    """Line breaks and no-break spaces become spaces, runs of spaces become one, ends are trimmed."""
    return F.trim(F.regexp_replace(F.translate(text, "\u00a0", " "), r"\s+", " "))


def strip_markers(text: Column) -> Column:
    """Without ``[n]`` citations and without runs of underscores."""
    return F.regexp_replace(F.regexp_replace(text, r"\[\d+\]", ""), "_{2,}", "")


def keep_alphabet(text: Column, alphabet: str = ALPHABET) -> Column:
    kept = F.regexp_replace(text, f"[^{alphabet}]", " ")
    return F.trim(F.regexp_replace(kept, " +", " "))


def drop_short_words(text: Column, longer_than: int = 2) -> Column:
    return F.array_join(F.filter(words(text), lambda w: F.length(w) > longer_than), " ")


def drop_stopwords(text: Column, stopwords: list[str]) -> Column:
    return F.array_join(F.filter(words(text), lambda w: ~w.isin(stopwords)), " ")


def lower(text: Column, dotless_i: bool = False) -> Column:
    """Lower case; on request with the dotted and dotless i kept apart."""
    return F.lower(F.translate(text, "Iİ", "ıi") if dotless_i else text)


def word_count(text: Column) -> Column:
    return F.size(words(text))


def is_numeric_row(text: Column) -> Column:
    return text.rlike(r"^[\d\s.,–-]*$")


def letter_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"(\p{L}+)"), 1))


def clean_query(text: Column) -> Column:
    """Without the digits and closing punctuation at the end."""
    return F.trim(F.regexp_replace(text, r"[\d!?.,;]*$", ""))


@F.pandas_udf(StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


@F.pandas_udf(StringType())
def _bare(texts: pd.Series) -> pd.Series:
    def strip(text: str) -> str:
        parts = unicodedata.normalize("NFD", text)
        return "".join(c for c in parts if unicodedata.category(c) != "Mn")

    return texts.map(strip, na_action="ignore")


def normalize(text: Column) -> Column:
    """NFC form. Spark has no built-in for it, so this is an Arrow-batched function."""
    return _nfc(text)


def strip_accents(text: Column) -> Column:
    """Lower case without accents, the form of vocabulary words."""
    return _bare(F.lower(text))


def share_below(key: Column, fraction: float, seed: int) -> Column:
    """True for a fixed share of keys, whatever the partitioning: the key's hash decides."""
    return hash_fraction(key, seed) < fraction


def hash_fraction(key: Column, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.left(digest, F.lit(8)), 16, 10).cast("double") / 4294967296.0
