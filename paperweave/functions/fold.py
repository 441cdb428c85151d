"""Folding of text to comparison keys, for whole Arrow batches."""

from __future__ import annotations

import unicodedata

import pandas as pd
import regex
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Characters of categories L, N and M count; selectors and joiners of category M do not.
_DROP = regex.compile(r"[^\p{L}\p{N}\p{M}]+|[͏︀-️\U000e0100-\U000e01ef]")
_PLAIN = regex.compile(r"[^a-z0-9]+")


def letters(text: str | None) -> str:
    """Letters and digits of a text in order, whatever their case and Unicode form; '' for null."""
    if not text:
        return ""
    if text.isascii():
        return _PLAIN.sub("", text.lower())
    return unicodedata.normalize("NFKC", _DROP.sub("", unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())))


@F.pandas_udf(StringType())
def letters_udf(text: pd.Series) -> pd.Series:
    """Column form of ``letters``; null stays null."""
    return text.map(lambda x: None if x is None else letters(x))


@F.pandas_udf(StringType())
def names_key_udf(text: pd.Series) -> pd.Series:
    """The comma-separated names of a text, each as ``letters``, sorted; '' for null or blank text.

    Entries without letters or digits don't count. A text of only such entries gives ','.
    """

    def key(x: str | None) -> str:
        if x is None or not x.strip():
            return ""
        return ",".join(sorted(k for k in map(letters, x.split(",")) if k)) or ","

    return text.map(key)


def doi_expr(col):
    """The DOI in a value whatever its prefix, case, escapes and punctuation; null if it has no suffix.

    Percent escapes are decoded once (broken ones stay), white space inside is dropped.
    """
    plain = F.regexp_replace(col, r"\+", "%2B")
    decoded = F.coalesce(F.try_url_decode(plain), col)
    squeezed = F.lower(F.regexp_replace(F.when(F.instr(col, "%") > 0, decoded).otherwise(col), r"(?U)[\s\p{Cf}]+", ""))
    found = F.regexp_extract(squeezed, r"10\.[0-9]{4,9}/[^\"<>]*", 0)
    bare = F.regexp_replace(found, r"[\s./;,:>)\]}'\"]+$", "")
    return F.when(bare.rlike(r"^10\.[0-9]{4,9}/[\p{L}\p{N}]"), bare)
