"""Sequence similarity of texts and what it answers (op ids X1, X3, X5, X6, J11)."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .text import comparison


def matching_ratio(x: str, y: str) -> float:
    """Matching-block ratio of two texts as they are. Not symmetric."""
    return 1.0 if x == y else SequenceMatcher(None, x, y).ratio()


def ratio(a: str | None, b: str | None) -> float:
    """Matching-block ratio of two texts in comparison form; 0 if one is empty. Not symmetric."""
    x, y = comparison(a), comparison(b)
    if not x or not y:
        return 0.0
    return matching_ratio(x, y)


@F.pandas_udf(DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


# Similarities at which titles answer each other.
SURE, LEAST, USUAL, SAME_VENUE = 0.97, 0.84, 0.90, 0.8


def accepts_title(similarity, year, other_year):
    """Whether a result's title answers a query's title."""
    clash = F.coalesce((year != "") & (other_year != "") & (year != other_year), F.lit(False))
    return F.when(similarity >= SURE, True).when((similarity < LEAST) | clash, False).otherwise(similarity >= USUAL)


def family_in_first(family, names):
    """Whether a family name is in the first name of an array; null if either is unknown."""
    first = F.lower(F.try_element_at(names, F.lit(1)))
    return F.when((F.coalesce(family, F.lit("")) != "") & first.isNotNull(), first.contains(F.lower(F.trim(family))))


def venue_hint(hint, venue, similarity):
    """Whether a venue answers a hinted one, in comparison forms: one in the other, or similar; null if either is unknown."""
    known = (F.coalesce(hint, F.lit("")) != "") & (F.coalesce(venue, F.lit("")) != "")
    return F.when(known, hint.contains(venue) | venue.contains(hint) | (similarity >= SAME_VENUE))
