"""Normalised candidates: one projection over the raw ones (op id N0)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import identifiers as ids
from ..functions import text


def normalized_keys(candidates: DataFrame, *more) -> DataFrame:
    """Identifiers, URL and name keys of candidates, all in the JVM; more columns may be added."""
    combined = F.concat_ws("\n", "raw_title", "raw_link", "raw_snippet", "target_url")
    url = F.coalesce(F.col("target_url"), F.col("raw_link"))
    return candidates.select(
        "id",
        "candidate_id",
        F.size(text.name_list(F.col("raw_authors"))).alias("n_authors"),
        text.first_family(F.col("raw_authors")).alias("first_author_family"),
        F.nullif(F.trim("year_guess"), F.lit("")).alias("year_guess"),
        ids.find_doi(combined).alias("doi"),
        ids.find_pmid(combined).alias("pmid"),
        F.coalesce(ids.find_pmcid(combined), ids.find_pmcid(url)).alias("pmcid"),
        ids.find_arxiv(combined).alias("arxiv"),
        ids.canonical_url(url).alias("url"),
        ids.host(url).alias("host"),
        *more,
    )


@F.pandas_udf(StructType([StructField(c, StringType()) for c in ("norm_title", "norm_title_key", "norm_venue")]))
def cleaned_udf(titles: pd.Series, venues: pd.Series) -> pd.DataFrame:
    """Cleaned title, its key and the cleaned venue; within a batch each distinct text is cleaned once."""
    known: dict = {None: (None, None)}
    places: dict = {None: None}
    for t in titles.unique():
        if t is not None and t not in known:
            clean = text.clean_title(t)
            known[t] = (clean, text.key_of_clean(clean))
    for v in venues.unique():
        if v is not None and v not in places:
            places[v] = text.clean_venue(v)
    pairs = [known[t] for t in titles]
    return pd.DataFrame({"norm_title": [p[0] for p in pairs], "norm_title_key": [p[1] for p in pairs], "norm_venue": [places[v] for v in venues]}, dtype=object)


def normalized(candidates: DataFrame) -> DataFrame:
    """normalized_keys with cleaned title, title key and venue, in one pass over the table."""
    own = normalized_keys(candidates, cleaned_udf("raw_title", "venue_guess").alias("c"))
    return own.select(*[c for c in own.columns if c != "c"], "c.*")
