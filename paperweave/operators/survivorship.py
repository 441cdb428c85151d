"""Merging the records of several sources: the preferred value of each field, and the form in which values are compared (op ids G1, M1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Priority of sources, and fields that a record of identifiers only may give.
SOURCE_PRIORITY = {"crossref": 4, "openalex": 3, "semanticscholar": 2, "pubmed": 1, "unpaywall": 0}
PUBMED_FIELDS = ("abstract", "pmid", "pmcid")
ID_FIELDS = ("doi", "pmid", "pmcid")
MERGED_FIELDS = ("title", "authors_json", "venue", "year", "doi", "pmid", "pmcid", "abstract")
CONFLICT_FIELDS = ("title", "venue", "year", "doi", "pmid")


def _long(records: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    parts = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in fields])
    return records.select("candidate_id", "id", "source_name", "query_type", F.explode(parts).alias("x")).select("candidate_id", "id", "source_name", "query_type", "x.*")


def picked_fields(records: DataFrame, fields: tuple[str, ...] = MERGED_FIELDS) -> DataFrame:
    """(candidate_id, field_name, value, source_name, n_values): the preferred value of each field (M1).

    Blank values are dropped; pubmed gives only its own fields. A source's priority is raised by 3 for
    identifiers found by identifier queries and lowered by 1 for those found by title. Equal scores go to
    the smaller source name, query type, and id.
    """
    rows = _long(records.where("matched"), fields).where("value is not null and value <> ''")
    base = F.coalesce(F.create_map(*[F.lit(x) for kv in SOURCE_PRIORITY.items() for x in kv])[F.col("source_name")], F.lit(0))
    bonus = F.when(F.col("field_name").isin(*ID_FIELDS) & F.col("query_type").isin("doi", "doi_batch", "pmid"), 3).when(F.col("field_name").isin(*ID_FIELDS) & (F.col("query_type") == "title"), -1).otherwise(0)
    rows = rows.where((F.col("source_name") != "pubmed") | F.col("field_name").isin(*PUBMED_FIELDS) | F.col("source_name").isNull())
    order = F.struct(-(base + bonus), F.coalesce("source_name", F.lit("")), F.coalesce("query_type", F.lit("")), "id")
    best = rows.groupBy("candidate_id", "field_name").agg(F.min_by(F.struct("value", "source_name"), order).alias("x"), F.count("*").alias("n_values"))
    return best.select("candidate_id", "field_name", "x.value", "x.source_name", "n_values")


def conflict_value(field, value):
    """Form in which values of a field are compared (G1)."""
    text = F.trim(F.regexp_replace(value, r"\s+", " "))
    doi = F.regexp_replace(F.regexp_replace(F.lower(text), r"^https://doi\.org/", ""), r"[ ./]+$", "")
    words = F.regexp_replace(F.lower(text), r"[ .]+$", "")
    return F.nullif(F.when(field == "doi", doi).when(field == "pmcid", F.upper(text)).when(field.isin("title", "venue"), words).otherwise(text), F.lit(""))
