"""Duplicates hidden by formatting: dictionary encoding and grouping of integer tuples.

Every distinct raw value of a column is canonicalised once. The distinct canonical values get integer
codes, which are written to the shared folder so that they stay the same if a task runs again. Records
become tuples of codes, and the tuples are grouped; texts are not shuffled after the encoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fold import doi_expr, letters_udf, names_key_udf
from ..operators.durable import Scratch


def dictionary(values: DataFrame, column: str, canonical, scratch: Scratch) -> DataFrame:
    """(raw, code) for the distinct values of a column; code is null where canonical gives null or ''.

    ``canonical`` maps a column to its canonical string. Null values are no entries.
    """
    raw = values.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("raw")).agg(F.lit(1).alias("one"))
    mapped = scratch.keep(raw.select("raw", F.nullif(canonical(F.col("raw")), F.lit("")).alias("canonical")), "canonical")
    codes = mapped.where("canonical is not null").groupBy("canonical").agg(F.lit(1).alias("one")).select("canonical", F.monotonically_increasing_id().alias("code"))
    codes = scratch.keep(codes, "codes")
    return scratch.keep(mapped.join(codes, "canonical", "left").select("raw", "code"), "dictionary")


def copies(tuples: DataFrame, key: list[str]) -> DataFrame:
    """(first_id, id, n) for every row of (id, key...) that is not the first of its group of equal keys.

    n is the size of the group. Groups are found by a minimum and a count that combine on the map side;
    only groups of two and more are joined back to their rows.
    """
    groups = tuples.groupBy(*key).agg(F.min("id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    return tuples.join(groups, key).where("id > first_id").select("first_id", "id", "n")


def candidate_copies(candidates: DataFrame) -> DataFrame:
    """(first_id, id, n) for copies among paper candidates.

    Copies have the same letters and digits in raw_title and the same names in raw_authors in any
    order; null and blank authors are equal. Rows whose title has no letter or digit are no case.
    Further columns are ignored. id should be unique: rows that share an id count once.
    """
    scratch = Scratch(candidates.sparkSession, "copies")
    rows = candidates.select("id", "raw_title", "raw_authors")
    titles = dictionary(rows, "raw_title", letters_udf, scratch).withColumnRenamed("code", "t")
    names = dictionary(rows.where("trim(raw_authors) <> ''"), "raw_authors", names_key_udf, scratch).withColumnRenamed("code", "a")
    coded = rows.join(titles.where("t is not null"), F.col("raw_title") == titles.raw).drop("raw")
    coded = coded.join(names, F.col("raw_authors") == names.raw, "left").select("id", F.array("t", F.coalesce("a", F.lit(-1))).alias("k"))
    return copies(scratch.keep(coded, "tuples"), ["k"])


def source_copies(records: DataFrame) -> DataFrame:
    """(first_id, id, n) for copies among source records: the same source_name and the same DOI.

    Values without a complete DOI and rows without source_name are no case.
    """
    scratch = Scratch(records.sparkSession, "copies")
    rows = records.select("id", "source_name", "doi").where("source_name is not null and doi is not null")
    dois = dictionary(rows, "doi", doi_expr, scratch).withColumnRenamed("code", "d")
    sources = dictionary(rows, "source_name", lambda c: c, scratch).withColumnRenamed("code", "s")
    coded = rows.join(dois.where("d is not null"), F.col("doi") == dois.raw).drop("raw")
    coded = coded.join(sources, F.col("source_name") == sources.raw).select("id", F.array("s", "d").alias("k"))
    return copies(scratch.keep(coded, "tuples"), ["k"])


def all_copies(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """(table_name, first_id, id) of the copies in both tables."""
    a = candidate_copies(candidates).select(F.lit("paper_candidate").alias("table_name"), "first_id", "id")
    return a.unionByName(source_copies(records).select(F.lit("source_record").alias("table_name"), "first_id", "id"))


def collapsed(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """(table_name, id, n_copies): the first row of every group of copies, and how many rows the group has.

    Rows without a copy have 1; rows that are no case (without title, or without source or whole DOI) too.
    """
    found = all_copies(candidates, records)
    n = found.groupBy("table_name", F.col("first_id").alias("id")).agg((F.count("*") + 1).alias("n"))
    rows = candidates.select(F.lit("paper_candidate").alias("table_name"), "id").unionByName(records.select(F.lit("source_record").alias("table_name"), "id"))
    kept = rows.join(found.select("table_name", "id"), ["table_name", "id"], "left_anti")
    return kept.join(n, ["table_name", "id"], "left").select("table_name", "id", F.coalesce("n", F.lit(1)).alias("n_copies"))
