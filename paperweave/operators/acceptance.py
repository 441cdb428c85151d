"""Whether an answer of a provider is the paper that was asked for (op ids X3-X8, E11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions import text as tx

# Similarity below which the author must agree, and at which pubmed needs no author.
AUTHOR_BELOW, PUBMED_ALONE = 0.93, 0.96


def evidence(answers: DataFrame) -> DataFrame:
    """Adds similarity, author, venue_agrees (both null if unknown), same_year and other_year to answers.

    answers has title, year, family, venue, doi of the asked paper with the prefix q_, and title, year, authors
    (array), venue, doi, source_name of the answer.
    """
    known = (F.coalesce("q_year", F.lit("")) != "") & (F.coalesce("year", F.lit("")) != "")
    rows = answers.withColumn("similarity", sim.ratio_udf("q_title", "title")).withColumn("_h", tx.comparison_udf("q_venue")).withColumn("_v", tx.comparison_udf("venue"))
    rows = rows.withColumn("author", sim.family_in_first(F.col("q_family"), F.col("authors"))).withColumn("venue_agrees", sim.venue_hint(F.col("_h"), F.col("_v"), sim.ratio_udf("_h", "_v")))
    return rows.withColumn("same_year", known & (F.col("q_year") == F.col("year"))).withColumn("other_year", known & (F.col("q_year") != F.col("year"))).drop("_h", "_v")


def accepted(rows: DataFrame) -> DataFrame:
    """Adds accepted to rows with ``evidence``.

    No other DOI, author or venue; a title that answers, or a cut one with author, venue and year for it; below a
    similarity of 0.93 the author, and the venue where both years are known; pubmed needs the author below
    0.96, and other years a similarity of 0.97.
    """
    s, cut = F.col("similarity"), F.coalesce(tx.cut_title(F.col("q_title")), F.lit(False))
    bare = lambda c: F.nullif(F.regexp_replace(F.lower(F.trim(c)), r"^https://doi\.org/", ""), F.lit(""))
    other_doi = F.coalesce(bare("q_doi") != bare("doi"), F.lit(False))
    author, venue = F.coalesce("author", F.lit(False)), F.coalesce("venue_agrees", F.lit(False))
    against = F.coalesce(~F.col("author"), F.lit(False)) | F.coalesce(~F.col("venue_agrees"), F.lit(False)) | other_doi
    title = sim.accepts_title(s, F.coalesce("q_year", F.lit("")), F.coalesce("year", F.lit("")))
    salvaged = cut & (s >= sim.LEAST) & author & venue & ~F.col("other_year")
    weak = (s < AUTHOR_BELOW) & (~author | (~venue & (F.col("same_year") | F.col("other_year"))))
    pubmed = (F.coalesce("source_name", F.lit("")) == "pubmed") & (s < PUBMED_ALONE) & ~author
    late = F.col("other_year") & (s < sim.SURE)
    return rows.withColumn("accepted", (title | salvaged) & ~against & ~weak & ~pubmed & ~late)


def best_answers(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The best accepted answer per key, else the first one (X8): by similarity, DOI, year, venue and author, then order."""
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    rank = F.struct(flag(F.col("accepted")), F.when(F.col("accepted"), F.col("similarity")), flag(F.col("accepted") & (F.coalesce("doi", F.lit("")) != "")), flag(F.col("accepted") & F.col("same_year")), flag(F.col("accepted") & F.col("venue_agrees")), flag(F.col("accepted") & F.col("author")), -F.col(order))
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), rank).alias("x")).select(key, *[f"x.{c}" for c in rest])


def asked_answers(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """The records of sources next to what their candidate's earliest titled row asked for; the input of ``evidence``."""
    c = candidates.where("trim(raw_title) <> ''").select("candidate_id", "id", F.col("raw_title").alias("q_title"), F.trim("year_guess").alias("q_year"), tx.first_family(F.col("raw_authors")).alias("q_family"), F.col("venue_guess").alias("q_venue"))
    rest = [x for x in c.columns if x not in ("candidate_id", "id")]
    c = c.groupBy("candidate_id").agg(F.min_by(F.struct(*rest), "id").alias("x")).select("candidate_id", *[f"x.{x}" for x in rest])
    r = records.where("matched").select("candidate_id", "id", "source_name", "title", F.trim("year").alias("year"), F.from_json("authors_json", "array<string>").alias("authors"), "venue", "doi")
    return c.join(r, "candidate_id").withColumn("q_doi", F.lit(None).cast("string"))
