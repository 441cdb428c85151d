"""Counts and audits over the tables (op ids A3, A4, A13, A14, A16, A17, A19, A23-A26, E6, T1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..tables import width
from .durable import Scratch


def duplicate_queries(records: DataFrame) -> DataFrame:
    """(source_name, query_type, n_intents, n_unique, n_duplicate, n_requests) of the lookups made.

    Lookups by identifier of one source go out in batches of 50.
    """
    per = records.groupBy("source_name", "query_type").agg(F.count("*").alias("n_intents"), F.countDistinct("query_string").alias("n_unique"))
    batched = (F.col("source_name") == "openalex") & (F.col("query_type") == "doi")
    requests = F.when(batched, F.ceil(F.col("n_unique") / 50)).otherwise(F.col("n_unique")).cast("bigint")
    return per.select("source_name", "query_type", "n_intents", "n_unique", (F.col("n_intents") - F.col("n_unique")).alias("n_duplicate"), requests.alias("n_requests"))


def top_duplicate_groups(records: DataFrame, n: int = 10) -> DataFrame:
    """The n lookups that most candidates share."""
    per = records.where("query_string is not null").groupBy("source_name", "query_type", "query_string").agg(F.countDistinct("candidate_id").alias("n_candidates"), F.min("candidate_id").alias("first_candidate"))
    return per.where("n_candidates > 1").orderBy(F.desc("n_candidates"), "source_name", "query_type", "query_string").limit(n)


def batch_numbers(records: DataFrame, key: str, size: int = 50) -> DataFrame:
    """(key, batch_no): the distinct keys in order, in batches of a size, without a global window.

    Keys are ranged over the partitions, however many begin alike; each partition's keys are counted, and numbered from
    the count of those before it.
    """
    keys = records.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
    ranged = Scratch(records.sparkSession, "batches").keep(keys.repartitionByRange(width(records.sparkSession), "key").withColumn("part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    ahead = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))  # one row per partition
    rank = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    return ranged.withColumn("r", rank).join(ahead, "part").select("key", F.floor((F.col("r") + F.col("before") - 1) / size).alias("batch_no"))


def latency_report(records: DataFrame) -> DataFrame:
    """(source_name, n, match_rate, mean_latency, median_latency, total_latency)."""
    source = F.coalesce("source_name", F.lit("none"))
    return records.groupBy(source.alias("source_name")).agg(F.count("*").alias("n"), F.round(F.avg(F.col("matched").cast("double")), 6).alias("match_rate"), F.round(F.avg("latency_ms"), 4).alias("mean_latency"), F.median("latency_ms").alias("median_latency"), F.coalesce(F.sum("latency_ms"), F.lit(0)).alias("total_latency"))


def metric_cube(records: DataFrame) -> DataFrame:
    """Counts by source and query type, by source, and in all."""
    return records.cube("source_name", "query_type").agg(F.count("*").alias("n"), F.count_if("matched").alias("n_matched"), F.grouping_id().cast("bigint").alias("level")).where("level in (0, 1, 3)")


def suspicion(audit: DataFrame) -> DataFrame:
    """(candidate_id, paper_id, score, paper_rows, unique): how doubtful an audited row is, 0 to 7.

    audit has candidate_id, paper_id, identifiers (their number), similarity, unmatched, venue and year. Two points for no
    identifier, two for a similarity under 0.45 (one under 0.7), one each for at most two unmatched sources, no venue, and no year.
    Unknown numbers count as 0. paper_rows is counted apart and joined, so a paper with many rows is no task of its own.
    """
    none = lambda c: F.coalesce(F.trim(c) == "", F.lit(True)).cast("int")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    score = F.when(zero("identifiers") == 0, 2).otherwise(0) + F.when(zero("similarity") < 0.45, 2).when(zero("similarity") < 0.7, 1).otherwise(0) + (zero("unmatched") <= 2).cast("int") + none("venue") + none("year")
    sizes = audit.where("paper_id is not null").groupBy("paper_id").agg(F.count("*").alias("paper_rows"))
    return audit.join(sizes, "paper_id", "left").select("candidate_id", "paper_id", score.alias("score"), "paper_rows", (F.col("paper_rows") == 1).alias("unique"))


def residual_bucket(openalex, openalex_words, crossref, crossref_words):
    """Why openalex left a title, from sequence and word similarities with its and crossref's title.

    Unknown similarities count as 0. Fixed values: the thresholds.
    """
    oa, oj, cr, cj = (F.coalesce(c, F.lit(0.0)) for c in (openalex, openalex_words, crossref, crossref_words))
    gap = (cr >= 0.9) & (cj >= 0.85) & (oa < 0.55) & (oj < 0.4)
    return F.when(gap, "likely_openalex_recall_gap").when((cr >= 0.8) & (oa >= 0.5), "possible_normalization_or_ranking_issue").when(cr < 0.8, "source_title_noise_or_crossref_cleanup").otherwise("mixed_or_unclear")


def timing(mails: DataFrame, target: int) -> DataFrame:
    """One row: mails timed, total, mean and greatest milliseconds, and the hours that target mails would take."""
    ms = F.col("wall_time_ms")
    return mails.where(ms.isNotNull()).agg(F.count("*").alias("n"), F.sum(ms).alias("total_ms"), F.round(F.avg(ms), 3).alias("mean_ms"), F.max(ms).alias("max_ms"), F.round(F.avg(ms) * target / 3_600_000, 4).alias("hours_for_target"))


def dispatch_cube(facts: DataFrame) -> DataFrame:
    """Counters of lookups by provider, type, outcome and all their totals (A17): rows, candidates, answered, latency.

    facts has provider, query_type, outcome, candidate_id, latency_ms. level says which of the three are totals (as bits).
    """
    return facts.cube("provider", "query_type", "outcome").agg(F.count("*").alias("n"), F.countDistinct("candidate_id").alias("n_candidates"), F.count_if(F.col("outcome") == "positive_match").alias("n_answered"), F.coalesce(F.sum("latency_ms"), F.lit(0)).alias("latency"), F.grouping_id().cast("bigint").alias("level"))


def render(title: str, rows: DataFrame) -> str:
    """A small report as text, a line per row (T1, S13). Reports have few rows by construction; the first 1,000 are shown."""
    columns = rows.columns
    lines = [" | ".join(f"{c}={r[c]}" for c in columns) for r in rows.limit(1000).collect()]
    return "\n".join([title, *lines]) + "\n"
