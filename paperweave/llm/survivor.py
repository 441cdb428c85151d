"""Best representative of each duplicate group, by iterative truth discovery.

Rows vote for the values of their fields. A vote weighs the odds that its source is right, times a factor
that grows with recency within the candidate. How reliable a source is, is estimated from how often it agrees
with the values chosen so far where values differ (where all agree nothing can be learnt); its trust rank gives
the value that the estimate starts from, worth a few fields. Choosing values and estimating reliabilities
alternate until the reliabilities stop moving.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.fold import doi_expr
from ..operators.durable import Scratch

# Placeholders that stand for a missing value, after trimming, in lower case.
PLACEHOLDERS = ["-", "--", "...", "…", "?", "n/a", "na", "n.d.", "nd", "nil", "none", "null", "nan", "pending", "tba", "tbd", "unknown", "not available", "unavailable", "missing", "[no journal]", "no journal", "unknown venue", "unknown journal", "abstract", "no abstract", "no abstract available", "abstract unavailable", "abstract not available"]
#: Reliability that a source of the best rank starts with, how much a rank takes off, and how many fields the start is worth.
START, RANK_STEP, START_FIELDS = 0.8, 0.05, 5.0
#: Power of the odds that a vote weighs, and bounds of the reliability in them.
POWER, LEAST, MOST = 1.5, 0.02, 0.98
#: A row of the latest created_at of its candidate weighs this much more than one of the earliest.
RECENT = 4.0
_CUT = r"(?U)\s*(\.\.\.|…|\[\s*(truncated|more|…|\.\.\.)\s*\]|\(\s*(more|truncated)\s*\)?)\s*$"


def _usable(col):
    text = F.trim(F.regexp_replace(col, r"(?U)\s+", " "))
    bare = F.lower(F.regexp_replace(text, r"[.\s]+$", ""))
    return F.when((text != "") & ~F.lower(text).isin(PLACEHOLDERS) & ~bare.isin(PLACEHOLDERS) & (bare != ""), text)


def _votes(records: DataFrame) -> DataFrame:
    """(candidate_id, field_name, key, source_name, id, created_at, n_rows): the usable values of each matched row."""
    rows = records.where("matched and candidate_id is not null").select("candidate_id", "id", "source_name", "doi", "venue", "abstract", "created_at")
    many = rows.groupBy("candidate_id").agg(F.count("*").alias("n_rows"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at")).where("n_rows >= 2")
    rows = rows.join(many, "candidate_id")
    venue = F.regexp_replace(F.lower(_usable(F.col("venue"))), r"[^\p{L}\p{N}\p{M}]+", "")
    whole = F.regexp_replace(_usable(F.col("abstract")), _CUT, "")
    field = lambda name, key: F.struct(F.lit(name).alias("field_name"), key.alias("key"))
    fields = F.array(field("doi", doi_expr(F.col("doi"))), field("venue", F.when(venue != "", venue)), field("abstract", F.when(whole != "", F.rtrim(whole))))
    at = lambda c: F.col(c).cast("timestamp").cast("double")
    span = at("last_at") - at("first_at")
    fresh = F.when(span > 0, (at("created_at") - at("first_at")) / span).otherwise(1.0)
    return rows.select("candidate_id", "id", "source_name", "n_rows", F.coalesce(fresh, F.lit(0.0)).alias("fresh"), F.explode(fields).alias("x")).select("candidate_id", "id", "source_name", "n_rows", "fresh", "x.*").where("key is not null")


def _drop_shortened(votes: DataFrame) -> DataFrame:
    """Votes without abstracts that are a proper beginning of another abstract of the candidate.

    In the order of the distinct abstracts of a candidate, one that begins another is followed directly
    by an abstract that it begins; repeats were merged before, so a window holds distinct texts only.
    """
    # votes is read twice, so it should be a written table
    texts = votes.where("field_name = 'abstract'").groupBy("candidate_id", "key").agg(F.lit(1).alias("one"))
    w = Window.partitionBy("candidate_id").orderBy(F.col("key"))
    short = texts.withColumn("next", F.lead("key").over(w)).where("startswith(next, key)").select("candidate_id", "key", F.lit("abstract").alias("field_name"))
    return votes.join(short, ["candidate_id", "field_name", "key"], "left_anti")


def _chosen(tally: DataFrame, reliability: DataFrame) -> DataFrame:
    """(candidate_id, field_name, key, id, support, holders, n_rows): the value of most support of each field."""
    r = reliability.select(F.col("source_name").alias("rs"), F.least(F.greatest("r", F.lit(LEAST)), F.lit(MOST)).alias("r"))
    vote = F.pow(F.col("r") / (1 - F.col("r")), F.lit(POWER)) * (1 + (RECENT - 1) * F.col("fresh"))
    weighed = tally.join(r, F.col("source_name").eqNullSafe(F.col("rs"))).withColumn("w", vote)
    # one source speaks once for a value, so repeats of it add nothing
    support = weighed.groupBy("candidate_id", "field_name", "key").agg(F.sum("w").alias("support"), F.min("id").alias("id"), F.sum("n").alias("holders"), F.max("n_rows").alias("n_rows"))
    best = support.groupBy("candidate_id", "field_name").agg(F.max(F.struct(F.col("support"), (-F.col("id")).alias("neg"), F.col("key"), F.col("holders"), F.col("n_rows"))).alias("b"))
    return best.select("candidate_id", "field_name", "b.key", (-F.col("b.neg")).alias("id"), "b.support", "b.holders", "b.n_rows")


def discover(records: DataFrame, trust: DataFrame, max_rounds: int = 30, tolerance: float = 1e-3) -> DataFrame:
    """(candidate_id, field_name, id, support, holders, n_rows) of the chosen value of each field.

    Only matched rows of candidates with at least two of them vote. A value is usable unless it is null,
    blank, a placeholder, a DOI without its suffix, or a beginning of another abstract of the candidate;
    fields without usable value give no row. id is the smallest id that holds the chosen value, holders
    how many rows hold it. Ties of support go to the smaller id. Sources that are not in ``trust`` rank
    behind all that are; null sources too. An empty table gives no rows.
    """
    scratch = Scratch(records.sparkSession, "truth")
    ranks = trust.where("source_name is not null").groupBy("source_name").agg(F.min("trust_rank").alias("trust_rank"))
    last = ranks.agg(F.coalesce(F.max("trust_rank"), F.lit(0)).alias("last"))
    votes = _drop_shortened(scratch.keep(_votes(records), "votes")).withColumn("key", F.xxhash64("key"))
    tally = votes.groupBy("candidate_id", "field_name", "key", "source_name").agg(F.min("id").alias("id"), F.max("fresh").alias("fresh"), F.count("*").alias("n"), F.max("n_rows").alias("n_rows"))
    tally = scratch.keep(tally, "tally")
    differ = tally.groupBy("candidate_id", "field_name").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").select("candidate_id", "field_name")
    contested = scratch.keep(tally.join(differ, ["candidate_id", "field_name"], "left_semi"), "contested")
    # one row per source; last is one row
    sources = tally.select("source_name").distinct().join(ranks, "source_name", "left").crossJoin(last)
    start = F.greatest(F.lit(LEAST), START - RANK_STEP * (F.coalesce("trust_rank", F.col("last") + 1) - 1))
    sources = scratch.keep(sources.select("source_name", start.cast("double").alias("start")), "sources")
    reliability = sources.select("source_name", F.col("start").alias("r"))
    for _ in range(max_rounds):
        chosen = _chosen(contested, reliability).select("candidate_id", "field_name", F.col("key").alias("best"))
        agree = contested.join(chosen, ["candidate_id", "field_name"]).groupBy("source_name").agg(F.sum((F.col("key") == F.col("best")).cast("double")).alias("agree"), F.count("*").alias("of"))
        agree = agree.select(F.col("source_name").alias("rs"), "agree", "of")
        old = reliability.select(F.col("source_name").alias("os"), F.col("r").alias("old"))
        new = sources.join(agree, F.col("source_name").eqNullSafe(F.col("rs")), "left").join(old, F.col("source_name").eqNullSafe(F.col("os")))
        new = new.select("source_name", ((F.coalesce("agree", F.lit(0.0)) + START_FIELDS * F.col("start")) / (F.coalesce("of", F.lit(0)) + START_FIELDS)).alias("r"), "old")
        new = scratch.keep(new, "reliability")
        moved = new.agg(F.max(F.abs(F.col("r") - F.col("old")))).head()[0]
        reliability = new.select("source_name", "r")
        if moved is None or moved < tolerance:
            break
    return _chosen(tally, reliability).drop("key")


def surviving_fields(records: DataFrame, trust: DataFrame) -> DataFrame:
    """(candidate_id, field_name, id) where not all rows of the candidate hold the surviving value."""
    return discover(records, trust).where("holders < n_rows").select("candidate_id", "field_name", "id")


def surviving_records(records: DataFrame, trust: DataFrame) -> DataFrame:
    """(candidate_id, doi, venue, abstract): one record per candidate, each field from its surviving row."""
    picked = discover(records, trust).join(records.select("id", "doi", "venue", "abstract"), "id")
    of = lambda f: F.max(F.when(F.col("field_name") == f, F.col(f))).alias(f)
    return picked.groupBy("candidate_id").agg(of("doi"), of("venue"), of("abstract"))
