"""Linking candidates to a library by their keys, and open-access work (op ids I8, R1, R3, E2, F14, J4, O1, C3, C4, S20, S21)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rules in their order with the confidence of a hit, and the kind of alias each asks.
RULES = {"doi": 1.0, "pmid": 1.0, "pmcid": 1.0, "arxiv": 0.99, "scholar_cluster": 0.98, "url": 0.97}


def exact_keys(rows: DataFrame) -> DataFrame:
    """(candidate_id, key_type, key): the exact keys of candidates in the form in which they are compared (I8).

    rows has candidate_id, doi, pmid, pmcid, arxiv and url; a URL with ``cluster=`` gives that number as scholar_cluster.
    """
    form = {"doi": F.regexp_replace(F.lower(F.trim("doi")), r"^https?://doi\.org/", ""), "pmid": F.trim("pmid"), "pmcid": F.upper(F.trim("pmcid")), "arxiv": F.lower(F.trim("arxiv")), "scholar_cluster": F.regexp_extract("url", r"[?&]cluster=([^&#]+)", 1), "url": F.trim("url")}
    keys = rows.select("candidate_id", *[c.alias(k) for k, c in form.items()]).unpivot(["candidate_id"], list(form), "key_type", "key")
    return keys.where("key is not null and key <> ''").distinct()


def library_aliases(links: DataFrame, keys: DataFrame) -> DataFrame:
    """(key_type, key, paper_id): the paper that first held each key among the linked candidates.

    links has id, candidate_id, paper_id; a key keeps the paper of the smallest id that brought it.
    """
    linked = links.where("paper_id is not null").select("id", "candidate_id", "paper_id")
    return linked.join(keys, "candidate_id").groupBy("key_type", "key").agg(F.min_by("paper_id", F.struct("id", "paper_id")).alias("paper_id"))


def prelinked(keys: DataFrame, aliases: DataFrame, linked: DataFrame) -> DataFrame:
    """(candidate_id, paper_id, rule, confidence) of candidates not linked yet, by the first rule that hits."""
    order = F.array(*[F.lit(k) for k in RULES])
    hits = keys.join(linked.select("candidate_id").distinct(), "candidate_id", "left_anti").join(aliases, ["key_type", "key"])
    best = hits.groupBy("candidate_id").agg(F.min(F.struct(F.array_position(order, F.col("key_type")).alias("place"), "paper_id", "key_type")).alias("b"))
    confidence = F.create_map(*[F.lit(x) for kv in RULES.items() for x in kv])[F.col("b.key_type")]
    return best.select("candidate_id", "b.paper_id", F.concat("b.key_type", F.lit("_exact")).alias("rule"), confidence.alias("confidence"))


def resolve_next(rows: DataFrame, aliases: DataFrame, linked: DataFrame, n: int) -> DataFrame:
    """``prelinked`` for the first n candidates that are not linked (R3). The limit is the feature: a batch of the queue."""
    due = rows.join(linked.select("candidate_id").distinct(), "candidate_id", "left_anti").orderBy("id").limit(n)
    return prelinked(exact_keys(due), aliases, linked)


def load_proposals(held: DataFrame, curated: DataFrame, links: DataFrame) -> DataFrame:
    """held with curated proposals in place of those of the same candidates, except of linked candidates."""
    new = curated.join(links.where("paper_id is not null").select("candidate_id").distinct(), "candidate_id", "left_anti").select(*held.columns)
    return held.join(new.select("candidate_id").distinct(), "candidate_id", "left_anti").unionByName(new)


# ---- open access
def oa_queue(papers: DataFrame, statuses: DataFrame, provider: str = "unpaywall") -> DataFrame:
    """(paper_id, doi) with a DOI and without a status of the provider, or whose last try failed."""
    own = statuses.where(F.col("provider") == provider).groupBy("paper_id").agg(F.max_by("status", "id").alias("status"))
    return papers.where("trim(doi) <> ''").join(own, "paper_id", "left").where("status is null or status = 'error'").select("paper_id", "doi")


def oa_status(payload, matched):
    """What a lookup of open access came to: ok where it was answered, no_match, or error."""
    error, http = F.get_json_object(payload, "$.error"), F.get_json_object(payload, "$.http_error")
    told = lambda c: F.coalesce(~F.lower(c).isin("", "false", "null", "0", "[]", "{}"), F.lit(False))
    return F.when(F.coalesce(matched, F.lit(False)), "ok").when(F.coalesce(http == "404", F.lit(False)), "no_match").when(told(error) | told(http), "error").otherwise("no_match")


def oa_snapshots(held: DataFrame, answers: DataFrame) -> DataFrame:
    """held with the snapshots of new answers; failed lookups overwrite nothing (O1, C4).

    Both have paper_id, status, is_open, url, score and id. is_open falls back to a score of 1.
    """
    good = answers.where("status <> 'error'").withColumn("is_open", F.coalesce("is_open", F.col("score") >= 1.0))
    both = held.withColumn("_new", F.lit(0)).unionByName(good.withColumn("_new", F.lit(1)).select(*held.columns, "_new"))
    rest = [c for c in held.columns if c != "paper_id"]
    return both.groupBy("paper_id").agg(F.max_by(F.struct(*rest), F.struct("_new", "id")).alias("x")).select("paper_id", *[f"x.{c}" for c in rest])
