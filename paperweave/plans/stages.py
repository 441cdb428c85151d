"""Stages of the pipeline put together, and what steers them (op ids P2, M3, B1, V1, CFG1, CFG2)."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers as ids
from ..operators import grading, lookups, survivorship
from ..sources import alert_html
from .normalize import normalized


@dataclass(frozen=True)
class Policy:
    """What stages may do; ``with_overlay`` lays text values (of a file, say) over the defaults."""

    lanes: tuple[str, ...] = lookups.LANES
    broad: bool = False
    open_access: bool = False
    salvage_threshold: float = 0.85
    batch_limit: int = 0

    def with_overlay(self, values: Mapping[str, object]) -> Policy:
        """The policy with the known, non-blank values in place, read as the type of the default."""
        new = {}
        for f in fields(self):
            given = values.get(f.name)
            if given is None or (isinstance(given, str) and not given.strip()):
                continue
            old = getattr(self, f.name)
            if isinstance(old, bool):
                new[f.name] = given if isinstance(given, bool) else str(given).strip().lower() in ("1", "true", "yes", "on")
            elif isinstance(old, tuple):
                new[f.name] = tuple(x for v in (given.split(",") if isinstance(given, str) else given) if (x := str(v).strip()))
            else:
                new[f.name] = type(old)(given)
        return replace(self, **new)


def settings(environment: Mapping[str, str], dotenv: str = "", prefix: str = "PAPERWEAVE_") -> tuple[dict[str, str], str]:
    """(values, source): the prefixed variables of the environment over those of a ``.env`` text; source says which gave any.

    Lines are ``NAME=value``; quotes around values, ``export`` and comments are dropped.
    """
    filed = {}
    for line in dotenv.splitlines():
        name, eq, value = line.strip().removeprefix("export ").partition("=")
        if eq and not name.startswith("#"):
            filed[name.strip()] = value.strip().strip("'\"")
    own = lambda d: {k.removeprefix(prefix).lower(): v for k, v in d.items() if k.startswith(prefix) and v.strip()}
    a, b = own(filed), own(environment)
    return a | b, "+".join(n for n, d in (("file", a), ("environment", b)) if d) or "defaults"


def parse_stage(mails: DataFrame, snapshots: DataFrame, parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates, events) of the alert mails that have no candidates yet.

    mails has mail_uid and is_alert, snapshots mail_uid and body_html, parsed mail_uid. events has mail_uid,
    event (missing_snapshot, no_candidates or ok) and n, the mail's number of candidates.
    """
    due = mails.where("is_alert").select("mail_uid").distinct().join(parsed.select("mail_uid").distinct(), "mail_uid", "left_anti")
    bodies = due.join(snapshots.select("mail_uid", "body_html", F.lit(True).alias("there")), "mail_uid", "left")
    found = alert_html.candidates(bodies.where("there"))
    n = found.groupBy("mail_uid").agg(F.count("*").alias("n"))
    event = F.when(F.col("there").isNull(), "missing_snapshot").when(F.col("n").isNull(), "no_candidates").otherwise("ok")
    events = bodies.select("mail_uid", "there").distinct().join(n, "mail_uid", "left").select("mail_uid", event.alias("event"), F.coalesce("n", F.lit(0)).alias("n"))
    return found, events


def merged_records(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """One row per candidate with the merged fields, the grade of their conflicts and a confidence (M3).

    DOIs of pubmed that others speak against are left out, fields are picked by source and query, and what no source
    gives comes from the candidate's own earliest titled row. Candidates without matched records have confidence null.
    """
    one = candidates.where("candidate_id is not null").groupBy("candidate_id").agg(F.min_by(F.struct("id", "raw_title", "raw_authors", "raw_link", "raw_snippet", "target_url", "venue_guess", "year_guess"), F.struct(F.coalesce(F.trim("raw_title") == "", F.lit(True)), "id")).alias("x")).select("candidate_id", "x.*")
    own = normalized(one).select("candidate_id", F.col("norm_title").alias("o_title"), F.col("norm_venue").alias("o_venue"), F.col("year_guess").alias("o_year"), F.col("doi").alias("o_doi"), F.col("pmid").alias("o_pmid"), F.col("pmcid").alias("o_pmcid"), "url")
    gone = grading.suppressed_dois(records, own.select("candidate_id", F.col("o_venue").alias("venue"), F.col("o_year").alias("year"), "url", F.col("o_pmcid").alias("pmcid"))).select("id", F.lit(True).alias("gone"))
    kept = records.join(gone, "id", "left").withColumn("doi", F.when(F.col("gone").isNull(), F.col("doi"))).drop("gone")
    picked = survivorship.picked_fields(kept)
    of = lambda f: F.max(F.when(F.col("field_name") == f, F.col("value"))).alias(f)
    wide = picked.groupBy("candidate_id").agg(*[of(f) for f in survivorship.MERGED_FIELDS])
    rows = own.join(wide, "candidate_id", "left").join(grading.assessment(kept), "candidate_id", "left")
    filled = [F.coalesce(f, f"o_{f}").alias(f) for f in ("title", "venue", "year", "pmid", "pmcid")]
    return rows.select("candidate_id", *filled, F.coalesce(ids.find_doi(F.col("doi")), F.col("o_doi")).alias("doi"), "authors_json", "abstract", "worst", "blocked", "confidence")


def run_stages(spark: SparkSession, steps: Mapping[str, Callable[[], DataFrame]], write: Callable[[str, DataFrame], DataFrame]) -> DataFrame:
    """Runs stages in order, each written by ``write``, and returns (stage, rows, ms), a row per stage (B1, V1)."""
    log = []
    for name, step in steps.items():
        began = time.perf_counter()
        rows = write(name, step()).count()
        log.append((name, rows, int(1000 * (time.perf_counter() - began))))
    return spark.createDataFrame(log, "stage string, rows bigint, ms bigint")
