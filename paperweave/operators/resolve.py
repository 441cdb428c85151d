"""Grouping and canonical assignment of candidates (op ids R1-R3, D2, I8)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import Scratch
from .graph import connected_components
from .relational import shared_key_edges, star_edges

#: Keys by which candidates are the same, the most telling first.
EXACT_KEYS = ["doi", "pmid", "pmcid", "arxiv", "url"]


def clusters(rows: DataFrame, keys: list[str] = EXACT_KEYS, order: str = "id") -> DataFrame:
    """(row, leader, n): the groups of at least two rows that share exact keys, directly or not (R2).

    rows has candidate_id, the keys, and an order. The leader holds the most telling keys; of equals the
    first in order. Null and blank keys tie nothing.
    """
    rows = Scratch(rows.sparkSession, "clusters").keep(rows.select("candidate_id", order, *keys), "rows")
    labels = connected_components(star_edges(shared_key_edges(rows, "candidate_id", keys)))
    member = rows.join(labels, rows.candidate_id == labels.node).drop("node")
    has = F.array(*[F.coalesce(F.col(k) != "", F.lit(False)).cast("int") for k in keys])
    best = member.groupBy("component").agg(F.max_by("candidate_id", F.struct(has, -F.col(order))).alias("leader"), F.countDistinct("candidate_id").alias("n"))
    return member.select("candidate_id", "component").distinct().join(best, "component").where("n > 1").select("candidate_id", "leader", "n")


# Confidence of an assignment by identifier, by title, and of a new record.
BY_IDENTIFIER, BY_TITLE, NEW = 0.95, 0.75, 0.6


class _Founders:
    """The keys of one component's founders; a row is placed by the first rule that finds its key among them."""

    def __init__(self, n_keys: int):
        self.held: list[dict] = [{} for _ in range(n_keys + 2)]

    def place(self, name: str, keys: tuple, title: str | None, year: str | None, founds: bool) -> tuple[str, str, float]:
        """(founder, rule, confidence); the row becomes a founder if no rule hits, or at once if founds."""
        n = len(keys)
        own = [*keys, (title, year) if title and year else None, title]
        if not founds:
            for i, k in enumerate(own):
                if k and k in self.held[i]:
                    return self.held[i][k], "title_year" if i == n else "title" if i > n else f"rule_{i + 1}", BY_TITLE if i >= n else BY_IDENTIFIER
        for i, k in enumerate(own):
            if k:
                self.held[i].setdefault(k, name)
        return name, "new", NEW


def assign(rows: DataFrame, keys: list[str], order: str = "id", title: str | None = None, year: str | None = None, canonicals: DataFrame | None = None) -> DataFrame:
    """(candidate_id, founder, rule, confidence): canonical assignment in order.

    A row joins the founder with which it shares the first key in the given order of keys, else title and year, else
    the title alone (if these columns are given); else it founds a record itself. Only founders contribute keys.
    canonicals (paper_id and the same columns) are founders from before, ahead of all rows. Null and blank keys tie
    nothing. Components of shared keys are independent, so each is folded alone; a task streams the sorted rows of its
    components and holds the keys of one component's founders at a time, never its rows.
    """
    scratch = Scratch(rows.sparkSession, "assign")
    extra = [title or "", year or ""]
    col = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) if c else F.lit(None).cast("string")
    shape = [*[col(k).alias(f"k{i}") for i, k in enumerate(keys)], col(extra[0]).alias("title"), col(extra[1]).alias("year")]
    own = rows.select(F.col("candidate_id").alias("name"), F.col(order).cast("bigint").alias("place"), F.lit(False).alias("founds"), *shape)
    if canonicals is not None:
        own = own.unionByName(canonicals.select(F.col("paper_id").alias("name"), F.lit(-(1 << 62)).cast("bigint").alias("place"), F.lit(True).alias("founds"), *shape))
    own = scratch.keep(own.withColumn("node", F.concat(F.when(F.col("founds"), "p:").otherwise("c:"), "name")), "rows")
    names = [f"k{i}" for i in range(len(keys))]
    labels = connected_components(star_edges(shared_key_edges(own, "node", [*names, "title"]))).withColumnRenamed("node", "n")
    tied = own.join(labels, own.node == labels.n).drop("n")
    schema = "candidate_id string, founder string, rule string, confidence double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        founders, at = _Founders(len(names)), None
        for pdf in batches:
            out = []
            for component, name, founds, *rest in pdf[["component", "name", "founds", *names, "title", "year"]].itertuples(index=False, name=None):
                if component != at:
                    founders, at = _Founders(len(names)), component
                placed = founders.place(name, tuple(rest[:-2]), rest[-2], rest[-1], bool(founds))
                if not founds:
                    out.append((name, *placed))
            if out:
                yield pd.DataFrame(out, columns=["candidate_id", "founder", "rule", "confidence"])

    folded = tied.repartition("component").sortWithinPartitions("component", "place", "name").mapInPandas(run, schema)
    alone = own.where("not founds").join(labels, own.node == labels.n, "left_anti").select(F.col("name").alias("candidate_id"), F.col("name").alias("founder"), F.lit("new").alias("rule"), F.lit(NEW).alias("confidence"))
    return folded.unionByName(alone)
