"""Consolidating pairwise matches into groups: union-find on a two-dimensional grid of edge blocks.

Vertices are hashed into blocks; the edge (u, v) lies in the cell (block of u, block of v). Each task
runs union-find over the edges of its cells and emits, per vertex it met, the representative of its local
tree. The representatives that a vertex got from the cells of its row and of its column are exchanged:
the vertex takes the smallest, and the trees of all others are joined to it by rewriting the edges. Rounds
go on until no edge is left, that is until all parents are stable. Representatives are compared by a
seeded hash that changes each round, so long chains shrink by a constant factor per round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.durable import Scratch

#: Edges that one cell holds on average; the grid gets finer as the edge list grows.
CELL_EDGES = 500_000
#: A task that has met this many vertices emits its trees and begins new ones, which bounds its memory.
FOREST = 1_000_000


def _flush(parent: dict, rank: dict) -> pd.DataFrame:
    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    nodes = list(parent)
    roots = [find(x) for x in nodes]
    return pd.DataFrame({"v": nodes, "r": roots, "hr": [rank[r] for r in roots]})


def _local_union_find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parent: dict = {}
    rank: dict = {}
    for pdf in batches:
        for u, v, hu, hv in zip(pdf["u"], pdf["v"], pdf["hu"], pdf["hv"], strict=True):
            if u not in parent:
                parent[u] = u
                rank[u] = hu
            if v not in parent:
                parent[v] = v
                rank[v] = hv
            while parent[u] != u:
                parent[u] = parent[parent[u]]
                u = parent[u]
            while parent[v] != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            if u != v:
                if (rank[u], u) <= (rank[v], v):
                    parent[v] = u
                else:
                    parent[u] = v
        if len(parent) > FOREST:
            yield _flush(parent, rank)
            parent, rank = {}, {}
    if parent:
        yield _flush(parent, rank)


def grid_components(edges: DataFrame, cell_edges: int = CELL_EDGES, max_rounds: int = 60) -> DataFrame:
    """(node, component) for edges (u, v) of strings; component is the smallest node of the component.

    Null ends and loops are ignored; repeated edges are merged; no edges give no rows. The hash of a
    vertex of very high degree lies in one row of the grid, so its edges spread over all its cells;
    parents are found by a minimum that combines on the map side.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "grid")
    e = scratch.keep(edges.select(F.col("u").cast("string"), F.col("v").cast("string")).where("u is not null and v is not null and u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    levels = []
    for seed in range(max_rounds):
        n = e.count()
        if n == 0:
            break
        side = max(2, math.ceil(math.sqrt(n / cell_edges)))
        block = lambda c: F.pmod(F.xxhash64(c), F.lit(side))  # noqa: E731, B023
        key = lambda c: F.xxhash64(c, F.lit(seed))  # noqa: E731, B023
        cells = e.withColumn("cell", block("u") * side + block("v")).withColumn("hu", key("u")).withColumn("hv", key("v"))
        local = cells.repartition(min(side * side, 4096), "cell").select("u", "v", "hu", "hv").mapInPandas(_local_union_find, "v string, r string, hr bigint")
        local = scratch.keep(local, "local")
        # exchange over the row and the column of a vertex: the smallest representative wins
        parent = scratch.keep(local.groupBy("v").agg(F.min(F.struct("hr", "r"))["r"].alias("p")), "parent")
        a, b = parent.select("v", F.col("p").alias("pv")), parent.select(F.col("v").alias("r"), F.col("p").alias("pr"))
        stars = local.where("v <> r").join(a, "v").join(b, "r").where("pv <> pr")
        nxt = scratch.keep(stars.select(F.least("pv", "pr").alias("u"), F.greatest("pv", "pr").alias("v")).distinct(), "edges")
        scratch.drop(local)
        scratch.drop(e)
        levels.append(parent)
        e = nxt
    else:
        raise RuntimeError("parents did not stabilise")
    if not levels:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = levels[-1]
    for level in reversed(levels[:-1]):
        up = out.select(F.col("v").alias("p"), F.col("p").alias("top"))
        out = level.join(up, "p", "left").select("v", F.coalesce("top", "p").alias("p"))
    smallest = out.groupBy("p").agg(F.min("v").alias("component"))
    return out.join(smallest, "p").select(F.col("v").alias("node"), "component")


def candidate_ties(prelink: DataFrame, status: DataFrame, review: DataFrame) -> DataFrame:
    """Edges (u, v) between candidates; papers stand as vertices prefixed by a tab, which no id holds.

    Counted are prelink rows with a paper_id, ``clustered`` rows with a leader, and review rows with the
    verdict ``same`` and a compared_with. Blank ids count as null; broken JSON counts as no verdict.
    """
    filled = lambda c: F.when(F.trim(c) != "", c)
    say = lambda k: F.get_json_object("assessment_json", f"$.{k}")
    paper = prelink.select(filled(F.col("candidate_id")).alias("u"), F.concat(F.lit("\t"), filled(F.col("paper_id"))).alias("v"))
    leader = status.where("status = 'clustered'").select(filled(F.col("candidate_id")).alias("u"), filled(F.col("leader_candidate_id")).alias("v"))
    same = review.where(say("verdict") == "same").select(filled(F.col("candidate_id")).alias("u"), filled(say("compared_with")).alias("v"))
    return paper.unionByName(leader).unionByName(same).where("u is not null and v is not null")


def candidate_groups(prelink: DataFrame, status: DataFrame, review: DataFrame) -> DataFrame:
    """(candidate_id, group_id) of every candidate in a group of at least two candidates.

    group_id is the smallest candidate_id of the group.
    """
    found = grid_components(candidate_ties(prelink, status, review)).where("not startswith(node, '\t')")
    # a tab sorts before any id, so components are named anew by their smallest candidate
    sizes = found.groupBy("component").agg(F.min("node").alias("group_id"), F.count("*").alias("n")).where("n > 1")
    return found.join(sizes, "component").select(F.col("node").alias("candidate_id"), "group_id")


def group_sizes(groups: DataFrame, audit: DataFrame) -> DataFrame:
    """Rows of the audit table with the stored and the corrected duplicate_group_size.

    A candidate without ties has size 1. A null candidate_id gets a null size.
    """
    sizes = groups.groupBy("group_id").agg(F.count("*").alias("n"))
    per = groups.join(sizes, "group_id").select("candidate_id", "group_id", "n")
    out = audit.select("candidate_id", "paper_id", F.col("duplicate_group_size").alias("stored_size")).join(per, "candidate_id", "left")
    size = F.when(F.col("candidate_id").isNotNull(), F.coalesce("n", F.lit(1)).cast("bigint"))
    return out.select("candidate_id", "paper_id", "stored_size", F.coalesce("group_id", "candidate_id").alias("group_id"), size.alias("group_size"))
