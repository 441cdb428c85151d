"""Connected components by randomised contraction, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .durable import Scratch


#: Edges that are settled in one task, once no more are left.
SETTLE = 100_000


def _settled(edges: DataFrame) -> DataFrame:
    """(u, p): every node of a bounded number of edges with the smallest node of its component, by union-find."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        up: dict = {}

        def top(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for pdf in batches:
            for a, b in zip(pdf["u"], pdf["v"], strict=True):
                x, y = top(up.setdefault(a, a)), top(up.setdefault(b, b))
                if x != y:
                    up[max(x, y)] = min(x, y)
        if up:
            yield pd.DataFrame({"u": list(up), "p": [top(x) for x in up]})

    kind = edges.schema["u"].dataType
    return edges.coalesce(1).mapInPandas(run, StructType([StructField("u", kind), StructField("p", kind)]))


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60, settle: int = SETTLE) -> DataFrame:
    """(node, component) of every node of an undirected edge list.

    Each round gives every node the neighbour (or itself) with the smallest seeded hash as its
    representative and rewrites the edges between representatives; a new seed each round makes the
    expected number of rounds logarithmic whatever the shape of the graph. A component is named by one
    of its nodes. Minimum by hash combines on the map side, so a node of very high degree costs one
    row per input partition; the joins have one row per node on one side, which AQE splits when
    skewed. Null ends and loops are ignored; an empty edge list gives an empty result. Once at most ``settle`` edges
    are left, one task settles them.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "components")
    e = scratch.keep(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null and u <> v").distinct(), "edges")
    levels = []
    for seed in range(max_rounds):
        n = e.count()
        if 0 < n <= settle:
            levels.append(scratch.keep(_settled(e), "settled"))
        if n <= settle:
            break
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(seed)).alias("h"), F.col(c).alias("n"))  # noqa: E731, B023
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rep = both.groupBy("u").agg(F.min(rank("v")).alias("m")).select("u", F.least(F.col("m"), rank("u"))["n"].alias("p"))
        rep = scratch.keep(rep, "rep")
        a, b = rep.select("u", F.col("p").alias("pu")), rep.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        nxt = e.join(a, "u").join(b, "v").where("pu <> pv").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct()
        nxt = scratch.keep(nxt, "edges")
        scratch.drop(e)
        levels.append(rep)
        e = nxt
    else:
        raise RuntimeError("connected components did not settle")
    if not levels:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = levels[-1]
    for level in reversed(levels[:-1]):
        up = out.select(F.col("u").alias("p"), F.col("p").alias("top"))
        out = level.join(up, "p", "left").select("u", F.coalesce("top", "p").alias("p"))
    return out.select(F.col("u").alias("node"), F.col("p").alias("component"))
