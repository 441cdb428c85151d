"""Relational shapes that stages are made of (op ids F2, J1-J15, A12, W1-W4, L1-L4, U1, S19, S20)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def unprocessed(rows: DataFrame, *done: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in none of the done tables."""
    return reduce(lambda left, right: left.join(right.select(on).distinct(), on, "left_anti"), done, rows)


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of the greatest order per key, by a maximum that combines on the map side."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), order).alias("x")
    return rows.groupBy(*keys).agg(best).select(*keys, *[f"x.{c}" for c in rest])


def richest(rows: DataFrame, keys: list[str], texts: list[str], order: str) -> DataFrame:
    """The row with most text per key, the first of equals."""
    size = reduce(lambda a, b: a + b, [F.coalesce(F.length(c), F.lit(0)) for c in texts])
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest, size.alias("richness")), F.struct(size, -F.col(order))).alias("x")
    return rows.groupBy(*keys).agg(best).select(*keys, *[f"x.{c}" for c in rest], "x.richness")


def first_rule(rows: DataFrame, targets: DataFrame, row_id: str, rules: list[str]) -> DataFrame:
    """(row_id, target, rule): per row the match of the first rule that hits.

    rows has row_id and one column per rule; targets has (rule, key, target). Of several targets of one key
    the smallest is taken.
    """
    keys = F.array(*[F.struct(F.lit(i).alias("priority"), F.lit(r).alias("rule"), F.col(r).alias("key")) for i, r in enumerate(rules)])
    asked = rows.select(row_id, F.explode(keys).alias("k")).select(row_id, "k.*").where("key is not null and key <> ''")
    one = targets.groupBy("rule", "key").agg(F.min("target").alias("target"))
    hits = asked.join(one, ["rule", "key"])
    best = hits.groupBy(row_id).agg(F.min(F.struct("priority", "rule", "target")).alias("b"))
    return best.select(row_id, "b.target", "b.rule")


def shared_key_edges(rows: DataFrame, row_id: str, keys: list[str]) -> DataFrame:
    """Edges (u, v) from rows to the keys that they hold, keys prefixed by their kind."""
    held = F.array(*[F.when(F.col(k) != "", F.concat(F.lit(f"\t{k}:"), F.col(k))) for k in keys])
    return rows.select(F.col(row_id).alias("u"), F.explode(F.array_compact(held)).alias("v"))


def star_edges(held: DataFrame) -> DataFrame:
    """Edges (u, v) from each row to the smallest row that holds the same key, of edges from rows to keys.

    They tie the same rows as the keys do, without vertices for keys; a key of many rows gives each one edge.
    """
    first = held.groupBy("v").agg(F.min("u").alias("first"), F.max("u").alias("last")).where("first < last").select("v", "first")
    return held.join(first, "v").where("u <> first").select("u", F.col("first").alias("v")).distinct()


def unpivot_keys(rows: DataFrame, row_id: str, keys: list[str]) -> DataFrame:
    """(row_id, key_type, key) of the non-blank keys."""
    return rows.unpivot([row_id], keys, "key_type", "key").where("trim(key) <> ''")


def neighbour_keys(rows: DataFrame, part: str, order: str, key: str, reach: int = 3, block: int = 4096) -> DataFrame:
    """Adds neighbours, the keys of the rows around with their signed distance, and place, the row's number.

    order is an integer that is unique within part. Rows are cut into blocks of order, so that no part is one task; a
    block also reads the last and first rows of the blocks around it, and places start at the rows before it. Blocks
    around are found among those that hold rows, whatever the gaps between them.
    """
    cut = F.floor(F.col(order) / block)
    held = rows.withColumn("_b", cut)
    sizes = held.groupBy(part, "_b").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(part).orderBy("_b")  # one row per block
    blocks = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    near = [F.lag("_b", -i).over(w) for i in range(-reach, reach + 1)]
    blocks = blocks.select(F.col(part).alias("_p"), F.col("_b").alias("_c"), "_n", "_before", F.array_compact(F.array(*near)).alias("_near"))
    numbered = held.withColumn("_r", F.row_number().over(Window.partitionBy(part, "_b").orderBy(order)))
    placed = numbered.join(blocks, F.col(part).eqNullSafe(F.col("_p")) & (F.col("_b") == F.col("_c"))).select(*rows.columns, "_b", "_near", "_n", "_r", (F.col("_r") + F.col("_before")).alias("place"))
    # rows at the ends of a block are needed by the blocks near it
    edge = (F.col("_r") <= reach) | (F.col("_r") > F.col("_n") - reach)
    sent = placed.withColumn("_to", F.explode(F.when(edge, F.col("_near")).otherwise(F.array("_b"))))
    v = Window.partitionBy(part, "_to").orderBy("place")
    around = [F.when(F.lag("place", -i).over(v) == F.col("place") + i, F.concat(F.lit(f"{i:+d}:"), F.lag(key, -i).over(v))) for i in range(-reach, reach + 1) if i]
    return sent.withColumn("neighbours", F.concat_ws(" ### ", *around)).where("_to = _b").select(*rows.columns, "neighbours", F.col("place").cast("bigint").alias("place"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """old with the rows of new in place of those with the same keys; of equal new keys the greatest order."""
    rank = F.struct(F.col("_new"), F.col(order)) if order else F.struct("_new")
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rest = [c for c in old.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("x")).select(*[c if c in keys else F.col(f"x.{c}") for c in old.columns])


def insert_new(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of new whose keys are not in old, the smallest order of each key."""
    rest = [c for c in new.columns if c not in keys]
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("x")).select(*[c if c in keys else F.col(f"x.{c}") for c in new.columns])
    return first.join(old.select(*keys).distinct(), keys, "left_anti")


def differences(a: DataFrame, b: DataFrame, on: str, values: list[str]) -> DataFrame:
    """Keys whose values differ between two runs, or that one run lacks."""
    left = a.select(on, F.lit(True).alias("in_a"), *[F.col(v).alias(f"{v}_a") for v in values])
    right = b.select(on, F.lit(True).alias("in_b"), *[F.col(v).alias(f"{v}_b") for v in values])
    differ = reduce(lambda x, y: x | y, [~F.col(f"{v}_a").eqNullSafe(F.col(f"{v}_b")) for v in values])
    side = F.when(F.col("in_b").isNull(), "only_a").when(F.col("in_a").isNull(), "only_b").otherwise("changed")
    return left.join(right, on, "full").where(F.col("in_a").isNull() | F.col("in_b").isNull() | differ).withColumn("side", side).drop("in_a", "in_b")
