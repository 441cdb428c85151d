"""Messages delivered more than once: keep one copy of each.

Identifiers that a producer numbers (``Name-123@host``) are tracked as disjoint ranges of seen numbers
per producer; a number is accepted once and covered from then on. All other identifiers are resolved by
exact lookup of the whole identifier. Ranges and keys are carried from batch to batch. Rows may also share a
mailbox uid; the accepted rows are then tied through it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .durable import Scratch
from .graph import connected_components

#: Numbers of a producer are handled in blocks of this many, so no producer forms one group.
BLOCK = 65_536
_SEQUENCE = r"^([A-Za-z][A-Za-z_-]*)-(0|[1-9][0-9]{0,17})@(\S+)$"


def identifiers(mails: DataFrame) -> DataFrame:
    """Adds message_key, producer, number.

    message_key is the message id without surrounding blanks and angle brackets, null if nothing is
    left. producer and number are null for identifiers that no producer counts (malformed ones).
    """
    key = F.regexp_replace("message_id", r"(?U)^[\s<>]+|[\s<>]+$", "")
    out = mails.withColumn("message_key", F.when(key != "", key))
    part = lambda i: F.regexp_extract("message_key", _SEQUENCE, i)
    counted = F.col("message_key").rlike(_SEQUENCE)
    return out.withColumn("producer", F.when(counted, F.concat(part(1), F.lit("@"), part(3)))).withColumn("number", F.when(counted, part(2).cast("bigint")))


def seen_ranges(numbers: DataFrame) -> DataFrame:
    """(producer, lo, hi): disjoint ranges that cover exactly the given (producer, number) rows.

    Ranges end at multiples of BLOCK, so a group holds at most BLOCK distinct numbers.
    """
    block = F.floor(F.col("number") / BLOCK)
    distinct = numbers.where("producer is not null").select("producer", "number").distinct().withColumn("block", block)
    w = Window.partitionBy("producer", "block").orderBy("number")
    island = distinct.withColumn("island", F.col("number") - F.row_number().over(w))
    return island.groupBy("producer", "block", "island").agg(F.min("number").alias("lo"), F.max("number").alias("hi")).select("producer", "lo", "hi")


def merge_ranges(old: DataFrame, new: DataFrame) -> DataFrame:
    """The disjoint ranges that cover what either table covers."""
    both = old.unionByName(new).withColumn("block", F.floor(F.col("lo") / BLOCK))
    w = Window.partitionBy("producer", "block").orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    start = (reach.isNull() | (F.col("lo") > reach + 1)).cast("int")
    piece = both.withColumn("start", start).withColumn("piece", F.sum("start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return piece.groupBy("producer", "block", "piece").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("producer", "lo", "hi")


def accept(batch: DataFrame, ranges: DataFrame | None = None, keys: DataFrame | None = None) -> DataFrame:
    """(kind, producer, number, message_key, id): one row per identifier of the batch not seen before.

    id is the smallest id that carries it. ``ranges`` are the ranges seen before, ``keys`` the malformed
    identifiers (message_key) seen before; both may be None.
    """
    named = identifiers(batch).where("message_key is not null")
    counted = named.where("producer is not null").groupBy("producer", "number").agg(F.min("id").alias("id"))
    if ranges is not None:
        r = ranges.withColumn("block", F.floor(F.col("lo") / BLOCK)).withColumnRenamed("producer", "rp")
        inside = (F.col("rp") == F.col("producer")) & (F.floor(F.col("number") / BLOCK) == F.col("block")) & F.col("number").between(F.col("lo"), F.col("hi"))
        counted = counted.join(r, inside, "left_anti")
    other = named.where("producer is null").groupBy("message_key").agg(F.min("id").alias("id"))
    if keys is not None:
        other = other.join(keys.select("message_key"), "message_key", "left_anti")
    none = lambda t: F.lit(None).cast(t)
    return counted.select(F.lit("range").alias("kind"), "producer", "number", none("string").alias("message_key"), "id").unionByName(
        other.select(F.lit("lookup").alias("kind"), none("string").alias("producer"), none("bigint").alias("number"), "message_key", "id")
    )


class Seen:
    """What has been accepted so far: disjoint ranges per producer, and identifiers that no producer counts."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.ranges, self.keys = scratch, None, None

    def take(self, batch: DataFrame) -> DataFrame:
        """The rows that ``accept`` lets in, which are covered from now on."""
        new = self.scratch.keep(accept(batch, self.ranges, self.keys), "accepted")
        own = seen_ranges(new.where("kind = 'range'"))
        self.ranges = self.scratch.keep(own if self.ranges is None else merge_ranges(self.ranges, own), "ranges")
        keys = new.where("kind = 'lookup'").select("message_key")
        self.keys = keys if self.keys is None else self.keys.unionByName(keys)
        return new


def accepted(mails: DataFrame, seen: Seen, steps: int = 4) -> DataFrame:
    """(kind, producer, number, message_key, id): the first row of every identifier.

    The rows are delivered in the order of their ids, in ``steps`` batches of equal id width; each batch meets
    only the ranges and keys that the ones before left.
    """
    ends = mails.agg(F.min("id").alias("lo"), F.max("id").alias("hi")).head()
    if ends["lo"] is None:
        return seen.take(mails)
    out, width = None, max(1, -(-(ends["hi"] - ends["lo"] + 1) // steps))
    for start in range(ends["lo"], ends["hi"] + 1, width):
        new = seen.take(mails.where(F.col("id").between(start, start + width - 1)))
        out = new if out is None else out.unionByName(new)
    return out


def _tied(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of (uid, rep) edges. Pairs that nothing else is tied to need no rounds."""
    e = scratch.keep(edges.distinct(), "ties")
    several = lambda a, b: e.groupBy(a).agg(F.min(b).alias("x"), F.max(b).alias("y")).where("x < y").select(a)
    uids, reps = several("uid", "rep"), several("rep", "uid")
    marked = e.join(uids.withColumn("mu", F.lit(1)), "uid", "left").join(reps.withColumn("mr", F.lit(1)), "rep", "left")
    marked = scratch.keep(marked.select("uid", "rep", F.coalesce("mu", "mr").isNotNull().alias("tied")), "marked")
    single = marked.where("not tied")
    pairs = single.select(F.col("uid").alias("node"), F.col("rep").alias("component")).unionByName(single.select(F.col("rep").alias("node"), F.col("rep").alias("component")))
    return pairs.unionByName(connected_components(marked.where("tied"), "uid", "rep"))


def messages(mails: DataFrame, seen: Seen | None = None) -> DataFrame:
    """(id, first_id, via) of every row: the smallest id of its message and how its identifier was resolved.

    A row whose identifier the ranges or keys don't cover yet is accepted and stands for it; a covered one belongs
    to the row accepted before. Rows of one mail_uid are tied through the rows that stand for them, directly or
    through others. Rows with neither mail_uid nor identifier are their own message (via ``none``). Blank mail_uids
    count as null. Repeated rows with one id give repeated results; columns besides id, mail_uid and message_id are
    ignored. Empty tables give no rows.
    """
    scratch = Scratch(mails.sparkSession, "delivery")
    mails = mails.select("id", "mail_uid", "message_id")
    first = accepted(mails, seen or Seen(scratch))
    ident = F.when(F.col("producer").isNotNull(), F.concat(F.lit("s:"), "producer", F.lit("#"), F.col("number").cast("string"))).otherwise(F.concat(F.lit("m:"), "message_key"))
    first = first.select(ident.alias("ident"), F.col("id").alias("stands"))
    uid = F.when(F.trim("mail_uid") != "", F.concat(F.lit("u:"), "mail_uid"))
    via = F.when(F.col("producer").isNotNull(), "range").when(F.col("message_key").isNotNull(), "lookup").otherwise("none")
    rows = identifiers(mails).select("id", uid.alias("uid"), ident.alias("ident"), via.alias("via"))
    # an accepted row stands for itself, every other one for the row accepted before it
    own = first.select("ident", F.col("stands").alias("id"), F.lit(True).alias("accepted"))
    rows = rows.join(own, ["ident", "id"], "left")
    before = first.groupBy("ident").agg(F.min("stands").alias("stands"))
    rows = rows.join(before, "ident", "left").withColumn("rep", F.concat(F.lit("i:"), F.when(F.col("accepted"), F.col("id")).otherwise(F.col("stands")).cast("string")))
    rows = scratch.keep(rows.select("id", "uid", "rep", "via"), "rows")
    labels = _tied(rows.where("uid is not null and rep is not null").select("uid", "rep"), scratch)
    node = F.coalesce("uid", "rep", F.concat(F.lit("i:"), F.col("id").cast("string")))
    rows = rows.withColumn("node", node).join(labels, "node", "left").withColumn("label", F.coalesce("component", "node"))
    smallest = rows.groupBy("label").agg(F.min("id").alias("first_id"))
    return rows.join(smallest, "label").select("id", "first_id", "via")


def repeats(mails: DataFrame) -> DataFrame:
    """(id) of the rows that repeat a message of a row with a smaller id."""
    return messages(mails).where("id > first_id").select("id")
