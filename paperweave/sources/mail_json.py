"""Import of mail bodies from JSON and JSONL (op ids S2-S6, I11, I12)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, MapType, StringType, StructField, StructType
from pyspark.sql.window import Window

from ..functions.identifiers import mail_uid_of
from ..functions.text import alert_reason
from .store import exists

_TEXT = ["mail_uid", "message_id", "mail_key", "subject", "from_address", "sender", "internal_date", "date_text", "body_text", "body_html", "url", "snapshot_path", "source_path"]
MAIL = StructType([StructField(c, StringType()) for c in _TEXT] + [StructField("is_unread", BooleanType()), StructField("headers", MapType(StringType(), StringType())), StructField("page_no", IntegerType()), StructField("row_index", IntegerType())])


def input_path(spark: SparkSession, path: str) -> str:
    """The reconciled sibling of a JSONL file, if there is one in its file system."""
    stem, ending = os.path.splitext(path)
    sibling = f"{stem}_reconciled{ending}"
    return sibling if ending == ".jsonl" and not stem.endswith("_reconciled") and exists(spark, sibling) else path


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, raw_line) with 1-based numbers; byte order marks and NUL bytes are dropped (S3).

    Large files are read in splits: lines are counted per split, and numbered from the count of the splits before it.
    """
    meta = F.col("_metadata")
    rows = spark.read.text(path).select(meta["file_path"].alias("file"), meta["file_block_start"].alias("split"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw_line"))
    sizes = rows.groupBy("file", "split").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per split
    place = F.row_number().over(Window.partitionBy("file", "split").orderBy("at"))
    numbered = rows.withColumn("k", place).join(sizes.select("file", "split", before.alias("before")), ["file", "split"]).withColumn("line_no", (F.col("k") + F.col("before")).cast("int"))
    text = F.regexp_replace("raw_line", "\u0000", "")
    return numbered.select("file", "line_no", F.when(F.col("line_no") == 1, F.regexp_replace(text, "^\ufeff", "")).otherwise(text).alias("raw_line"))


def validate(lines: DataFrame) -> DataFrame:
    """Adds state (valid, blank, invalid), error and record; a line that is no JSON object is invalid."""
    parsed = F.from_json("raw_line", MAIL, {"mode": "PERMISSIVE"})
    text = F.trim("raw_line")
    sound = F.try_parse_json(F.col("raw_line")).isNotNull()
    state = F.when(text == "", "blank").when(~sound, "invalid").when(~text.startswith("{"), "invalid").otherwise("valid")
    error = F.when(state == "invalid", F.when(~sound, "not JSON").otherwise("not an object"))
    return lines.withColumn("state", state).withColumn("error", error).withColumn("record", F.when(F.col("state") == "valid", parsed))


def quarantine(validated: DataFrame) -> DataFrame:
    """(file, line_no, error, raw_line) of invalid lines, cut to 1000 characters."""
    return validated.where("state = 'invalid'").select("file", "line_no", "error", F.substring("raw_line", 1, 1000).alias("raw_line"))


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON documents: an object with ``records``, an array, or one object."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\ufeff", "").alias("value"))
    listed = F.coalesce(F.get_json_object("value", "$.records"), F.when(F.ltrim("value").startswith("["), F.col("value")), F.concat(F.lit("["), "value", F.lit("]")))
    items = F.from_json(listed, "array<string>")
    return whole.select(F.posexplode(items).alias("p", "raw_line")).select((F.col("p") + 1).alias("line_no"), "raw_line", F.from_json("raw_line", MAIL).alias("record"))


def mails(validated: DataFrame) -> DataFrame:
    """One row per valid record with uid, sender, bodies, alert reason, body hash; first of equal uids."""
    r = F.col("record")
    full = lambda c: F.nullif(F.trim(r[c]), F.lit(""))
    body = F.sha2(F.concat_ws("\u0001", *[F.coalesce(r[c], F.lit("")) for c in ("subject", "body_text", "body_html")]), 256)
    parts = [full(c) for c in ("message_id", "mail_key", "subject", "internal_date", "date_text")]
    keyed = F.coalesce(*parts)
    uid = F.coalesce(full("mail_uid"), F.when(keyed.isNotNull(), mail_uid_of(*parts)), F.concat(F.lit("local_"), F.substring(body, 1, 40)))
    sender = F.coalesce(full("from_address"), full("sender"))
    rows = validated.where("state = 'valid'").select("file", "line_no", uid.alias("mail_uid"), full("message_id").alias("message_id"), sender.alias("from_address"), full("subject").alias("subject"), F.coalesce(full("internal_date"), full("date_text")).alias("internal_date"), r["body_text"].alias("body_text"), r["body_html"].alias("body_html"), F.coalesce(r["is_unread"], F.lit(True)).alias("is_unread"), body.alias("body_hash"))
    rows = rows.withColumn("alert_reason", alert_reason(F.col("from_address"), F.col("subject"), F.concat_ws("\n", "body_text", "body_html")))
    first = F.row_number().over(Window.partitionBy("mail_uid").orderBy("file", "line_no"))
    return rows.withColumn("k", first).where("k = 1").drop("k")


def line_report(validated: DataFrame, strict: bool = False, shown: int = 20) -> dict:
    """Lines in all, blank, valid and invalid, and the first numbers of invalid ones.

    With strict, invalid lines are an error.
    """
    state = lambda x: F.count_if(F.col("state") == x).alias(x)
    counts = validated.agg(F.count("*").alias("total"), state("blank"), state("valid"), state("invalid")).head().asDict()
    bad = [r["line_no"] for r in validated.where("state = 'invalid'").orderBy("file", "line_no").select("line_no").limit(shown).collect()]
    if strict and counts["invalid"]:
        raise ValueError(f"{counts['invalid']} invalid lines, first {bad}")
    return counts | {"invalid_lines": bad}


def import_counts(validated: DataFrame, held: DataFrame) -> DataFrame:
    """One row: records processed, imported, skipped (held already or repeated) and without a body."""
    rows = mails(validated)
    known = held.select("mail_uid", F.lit(True).alias("held")).distinct()
    marked = rows.join(known, "mail_uid", "left").withColumn("bare", F.concat_ws("", F.trim("body_text"), F.trim("body_html")) == "")
    new = F.col("held").isNull()
    out = marked.agg(F.count_if(new & ~F.col("bare")).alias("imported"), F.count_if(F.col("bare")).alias("no_body"))
    total = validated.where("state = 'valid'").agg(F.count("*").alias("processed"))
    return total.crossJoin(out).select("processed", "imported", (F.col("processed") - F.col("imported") - F.col("no_body")).alias("skipped"), "no_body")  # one row each
