"""Incremental import of mails as a stream of files (an addition to the batch import)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import alert_reason
from ..sources.mail_json import MAIL
from ..sources.store import Store


def mail_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Mails of the JSONL files that arrive in a folder."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    r = F.from_json("value", MAIL).alias("r")
    rows = lines.select(r).where("r is not null").select(F.trim("r.mail_uid").alias("mail_uid"), F.trim("r.message_id").alias("message_id"), "r.from_address", "r.subject", "r.internal_date", "r.body_text", "r.body_html")
    return rows.where("mail_uid <> ''").withColumn("alert_reason", alert_reason(F.col("from_address"), F.col("subject"), F.concat_ws("\n", "body_text", "body_html")))


def into_store(stream: DataFrame, store: Store, name: str, checkpoint: str) -> StreamingQuery:
    """Adds every mail once, whatever repeats come in a batch or in later ones."""

    def batch(df: DataFrame, _: int) -> None:
        store.add(name, df, ["mail_uid"], "internal_date")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
