"""Messages in RFC 822 form (op ids S1, S7)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from email import message_from_bytes, policy

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "path string, message_id string, subject string, from_address string, internal_date string, body_text string, body_html string, raw_hash string"


def parse_message(content: bytes) -> dict:
    """Headers and bodies of a message; parts of one kind are joined by line breaks, attachments skipped."""
    message = message_from_bytes(content, policy=policy.default)
    bodies: dict[str, list[str]] = {"text/plain": [], "text/html": []}
    for part in message.walk():
        if part.get_content_type() in bodies and part.get_content_disposition() != "attachment":
            try:
                bodies[part.get_content_type()].append(part.get_content())
            except (LookupError, UnicodeError, KeyError):
                continue
    head = lambda k: str(message[k]) if message[k] is not None else None
    return {"message_id": head("Message-ID"), "subject": head("Subject"), "from_address": head("From"), "internal_date": head("Date"), "body_text": "\n".join(bodies["text/plain"]), "body_html": "\n".join(bodies["text/html"]), "raw_hash": hashlib.sha256(content).hexdigest()}


def _parsed(files: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([{"path": p} | parse_message(c) for p, c in zip(pdf["path"], pdf["content"], strict=True)])

    return files.select("path", "content").mapInPandas(run, _SCHEMA)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages of ``.eml`` files below a folder."""
    return _parsed(spark.read.format("binaryFile").option("pathGlobFilter", "*.eml").option("recursiveFileLookup", "true").load(path))


def mailbox(spark: SparkSession, folder: str, unseen_only: bool = False, limit: int | None = None) -> DataFrame:
    """The messages of a maildir-like folder of files (S1): all or the unseen ones, the last ``limit`` by name if given.

    A file is seen if its name ends in flags with S (``name;2,S``; ``!`` and ``:`` also separate, where the file system
    allows them). The limit is the feature: a scan of the newest.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    files = files.withColumn("_name", F.regexp_extract("path", r"([^/]+)$", 1))
    if unseen_only:
        files = files.where(~F.col("_name").rlike(r"[:;!]2,[A-Z]*S"))
    if limit is not None:
        newest = files.select("path", "_name").orderBy(F.desc("_name")).limit(limit)
        files = files.join(newest.select("path"), "path", "left_semi")
    return _parsed(files)
