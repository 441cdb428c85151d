"""Snapshots of tables and file sinks (op ids S8, S12-S16, S18-S20)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.relational import insert_new, upsert


class Store:
    """Tables below a folder, each a series of parquet snapshots of which a pointer names the current one.

    A new snapshot is written beside the old one and then named, so a job never overwrites what it reads
    and a failed write leaves the table as it was.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _current(self, name: str) -> str | None:
        fs, p = self._fs(f"{self.root}/{name}/_current")
        if not fs.exists(p):
            return None
        return self.spark.read.text(f"{self.root}/{name}/_current").head()[0]

    def exists(self, name: str) -> bool:
        return self._current(name) is not None

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}/{self._current(name)}")

    def write(self, name: str, df: DataFrame) -> DataFrame:
        snapshot = uuid.uuid4().hex
        df.write.parquet(f"{self.root}/{name}/{snapshot}")
        pointer = f"{self.root}/{name}/_current"
        self.spark.createDataFrame([(snapshot,)], "value string").coalesce(1).write.mode("overwrite").text(pointer)
        return self.read(name)

    def create(self, name: str, schema: str) -> DataFrame:
        """The table, made empty if there is none."""
        return self.read(name) if self.exists(name) else self.write(name, self.spark.createDataFrame([], schema))

    def add(self, name: str, rows: DataFrame, keys: list[str], order: str) -> DataFrame:
        """Insert or ignore."""
        if not self.exists(name):
            return self.write(name, insert_new(rows.limit(0), rows, keys, order))
        old = self.read(name)
        return self.write(name, old.unionByName(insert_new(old, rows, keys, order)))

    def put(self, name: str, rows: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
        """Insert or replace."""
        return self.write(name, upsert(self.read(name), rows, keys, order) if self.exists(name) else rows)

    def copy_from(self, donor: Store, name: str) -> DataFrame:
        """The donor's rows added to the table."""
        rows = donor.read(name)
        return self.write(name, self.read(name).unionByName(rows) if self.exists(name) else rows)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, in as many files as there are partitions."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def markdown(df: DataFrame, limit: int = 200) -> str:
    """A Markdown table of a small report; the limit is the size of the page."""
    rows = df.limit(limit).collect()
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    return "\n".join(["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns), *["| " + " | ".join(map(cell, r)) + " |" for r in rows]])


def exists(spark, path: str) -> bool:
    """Whether a path exists, in whatever file system it names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at))


def plan_document(path: str, title: str, rows: DataFrame, limit: int = 1000) -> str:
    """A small report as JSON if the path ends in .json, else as Markdown (S13); the limit is the size of the document."""
    if path.endswith(".json"):
        return json.dumps({"title": title, "rows": [r.asDict() for r in rows.limit(limit).collect()]}, default=str, indent=2, ensure_ascii=False)
    return f"# {title}\n\n{markdown(rows, limit)}\n"
