"""Table access for a directory of parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table ``name`` of the directory ``root`` (a file or a folder of part files)."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """Partitions for stages that run Python: enough for every core, more on large clusters."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
