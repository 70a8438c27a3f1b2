"""Nested JSON page snapshots, one object per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import SNAPSHOT


def read_snapshots(spark: SparkSession, folder: str, multiline: bool = True) -> DataFrame:
    """One row per snapshot: one object per file, or one per line. The fixed schema saves an inference pass."""
    return (
        spark.read.schema(SNAPSHOT).option("multiLine", multiline).json(folder)
        .withColumn("taken_at", F.try_to_timestamp("timestamp", F.lit("yyyyMMdd_HHmmss")))
    )


def snapshot_metrics(snapshots: DataFrame) -> DataFrame:
    return snapshots.select("taken_at", "company_metrics.*", F.col("total_posts").alias("posts_on_page"))


def snapshot_posts(snapshots: DataFrame) -> DataFrame:
    """One row per post and snapshot."""
    return snapshots.select("taken_at", F.explode("posts").alias("post")).select("taken_at", "post.*")
