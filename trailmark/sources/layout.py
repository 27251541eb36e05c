"""Stored events and sessions: a partition a day, so that a range of days reads no others, and buckets by session, so that the two meet without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import shared_dir


def store(df: DataFrame, day: Column, bucket_col: str = "session_id", buckets: int = 16, name: str | None = None) -> DataFrame:
    """``df`` as a table of the catalog with a column ``day`` to partition by and ``buckets`` buckets by ``bucket_col``, sorted by it in each; read back.

    Rows are dealt by bucket before they are written, so a day has one file a bucket. Tables that are to meet need the same number of buckets.
    """
    spark, name = df.sparkSession, name or f"trailmark_{uuid.uuid4().hex}"
    dealt = df.withColumn("day", day).repartition(buckets, bucket_col)
    writer = dealt.write.mode("overwrite").partitionBy("day").bucketBy(buckets, bucket_col).sortBy(bucket_col)
    writer.option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def days(table: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of the days from ``first`` to ``last``: a filter on the partitions."""
    return table.filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
