"""Writers with the rollups' semantics: overwrite by day, upserts, and the keys an overwrite removes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite_days(df: DataFrame, path: str, day: str = "summary_date") -> None:
    """Replaces the days that ``df`` holds and leaves all others, also those it computed nothing for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def insert_new(new: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` to append: the first of each key, and none whose key is stored."""
    return new.dropDuplicates([key]).join(stored.select(key), key, "left_anti")


def coalesce_upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New values replace old ones, except that a null keeps what was there."""
    values = [c for c in old.columns if c not in keys]
    renamed = new.withColumnsRenamed({c: f"__{c}" for c in values})
    return old.join(renamed, keys, "full_outer").select(*keys, *[F.coalesce(f"__{c}", c).alias(c) for c in values])


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace old rows of the same keys."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def stale_keys(stored: DataFrame, computed: DataFrame, day: str, keys: list[str]) -> DataFrame:
    """Stored keys to delete: those of a day that computed at least one key, but not this one."""
    days = computed.select(day).distinct()
    return stored.select(day, *keys).distinct().join(days, day, "left_semi").join(computed.select(day, *keys).distinct(), [day, *keys], "left_anti")


def report(df: DataFrame, path: str, kind: str = "csv") -> None:
    df.write.mode("overwrite").option("header", True).format(kind).save(path)


def updated(stored: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows of ``stored`` with the columns of ``changes`` put in where the key is in it; all other rows and columns stay."""
    columns = [c for c in changes.columns if c != key]
    renamed = changes.withColumnsRenamed({c: f"__{c}" for c in columns}).withColumn("__there", F.lit(True))
    joined = stored.join(renamed, key, "left")
    return joined.select(*[F.when(F.col("__there"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in stored.columns])


def deleted_if_unchanged(stored: DataFrame, seen: DataFrame, key: str, version: str) -> DataFrame:
    """``stored`` without the rows of ``seen``, except those that have changed since (another ``version`` under the same key)."""
    return stored.join(seen.select(key, version), [key, version], "left_anti").select(stored.columns)
