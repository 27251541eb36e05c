"""Rollups kept up to date: a run takes the watermark, recomputes the days that may have changed, replaces them, and moves the watermark last."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import remove, shared_dir
from .rollups import DAY

#: How far before the watermark a run looks, how far back a first run does, and the most days of a run.
OVERLAP_S, FIRST_RUN_S, MOST_DAYS = 3600, 21_600, 31


class Watermarks:
    """Times by name, in a table that only grows: the newest row of a name is its watermark, so a run that ends midway leaves the one before."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _rows(self) -> DataFrame | None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        there = folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)
        return self.spark.read.schema("name string, at timestamp_ntz, number long").parquet(self.path) if there else None

    def get(self, name: str) -> datetime.datetime | None:
        rows = self._rows()
        return rows and rows.filter(F.col("name") == name).agg(F.max_by("at", "number")).first()[0]

    def put(self, name: str, at: datetime.datetime) -> None:
        rows = self._rows()
        number = ((rows.agg(F.max("number")).first()[0] or 0) if rows else 0) + 1
        self.spark.createDataFrame([(name, at, number)], "name string, at timestamp_ntz, number long").coalesce(1).write.mode("append").parquet(self.path)


def days_to_recompute(events: DataFrame, mark: datetime.datetime | None, now: datetime.datetime, overlap_s: int = OVERLAP_S, first_run_s: int = FIRST_RUN_S, most_days: int = MOST_DAYS) -> list[datetime.date]:
    """The days from the watermark (less the overlap) to ``now``, and any earlier ones of rows received since then; none before the last ``most_days``."""
    since = mark - datetime.timedelta(seconds=overlap_s) if mark else now - datetime.timedelta(seconds=first_run_s)
    earliest = (now - datetime.timedelta(days=most_days)).date()
    first = max(since.date(), earliest)
    found = {first + datetime.timedelta(days=k) for k in range((now.date() - first).days + 1)}
    late = events.filter(F.col("received_at") >= F.lit(since)).select(F.to_date("occurred_at").alias("day")).distinct().filter(F.col("day").between(earliest, now.date()))
    return sorted(found | {r.day for r in late.collect()})  # at most ``most_days`` rows


def publish(table: DataFrame, path: str) -> None:
    """Replaces the days that ``table`` has rows of: keys that are not computed any more go with their day; a day without rows is left alone."""
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def run(
    events: DataFrame, base: str, now: datetime.datetime, stages: dict[str, Callable[[DataFrame], DataFrame]], name: str = "rollups", first_run_s: int = FIRST_RUN_S, most_days: int = MOST_DAYS
) -> tuple[list[datetime.date], list[str]]:
    """Runs all ``stages`` (rows of events in, a table by ``summary_date`` out) over the days that may have changed; gives these days and the stages that failed.

    Rows of these days are written once and read by every stage. A stage is written beside its table first and then replaces the table's days, one after the
    other stage: a failing one leaves its table as it was, and the others still run. The watermark moves to ``now`` only if none failed, so the next run
    repeats the window. Running twice over the same rows changes nothing.
    """
    spark, marks = events.sparkSession, Watermarks(events.sparkSession, f"{base}/watermarks")
    days = days_to_recompute(events, marks.get(name), now, first_run_s=first_run_s, most_days=most_days)
    source, staged, failed = f"{shared_dir(spark)}/source-{uuid.uuid4().hex}", f"{base}/staged-{uuid.uuid4().hex}", []
    own = F.to_date("occurred_at").isin(days)
    prune = F.col("day").isin(days) if "day" in events.columns else F.lit(True)
    try:
        events.filter(own & prune).write.parquet(source)
        rows = spark.read.schema(events.schema).parquet(source)
        for stage, compute in stages.items():
            try:
                made = compute(rows).filter(F.col(DAY).isin(days))
                made.write.mode("overwrite").parquet(f"{staged}/{stage}")
                publish(spark.read.schema(made.schema).parquet(f"{staged}/{stage}"), f"{base}/{stage}")
            except Exception:  # whatever a stage fails by, the others go on and the run is repeated
                failed.append(stage)
    finally:
        remove(spark, source)
        remove(spark, staged)
    if not failed:
        marks.put(name, now)
    return days, failed


class KeyedTable:
    """A table partitioned by a hash of its key: an upsert or an update reads and rewrites the partitions that its keys fall into and no others."""

    def __init__(self, path: str, key: str, parts: int = 64):
        self.path, self.key, self.parts = path, key, parts

    def _part(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")

    def read(self, spark: SparkSession) -> DataFrame | None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return spark.read.parquet(self.path) if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder) else None

    def _merge(self, rows: DataFrame, columns: list[str] | None, keep_null: bool, insert: bool) -> None:
        spark = rows.sparkSession
        new = rows.dropDuplicates([self.key]).withColumn("part", self._part())
        old = self.read(spark)
        if old is None:
            made = new if insert else new.limit(0)
        else:
            touched = [r.part for r in new.select("part").distinct().collect()]  # at most ``parts`` numbers
            old = old.filter(F.col("part").isin(touched))
            named = new.select(F.col(self.key).alias("__key"), *[F.col(c).alias(f"__new_{c}") for c in new.columns if c not in (self.key, "part")])
            met = old.join(named, old[self.key].eqNullSafe(named["__key"]), "full_outer" if insert else "left")
            own = [c for c in old.columns if c not in (self.key, "part")]
            taken = set(columns or own) & set(new.columns)
            there = F.col("__key").isNotNull()
            value = lambda c: F.coalesce(f"__new_{c}", c) if keep_null else F.when(there, F.col(f"__new_{c}")).otherwise(F.col(c))
            made = met.select(F.coalesce(self.key, "__key").alias(self.key), *[(value(c) if c in taken else F.col(c)).alias(c) for c in own]).withColumn("part", self._part())
        staged = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
        made.write.parquet(staged)  # what is replaced is also read
        try:
            back = spark.read.schema(made.schema).parquet(staged)
            back.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(self.path)
        finally:
            remove(spark, staged)

    def upsert(self, rows: DataFrame, keep_null: bool = False) -> None:
        """Rows by key: present ones are overwritten (with ``keep_null``, nulls keep the old value), others come in."""
        self._merge(rows, None, keep_null, insert=True)

    def update(self, rows: DataFrame, columns: list[str]) -> None:
        """Sets ``columns`` of the rows whose keys ``rows`` has; all other columns and rows stay, unknown keys are ignored."""
        self._merge(rows.select(self.key, *columns), columns, False, insert=False)
