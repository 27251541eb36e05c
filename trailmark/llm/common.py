"""What the operators of this subpackage share: reading tables, scratch tables, running sums, joins with hot keys, freeing memory."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session (one machine, as in tests) gets a folder of its own; a cluster gets an error, as a driver's
    local folder would not be seen by executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    set_before = context._jsc.sc().getCheckpointDir()
    if not set_before.isEmpty():
        return set_before.get()
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="trailmark-"))
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept in the shared checkpoint folder, so that losing executors loses nothing."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder through the file system its path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Tables in the shared folder for loops: unlike a checkpoint, a table read back keeps nothing of the plan, whose remembered
    constraints would double with each round. ``keep`` writes one; ``drop`` deletes those that later tables have replaced."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame) -> DataFrame:
        self.paths.append(f"{shared_dir(self.spark)}/round-{uuid.uuid4().hex}")
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def drop(self, first: int, last: int) -> None:
        """Deletes the tables kept from number ``first`` up to but not including ``last`` (counted as in a slice)."""
        for path in self.paths[first:last]:
            remove(self.spark, path)
        del self.paths[first:last]


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, read back."""
    return Scratch(df.sparkSession).keep(df)


def clear_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete shuffle files of steps that nothing refers to any more (their results are checkpointed), instead of at some later collection.

    Two rounds: the first lets go of the driver's Python handles, the second of what they held in the JVM.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; the built-in ``lower`` serves where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _runs(df: DataFrame, rows_per_run: int) -> int:
    rows = df.count()
    return max(1, -(-rows // rows_per_run), min(rows, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def running_start(df: DataFrame, order: list[str], amount: str, start: str, rows_per_run: int = 200_000) -> DataFrame:
    """Adds ``start``: the sum of ``amount`` over all rows before this one in ``order``.

    Rows are dealt into ordered runs (one range partition each), sums are taken inside runs, and only one total
    per run is added up in a single place. ``df`` should be narrow: it is checkpointed once.
    """
    dealt = checkpointed(df.repartitionByRange(_runs(df, rows_per_run), *order).withColumn("__run", F.spark_partition_id()))
    inside = Window.partitionBy("__run").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("__run").agg(F.sum(amount).alias("__total"))
    before = Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__run", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))
    return (
        dealt.withColumn("__inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .join(F.broadcast(totals), "__run")  # one row per range partition
        .withColumn(start, (F.col("__before") + F.col("__inside")).cast("long"))
        .drop("__run", "__inside", "__before")
    )


def numbered(df: DataFrame, order: list[str], number: str, rows_per_run: int = 200_000) -> DataFrame:
    """Adds ``number``: how many rows stand before this one in ``order``. One range shuffle and a sort in each range; a key that many rows
    share is cut by the later columns of ``order``. ``df`` should be narrow: it is checkpointed once."""
    dealt = df.repartitionByRange(_runs(df, rows_per_run), *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # partition in the upper bits, row of the partition in the lower 33
    dealt = checkpointed(dealt.withColumn("__place", place))
    run = F.shiftright("__place", 33).cast("int")
    totals = dealt.groupBy(run.alias("__run")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    placed = dealt.withColumn("__run", run).join(F.broadcast(totals), "__run")  # one row per range partition
    return placed.withColumn(number, F.col("__before") + F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))).drop("__run", "__place", "__before")


def joined_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, least: int = 10_000) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row a binary ``key``, ``size`` its number of rows) that no large group can hold up.

    A group is hot above ``least`` rows and above one in 100,000 of all rows, so there are at most 100,000 hot groups: these are broadcast, and
    their rows are dealt at random instead of by key. All others meet by a shuffle.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    bound = max(least, total // 100_000)
    values = [c for c in groups.columns if c != key]
    hot = groups.filter(F.col(size) > bound).select(F.col(key).alias("__hot"), *[F.col(c).alias(f"__hot_{c}") for c in values])
    cold = groups.filter(F.col(size) <= bound).select(F.col(key).alias("__key"), *values)
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")  # at most 100,000 rows
    stray = F.concat(F.lit(b"hot"), F.col(key), F.rand(1).cast("string").cast("binary"))
    dealt = F.when(F.col("__hot").isNull(), F.col(key)).otherwise(stray)
    met = marked.withColumn("__dealt", dealt).join(cold, F.col("__dealt") == F.col("__key"), "left")
    both = [F.when(F.col("__hot").isNull(), F.col(c)).otherwise(F.col(f"__hot_{c}")).alias(c) for c in values]
    return met.filter("__hot is not null or __key is not null").select(*rows.columns, *both)


def release() -> None:
    """In a Python worker at the end of a task: gives freed memory back to the system, as workers live on and serve later stages."""
    import ctypes

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it gives memory back in its own time
