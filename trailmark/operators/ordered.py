"""Places and running totals over one order of many rows: rows are dealt over tasks by ranges of that order, so that no task holds a whole group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources import scratch


def running(rows: DataFrame, keys: list[str], order: list[str], amounts: dict[str, Column]) -> DataFrame:
    """Adds, for each name of ``amounts`` (whole numbers), its total over the rows of the same ``keys`` up to and with this one in ``order``, and ``<name>_all``, over all of them.

    Rows are dealt by ranges of (keys, order) and written with the number of their piece; a piece's total is known from one row a piece and key, and each
    row adds the pieces before its own to what stands before it in its own. Null keys are a group. ``order`` should tell the rows of a key apart:
    rows that are equal in it get their places in any order, and all of them lie in one piece.
    """
    dealt = rows.withColumns({f"__of_{n}": F.coalesce(a.cast("long"), F.lit(0)) for n, a in amounts.items()}).repartitionByRange(*keys, *order)
    placed = scratch.written(dealt.withColumn("__piece", F.spark_partition_id()))
    pieces = placed.groupBy(*keys, "__piece").agg(*[F.sum(f"__of_{n}").alias(n) for n in amounts])
    group = Window.partitionBy(*keys)  # over a row per piece
    before = group.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    held = pieces.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__piece").alias("__at"),
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__before_{n}") for n in amounts], *[F.sum(n).over(group).alias(f"{n}_all") for n in amounts],
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], F.col("__piece") == F.col("__at"))
    upto = Window.partitionBy(*keys, "__piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    both = placed.join(held, same)
    return both.select(*rows.columns, *[(F.col(f"__before_{n}") + F.sum(f"__of_{n}").over(upto)).alias(n) for n in amounts], *[f"{n}_all" for n in amounts])


def numbered(rows: DataFrame, order: list[str], name: str = "place") -> DataFrame:
    """Adds each row's place (from 1, without gaps) in one order over all rows; ``order`` has to tell rows apart for the same places in every run."""
    return running(rows, [], order, {name: F.lit(1)}).drop(f"{name}_all")
