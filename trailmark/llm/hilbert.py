"""Sharding along a Hilbert curve over quantised metadata, so that files can be pruned by several columns at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, numbered, running_start


def hilbert_index(coordinates: list[Column], bits: int) -> Column:
    """Place on the Hilbert curve of a cell with ``bits`` bits a coordinate (Skilling's transform, as one fold)."""
    n = len(coordinates)
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def undo(x: Column, step: Column) -> Column:
        q, i = step["q"], step["i"]
        first, own = F.get(x, F.lit(0)), F.get(x, i)
        inverted = own.bitwiseAND(q) > 0
        swapped = first.bitwiseXOR(own).bitwiseAND(q - 1)

        def one(v: Column, j: Column) -> Column:
            return (
                F.when(inverted & (j == 0), v.bitwiseXOR(q - 1)).when(~inverted & ((j == 0) != (j == i)), v.bitwiseXOR(swapped)).otherwise(v)
            )

        return F.transform(x, one)

    x = F.aggregate(steps, F.array(*[c.cast("int") for c in coordinates]), undo)
    gray = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.aggregate(F.slice(x, 1, j + 1), F.lit(0), lambda a, v: a.bitwiseXOR(v)))
    last = F.element_at(gray, n)
    flip = reduce(Column.bitwiseXOR, [F.when(last.bitwiseAND(F.lit(1 << b)) > 0, (1 << b) - 1).otherwise(0) for b in range(bits - 1, 0, -1)], F.lit(0))
    flipped = F.transform(F.zip_with(gray, F.array_repeat(flip, n), lambda g, f: g.bitwiseXOR(f)), lambda v: v.cast("long"))
    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(j).alias("j")) for b in range(bits - 1, -1, -1) for j in range(n)])
    return F.aggregate(
        places, F.lit(0).cast("long"), lambda a, p: a * 2 + F.when(F.get(flipped, p["j"]).bitwiseAND(F.pow(F.lit(2), p["b"]).cast("long")) > 0, 1).otherwise(0)
    )


def _not_above(value: Column):
    return lambda cut: cut <= value


def cuts(values: DataFrame, bits: int) -> list[tuple]:
    """Each of ``2 ** bits`` equal shares of all rows that has values of its own, with its smallest value: (value, __n) in, at most ``2 ** bits`` pairs out.

    Counts of distinct values are added up along their order by ranges of it, so that no task holds them all. A value goes to the share in which the
    first of its rows falls, whatever their number.
    """
    placed = running_start(values, ["value"], "__n", "__start")
    total = placed.agg(F.sum("__n")).first()[0] or 1
    share = F.expr(f"cast((__start * {1 << bits}L) div {total}L as int)")
    return [(r.low, r.share) for r in placed.groupBy(share.alias("share")).agg(F.min("value").alias("low")).orderBy("low").collect()]


def quantised(df: DataFrame, dims: dict[str, Column], bits: int) -> DataFrame:
    """Adds ``__cell``: the quantised dimensions packed into one number. Nulls share the lowest place with the smallest values.

    Cuts are exact: whole values are ranked, strings too, so that values with a long common beginning stay apart.
    """
    coded = checkpointed(df.withColumns({f"__d{i}": c for i, c in enumerate(dims.values())}))
    cell = F.lit(0)
    for i in range(len(dims)):
        value = F.col(f"__d{i}")
        found = cuts(coded.filter(value.isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("__n")), bits)
        kind = coded.schema[f"__d{i}"].dataType
        lows = F.array(*[F.lit(v).cast(kind) for v, _ in found]) if found else F.array().cast(T.ArrayType(kind))
        shares = F.array(*[F.lit(share) for _, share in found]) if found else F.array(F.lit(0))
        cell = cell * (1 << bits) + F.get(shares, F.greatest(F.size(F.filter(lows, _not_above(value))) - 1, F.lit(0)))
    return coded.withColumn("__cell", cell).drop(*[f"__d{i}" for i in range(len(dims))])


def hilbert_shards(df: DataFrame, dims: dict[str, Column], shards: int, tie: list[str], bits: int = 5) -> DataFrame:
    """``df`` plus ``curve`` (Hilbert index), ``shard`` and ``slot``: rows in the order of the curve, cut into equal runs.

    ``dims`` are columns of any ordered type, by name; rows of equal cells are ordered by ``tie``, nulls first (rows equal in it are
    interchangeable). Shard counts differ by one row at most, slots run from 0 in each shard. Rows are numbered by one sort over
    ranges of (curve, tie), so a cell that holds a third of all rows is cut by ``tie``. An empty table gives no rows.
    """
    names = df.columns
    rows = quantised(df, dims, bits)
    where = [F.shiftright(F.col("__cell"), bits * (len(dims) - 1 - i)).bitwiseAND(F.lit((1 << bits) - 1)) for i in range(len(dims))]
    cells = checkpointed(rows.select("__cell").distinct().withColumn("__curve", hilbert_index(where, bits)))  # at most 2 ** (bits * dimensions) rows
    total = rows.count()
    placed = numbered(rows.join(F.broadcast(cells), "__cell").withColumnRenamed("__curve", "curve"), ["curve", *tie], "__at")
    placed = placed.withColumn("shard", F.expr(f"cast((__at * {shards}L) div {max(total, 1)}L as int)"))
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("slot", F.col("__at") - first).select(*names, "curve", "shard", "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Writes each shard as one directory, its rows in slot order; readers prune files by the dimensions' statistics."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
