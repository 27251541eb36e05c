"""Mixing sources to target weights by entropy balancing: Newton steps on the convex dual, then copies."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, checkpointed

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sources: DataFrame, cycle: int = 3, most: int = 3) -> DataFrame:
    """Adds ``target`` to (source, source_size): all sizes shared by weight, no source above ``most`` times its size.

    Sources in code point order, null last, weigh 1 to ``cycle``, repeating. Weight w gets level * w where that is
    below the source's bound, else the bound; the level comes from one ordered pass over the sources' bound-to-weight ratios.
    There is one row per source here, never one per document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn("__w", (F.row_number().over(by_name) - 1) % cycle + 1).withColumn("__bound", most * F.col("source_size"))
    everything = Window.partitionBy()
    ratio = F.col("__bound") / F.col("__w")
    upto = Window.orderBy("__ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    held = weighed.withColumn("__ratio", ratio).withColumns(
        {"__bound_before": F.coalesce(F.sum("__bound").over(upto), F.lit(0)), "__w_before": F.coalesce(F.sum("__w").over(upto), F.lit(0)), "__all": F.sum("source_size").over(everything), "__all_w": F.sum("__w").over(everything)}
    )
    # the level if exactly the sources before this one are at their bound; right at the first one with room for it
    level = (F.col("__all") - F.col("__bound_before")) / (F.col("__all_w") - F.col("__w_before"))
    held = held.withColumn("__level", F.min(F.when(level <= F.col("__ratio"), F.struct("__ratio", level.alias("v")))).over(everything)["v"])
    target = F.when(F.col("__level").isNull() | (F.col("__level") * F.col("__w") > F.col("__bound")), F.col("__bound").cast("double")).otherwise(F.col("__level") * F.col("__w"))
    return held.select("source", "source_size", target.cast("double").alias("target"))


def tilts(cells: DataFrame, targets: DataFrame, most: int = 3, rounds: int = 60, tolerance: float = 1e-9) -> DataFrame:
    """(source, tilt): the dual solution; a document of relative size c is taken ``most * sigmoid(logit(1/most) + tilt * c)`` times.

    These rates are nearest to 1 in relative entropy (within 0 and ``most``) of all that meet each source's target. One Newton step
    for all sources is one distributed sum over the (source, size) counts, kept inside a bracket that halves when a step
    leaves it. The driver sees one number a round: the largest relative miss; if it is above ``tolerance`` after ``rounds``, an error is raised. A source at its bound gets a null tilt. Tilts are rounded, so
    that the order in which partitions were summed leaves no trace.
    """
    base = math.log(1 / (most - 1)) if most > 1 else 0.0
    scale = F.col("source_size") / F.col("source_docs")
    goals = targets.join(cells.groupBy("source").agg(F.sum("docs").alias("source_docs")).withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    goals = goals.withColumn("scale", F.greatest(scale, F.lit(1e-9))).withColumn("open", (F.col("target") < most * F.col("source_size") * (1 - 1e-12)) & (F.col("source_size") > 0))
    scratch = Scratch(cells.sparkSession)
    state = scratch.keep(goals.select(F.col("source").alias("__s"), "target", "scale", "open", F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi")))
    for _ in range(rounds):
        c = F.col("size") / F.col("scale")
        rate = most / (1 + F.exp(-(base + F.col("tilt") * c)))
        met = cells.join(state.filter("open"), F.col("source").eqNullSafe(F.col("__s"))).groupBy("__s").agg(
            F.sum(F.col("docs") * F.col("size") * rate).alias("got"), F.sum(F.col("docs") * F.col("size") * c * rate * (1 - rate / most)).alias("slope")
        )
        joined = state.join(met.withColumnRenamed("__s", "__m"), F.col("__s").eqNullSafe(F.col("__m")), "left").drop("__m")
        miss = F.col("got") - F.col("target")
        lo, hi = F.when(miss <= 0, F.col("tilt")).otherwise(F.col("lo")), F.when(miss >= 0, F.col("tilt")).otherwise(F.col("hi"))
        newton = F.col("tilt") - F.try_divide(miss, F.col("slope"))
        inside = newton.isNotNull() & ~F.isnan(newton) & (F.col("nlo").isNull() | (newton > F.col("nlo"))) & (F.col("nhi").isNull() | (newton < F.col("nhi"))) & (F.abs(newton - F.col("tilt")) <= 4 + 2 * F.abs(F.col("tilt")))
        wide = 2 + 2 * F.abs(F.col("tilt"))
        halved = F.when(F.col("nlo").isNull(), F.col("tilt") - wide).when(F.col("nhi").isNull(), F.col("tilt") + wide).otherwise((F.col("nlo") + F.col("nhi")) / 2)
        step = joined.withColumns({"nlo": lo, "nhi": hi, "off": F.coalesce(F.abs(miss) / F.greatest(F.col("target"), F.lit(1.0)), F.lit(0.0))})
        step = step.withColumn("next", F.when(~F.col("open") | (F.col("off") <= tolerance), F.col("tilt")).when(inside, newton).otherwise(halved))
        state = scratch.keep(step.select("__s", "target", "scale", "open", F.col("next").alias("tilt"), F.col("nlo").alias("lo"), F.col("nhi").alias("hi"), "off"))
        scratch.drop(0, -1)
        if (state.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
    else:
        raise RuntimeError(f"a source misses its target by more than {tolerance} of it after {rounds} rounds")
    return state.select("__s", "target", "scale", F.when(F.col("open"), F.round("tilt", 9)).alias("tilt"))


def balanced_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cycle: int = 3, most: int = 3, docs_per_cell: int = 50_000) -> DataFrame:
    """One row per document: id, ``source``, ``size`` (words), ``source_size``, ``target``, ``rate``, ``copies``, ``taken`` (size * copies).

    The rate depends on source and size only, so documents are counted by (source, size) first (cells with more than
    ``docs_per_cell`` are split by a hash of the id), rates are summed along sizes from the largest down, and each cell gets
    the whole copies between two rounded running sums: the miss of a source is below half its largest document. Then what is
    missing or over is given to or taken from cells, smallest first, as whole copies. A hash of the id picks the documents of a cell
    that get one more. Nothing is random: reruns agree.

    Null or empty text: size 0, taken 0. Null sources form one source, last in order. Rows that repeat an id are counted one by
    one. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
    rows = checkpointed(rows)
    counts = checkpointed(rows.groupBy("source", "size").agg(F.count("*").alias("docs")))
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    targets = checkpointed(source_targets(sizes, cycle, most))
    tilted = tilts(counts, targets, most)
    base = math.log(1 / (most - 1)) if most > 1 else 0.0
    rate = F.when(F.col("tilt").isNull(), F.lit(float(most))).otherwise(most / (1 + F.exp(-(base + F.col("tilt") * F.col("size") / F.col("scale")))))
    rated = counts.join(tilted.drop("target"), F.col("source").eqNullSafe(F.col("__s"))).select("source", "size", "docs", rate.alias("rate"), F.ceil(F.col("docs") / docs_per_cell).cast("int").alias("parts"))
    rated = rated.join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    down = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = rated.withColumn("__upto", F.sum(F.col("docs") * F.col("rate")).over(down))
    got = F.floor(F.col("__upto") + 0.5) - F.floor(F.col("__upto") - F.col("docs") * F.col("rate") + 0.5)
    summed = summed.withColumn("k", F.least(F.greatest(got, F.lit(0)), most * F.col("docs")))
    whole = Window.partitionBy("source")
    summed = summed.withColumn("__left", F.col("target") - F.sum(F.col("k") * F.col("size")).over(whole))
    room = F.when(F.col("size") == 0, 0).when(F.col("__left") >= 0, most * F.col("docs") - F.col("k")).otherwise(F.col("k"))
    up = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    summed = summed.withColumn("__room", F.least(room, F.col("docs"))).withColumn("__before", F.coalesce(F.sum(F.col("__room") * F.col("size")).over(up), F.lit(0)))
    moved = F.floor(F.try_divide(F.abs(F.col("__left")) - F.col("__before"), F.col("size")))
    moved = F.coalesce(F.least(F.greatest(moved, F.lit(0)), F.col("__room")), F.lit(0))
    cells = checkpointed(summed.withColumn("k", F.col("k") + F.when(F.col("__left") >= 0, moved).otherwise(-moved)).select("source", "size", "docs", "parts", "rate", "source_size", "target", "k"))
    # a document's rank inside its cell: the cell's parts one after another
    cell = F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z"))
    named = cells.withColumnsRenamed({"source": "__s", "size": "__z"})
    dealt = rows.join(named, cell).withColumn("__part", F.pmod(F.xxhash64("__id"), F.col("parts")))
    keys = [F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull(), F.col("size"), F.col("__part")]
    dealt = dealt.withColumns({"__k0": keys[0], "__k1": keys[1]})
    parts = dealt.groupBy("__k0", "__k1", "size", "__part").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy("__k0", "__k1", "size").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__k0", "__k1", "size", "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__earlier"))
    inside = Window.partitionBy("__k0", "__k1", "size", "__part").orderBy(F.xxhash64("__id"), "__id")
    ranked = dealt.withColumn("__rank", F.row_number().over(inside) - 1).join(parts, ["__k0", "__k1", "size", "__part"])
    each, more = F.floor(F.col("k") / F.col("docs")), F.col("k") % F.col("docs")
    copies = (each + F.when(F.col("__earlier") + F.col("__rank") < more, 1).otherwise(0)).cast("long")
    return ranked.select(F.col("__id").alias(id_col), "source", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
