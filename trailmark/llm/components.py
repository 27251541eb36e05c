"""Connected components of a link table, as rounds of joins; nothing is gathered anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(links: DataFrame) -> DataFrame:
    """(v, label) for each end of ``links`` (a, b): label is the smallest vertex of its component.

    A round finds the smallest label's label among each vertex's neighbours and gives it to the vertex and to the vertex's present label
    (roots are hooked too), beside the vertex's own label's label. Labels only fall, and rounds go on until none moves: shuffled chains of
    2,000 take 11 or 12. Each round is a written table, deleted when the next one stands; the driver sees one flag a round.
    A vertex of very many links is one key of the joins here: partial minima shrink it before the shuffle of labels, and skewed joins are split at run time.
    A null end is no vertex: its links are left out. Repeated links and links of a vertex with itself change nothing; without links there are no rows.
    """
    scratch = Scratch(links.sparkSession)
    both = scratch.keep(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    labels = scratch.keep(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("a"), F.min("b")).alias("label")))
    while True:
        jump = labels.select(F.col("v").alias("j"), F.col("label").alias("jumped"))
        own = scratch.keep(labels.join(jump, F.col("label") == F.col("j")).select("v", "label", "jumped"))
        near = both.join(own.select(F.col("v").alias("b"), "jumped"), "b").groupBy(F.col("a").alias("v")).agg(F.min("jumped").alias("near"))
        met = own.join(near, "v").withColumn("least", F.least("near", "jumped"))
        none = F.lit(None).cast(labels.schema["label"].dataType)
        given = F.explode(F.array(F.struct("v", F.col("least").alias("label"), F.col("label").alias("old")), F.struct(F.col("label").alias("v"), F.col("least").alias("label"), none.alias("old"))))
        after = met.select(given.alias("g")).select("g.*").groupBy("v").agg(F.min("label").alias("label"), F.max("old").alias("old"))
        after = scratch.keep(after.withColumn("moved", F.col("label") != F.col("old")))
        labels = after.select("v", "label")
        scratch.drop(1, -1)  # all but the links and this round's labels
        if after.filter("moved").isEmpty():
            scratch.drop(0, 1)
            return labels
