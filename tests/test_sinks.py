"""Writers: days that were computed replace stored ones, all others stay; upserts and updates by key; reports."""

from __future__ import annotations

from trailmark.operators import sinks


def test_overwrite_days_leaves_other_days(spark, tmp_path):
    rows = lambda xs: spark.createDataFrame(xs, "summary_date string, key string, n int")
    sinks.overwrite_days(rows([("d1", "a", 1), ("d1", "b", 2), ("d2", "a", 3)]), f"{tmp_path}/t")
    sinks.overwrite_days(rows([("d1", "c", 9)]), f"{tmp_path}/t")
    sinks.overwrite_days(rows([]), f"{tmp_path}/t")  # an empty computation deletes nothing
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/t").select("summary_date", "key", "n").collect())) == [("d1", "c", 9), ("d2", "a", 3)]


def test_keyed_writes(spark):
    table = lambda xs: spark.createDataFrame(xs, "k string, a int, v int")
    old, new = table([("x", 1, 1), ("y", 2, 1)]), table([("y", None, 2), ("z", 3, 1), ("z", 3, 1)])
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(sinks.insert_new(new, old, "k")) == [("z", 3, 1)]
    assert rows(sinks.upsert(old, new.dropDuplicates(["k"]), ["k"])) == [("x", 1, 1), ("y", None, 2), ("z", 3, 1)]
    assert rows(sinks.coalesce_upsert(old, new.dropDuplicates(["k"]), ["k"])) == [("x", 1, 1), ("y", 2, 2), ("z", 3, 1)]
    assert rows(sinks.updated(old, new.filter("k = 'y'").select("k", "a"), "k")) == [("x", 1, 1), ("y", None, 1)]
    assert rows(sinks.deleted_if_unchanged(old, table([("x", 0, 1), ("y", 0, 7)]), "k", "v")) == [("y", 2, 1)]


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    sinks.report(df, f"{tmp_path}/csv")
    sinks.report(df, f"{tmp_path}/json", "json")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 2 and spark.read.json(f"{tmp_path}/json").count() == 2
