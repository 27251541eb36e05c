"""Rollup runs from a watermark, stored days and buckets, and keyed writes: what is recomputed, what is read, and what stays."""

from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

from trailmark.operators import incremental
from trailmark.operators import rollups as ru
from trailmark.sources import layout

EVENT = "event_id string, event_name string, url string, actor_id string, session_id string, scroll_percent double, click_bucket string, occurred_at timestamp_ntz, received_at timestamp_ntz"
BEGIN = datetime.datetime(2024, 1, 1)


def events(spark, rows):
    """(id, page, day, hours until it is received)"""
    made = []
    for i, page, day, later in rows:
        at = BEGIN + datetime.timedelta(days=day, hours=1)
        made.append((f"e{i}", "page_viewed", f"/{page}", "a", f"s{i}", None, None, at, at + datetime.timedelta(hours=later)))
    return spark.createDataFrame(made, EVENT)


def pages(spark, base):
    return {(str(r.summary_date), r.page_path): r.page_views for r in spark.read.parquet(f"{base}/pages").collect()}


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_failing_stage_keeps_the_watermark_and_is_repeated(spark, tmp_path):
    base, now = str(tmp_path / "r"), BEGIN + datetime.timedelta(days=2, hours=12)
    rows = events(spark, [(1, "x", 1, 0), (2, "y", 2, 0)])

    def broken(rows):
        raise RuntimeError("no")

    days, failed = incremental.run(rows, base, now, {"broken": broken, "pages": ru.page_behavior}, first_run_s=2 * 86_400)
    assert failed == ["broken"] and len(days) == 3
    assert pages(spark, base) == {("2024-01-02", "/x"): 1, ("2024-01-03", "/y"): 1}  # the others still ran
    marks = incremental.Watermarks(spark, f"{base}/watermarks")
    assert marks.get("rollups") is None
    again, failed = incremental.run(rows, base, now, {"broken": ru.page_behavior, "pages": ru.page_behavior}, first_run_s=2 * 86_400)
    assert again == days and not failed and marks.get("rollups") == now
    assert not [d for d in os.listdir(base) if d.startswith("staged")]


def test_late_rows_stale_keys_and_untouched_days(spark, tmp_path):
    base = str(tmp_path / "r")
    now = lambda d, h=12: BEGIN + datetime.timedelta(days=d, hours=h)
    first = [(1, "x", 0, 0), (2, "y", 1, 0), (3, "z", 3, 0)]
    incremental.run(events(spark, first), base, now(3), {"pages": ru.page_behavior}, first_run_s=10 * 86_400)
    before = files(f"{base}/pages")
    late = [(2, "w", 1, 0), (4, "x", 1, 3 * 24), *first[::2]]  # event 2 has moved to another page; event 4 comes three days late
    days, failed = incremental.run(events(spark, late), base, now(4, 6), {"pages": ru.page_behavior})
    assert not failed and days == [datetime.date(2024, 1, 2), datetime.date(2024, 1, 4), datetime.date(2024, 1, 5)]
    assert pages(spark, base) == {("2024-01-01", "/x"): 1, ("2024-01-02", "/w"): 1, ("2024-01-02", "/x"): 1, ("2024-01-04", "/z"): 1}
    after = files(f"{base}/pages")
    assert {f: t for f, t in before.items() if "2024-01-01" in f} == {f: t for f, t in after.items() if "2024-01-01" in f}
    again = incremental.run(events(spark, late), base, now(4, 6), {"pages": ru.page_behavior})
    assert again[0] == days[2:] and pages(spark, base)["2024-01-02", "/w"] == 1
    gone = [r for r in late if r[2] != 3]  # all rows of a recomputed day vanish: a day without rows is left alone
    again = incremental.run(events(spark, gone), base, now(4, 7), {"pages": ru.page_behavior}, name="all over", first_run_s=10 * 86_400)
    assert datetime.date(2024, 1, 4) in again[0]
    assert pages(spark, base)["2024-01-04", "/z"] == 1


def test_a_run_goes_no_further_back_than_its_most_days(spark):
    rows = events(spark, [(1, "x", 0, 40 * 24), (2, "y", 39, 0)])
    now = BEGIN + datetime.timedelta(days=40, hours=2)
    got = incremental.days_to_recompute(rows, now - datetime.timedelta(hours=2), now)
    assert got == [datetime.date(2024, 2, 9), datetime.date(2024, 2, 10)]


def test_stored_days_are_pruned_and_meet_sessions_without_a_shuffle(spark):
    rows = events(spark, [(i, "x", i % 9, 0) for i in range(200)]).withColumn("user_agent", F.lit("iPhone"))
    facts = {"status": "'scored'", "session_time_spent_ms": "9000L", "click_count": "1L", "scroll_count": "1L", "add_to_cart_count": "0L", "checkout_started_count": "0L", "bucket": "'low'"}
    sessions = rows.select("session_id", "occurred_at").withColumns({k: F.expr(v) for k, v in facts.items()})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        e = layout.store(rows, F.to_date("occurred_at"), buckets=4)
        s = layout.store(sessions, F.to_date("occurred_at"), buckets=4).drop("day", "occurred_at")
        out = ru.heatmap(layout.days(e, "2024-01-03", "2024-01-04"), s)
        got = {str(r.summary_date): r.page_views for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {"2024-01-03": sum(i % 9 == 2 for i in range(200)), "2024-01-04": sum(i % 9 == 3 for i in range(200))}
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "PartitionFilters: [isnotnull(day" in final and "SortMergeJoin" in final or "ShuffledHashJoin" in final
    assert "hashpartitioning(session_id" not in final and "hashpartitioning(s_id" not in final
    assert "ReadSchema" in final and "scroll_percent" not in final.split("ReadSchema")[1].split("\n")[0]


@pytest.fixture
def keyed(spark, tmp_path):
    table = incremental.KeyedTable(f"{tmp_path}/keyed", "k", parts=16)
    table.upsert(spark.createDataFrame([(f"k{i}", i, f"v{i}", 1.0) for i in range(100)], "k string, n int, v string, x double"))
    return table


def test_keyed_writes_touch_the_partitions_of_their_keys(spark, keyed):
    before = files(keyed.path)
    keyed.upsert(spark.createDataFrame([("k1", -1, None, 2.0), ("new", 7, "w", 3.0)], "k string, n int, v string, x double"))
    rows = {r.k: (r.n, r.v, r.x) for r in keyed.read(spark).collect()}
    assert rows["k1"] == (-1, None, 2.0) and rows["new"] == (7, "w", 3.0) and len(rows) == 101 and rows["k2"] == (2, "v2", 1.0)
    changed = {f.split("part=")[1].split("/")[0] for f, t in files(keyed.path).items() if before.get(f) != t}
    assert 1 <= len(changed) <= 2


def test_updates_leave_other_columns_and_reruns_change_nothing(spark, keyed):
    change = spark.createDataFrame([("k1", "new", 5.0), ("k3", None, 6.0), ("unknown", "y", 7.0)], "k string, v string, x double")
    for _ in range(2):
        keyed.update(change, ["v", "x"])
        rows = {r.k: (r.n, r.v, r.x) for r in keyed.read(spark).collect()}
        assert rows["k1"] == (1, "new", 5.0) and rows["k3"] == (3, None, 6.0) and len(rows) == 100
    keyed.upsert(spark.createDataFrame([("k3", 9, None, None)], "k string, n int, v string, x double"), keep_null=True)
    assert {r.k: (r.n, r.v, r.x) for r in keyed.read(spark).collect()}["k3"] == (9, None, 6.0)
