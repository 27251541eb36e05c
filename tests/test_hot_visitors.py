"""Visitors of many rows are cut by hours and segments: same sessions and ids as through windows, and ids that older days leave alone."""

from __future__ import annotations

import random

import pytest
from test_sessions import frame, loop, row

from trailmark.operators import sessions as ss


def drawn(seed, visitors=6, most=400):
    draw, rows, i = random.Random(seed), [], 0
    for v in range(visitors):
        at = 0.0
        for _ in range(most if v == 0 else draw.randint(1, 40)):
            at += draw.choice([0, 0, 0.2, 5, 14, 16, 25, 29, 31, 45, 200])
            i += 1
            name = draw.choice(["page_viewed", "click", "product_added_to_cart", "product_added_to_cart"])
            rows.append(row(i, f"v{v}", at, name, draw.choice(["A", "a", "b", None]) if name == "product_added_to_cart" else None))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_hot_visitors_get_the_sessions_of_the_loop(spark, seed):
    rows = drawn(seed)
    made = {h: {r.event_id: (r.session_no, r.counts, r.session_id) for r in ss.with_sessions(frame(spark, rows), hot_rows=h).collect()} for h in (10, 10**6)}
    assert made[10] == made[10**6] and {e: x[:2] for e, x in made[10].items()} == loop(rows)
    gaps = [{(r.event_id, r.session_no, r.session_id) for r in ss.with_gaps(frame(spark, rows), hot_rows=h).collect()} for h in (10, 10**6)]
    assert gaps[0] == gaps[1]


def test_an_older_day_changes_no_later_id(spark):
    rows = drawn(7, most=60)
    older = [row(10_000 + k, f"v{k % 6}", -5000 - k) for k in range(30)]
    ids = lambda rows, **how: {r.event_id: r.session_id for r in ss.with_sessions(frame(spark, rows), **how).collect()}
    before = ids(rows)
    for how in ({}, {"hot_rows": 10}):
        after = ids(rows + older, **how)
        assert {e: after[e] for e in before} == before and len(after) == len(rows) + 30


def test_rows_without_repeated_adds_enter_no_python(spark):
    out = ss.with_sessions(frame(spark, drawn(3)))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "__again" in next(x for x in plan.split("MapInArrow")[1].splitlines() if "Filter" in x)
    assert "MapInArrow" not in ss.with_gaps(frame(spark, drawn(3)))._jdf.queryExecution().optimizedPlan().toString()


def test_a_hot_visitor_is_spread_over_tasks(spark):
    rows = [row(i, "bot", i * 7) for i in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # else so few rows are broadcast to one task
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = ss.with_sessions(frame(spark, rows), hot_rows=100)
        sizes = [n for n in out.rdd.glom().map(len).collect() if n]
        assert len(sizes) >= 12 and max(sizes) < 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
