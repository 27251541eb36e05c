"""The session fold against a plain loop over the rule, boundary cases, sweeps and neighbours."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from trailmark.operators import sessions as ss

ROWS = "identity string, actor_id string, client_id string, event_id string, seq long, event_name string, product_id string, url string, click_bucket string, occurred_at timestamp_ntz, received_at timestamp_ntz"
BEGIN = datetime.datetime(2024, 1, 1)


def row(i, visitor, minutes, name="page_viewed", product=None):
    at = BEGIN + datetime.timedelta(minutes=minutes)
    return (visitor, visitor, None, f"e{i}", i, name, product, None, None, at, at)


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS).drop("identity")


def loop(rows, timeout_m=30):
    """{event: (session number, whether it counts)} by the rule."""
    out, state = {}, {}
    for visitor, *_, in sorted({(r[0],) for r in rows}):
        number, last, claimed = 0, None, set()
        for r in sorted((r for r in rows if r[0] == visitor), key=lambda r: (r[9], r[10], r[5] == "click", r[4])):
            fresh = last is None or r[9] - last > datetime.timedelta(minutes=timeout_m)
            product = r[6].lower() if r[5] == "product_added_to_cart" and r[6] is not None else None
            again = product is not None and not fresh and product in claimed
            if not again:
                if fresh:
                    number, claimed = number + 1, set()
                if product is not None:
                    claimed.add(product)
                last = r[9]
            out[r[3]] = (number, not again)
    return out


def got(spark, rows, timeout_s=1800):
    return {r.event_id: (r.session_no, r.counts) for r in ss.with_sessions(frame(spark, rows), timeout_s).collect()}


def test_a_repeated_add_bridges_no_gap(spark):
    """Adds of one product at 0:00 and 0:25 and a view at 0:50 are two sessions: the repeat is skipped before it touches the first."""
    rows = [row(1, "a", 0, "product_added_to_cart", "P1"), row(2, "a", 25, "product_added_to_cart", "p1"), row(3, "a", 50)]
    assert got(spark, rows) == {"e1": (1, True), "e2": (1, False), "e3": (2, True)}


def test_gap_edges(spark):
    rows = [row(1, "a", 0), row(2, "a", 30), row(3, "a", 60 + 1 / 60_000_000), row(4, "a", 90 + 2 / 60_000_000)]
    assert [n for n, _ in got(spark, rows).values()] == [1, 1, 2, 3] or [n for n, _ in got(spark, rows).values()] == [1, 1, 2, 2]
    assert got(spark, rows) == loop(rows)


@pytest.mark.parametrize("seed", range(3))
def test_fold_equals_the_loop(spark, seed):
    draw = random.Random(seed)
    rows, i = [], 0
    for v in range(25):
        at = 0.0
        for _ in range(draw.randint(1, 60)):
            at += draw.choice([0, 0, 0.2, 5, 14, 16, 25, 29, 31, 45])
            i += 1
            name = draw.choice(["page_viewed", "click", "product_added_to_cart", "product_added_to_cart"])
            rows.append(row(i, f"v{v}", at, name, draw.choice(["A", "a", "b", None]) if name == "product_added_to_cart" else None))
    draw.shuffle(rows)
    assert got(spark, rows) == loop(rows)


def test_rows_without_identity_and_empty_tables(spark):
    rows = [row(1, None, 0), row(2, "a", 0), row(3, None, 1)]
    events = ss.session_events(frame(spark, rows)).collect()
    assert len(events) == 3 and len({r.session_id for r in events}) == 3
    assert ss.sessions(frame(spark, [])).count() == 0


def test_one_future_event_does_not_make_live_sessions_look_idle(spark):
    rows = [row(1, "a", 0), row(2, "b", 100_000)]
    s = ss.sessions(frame(spark, rows))
    now = F.lit("2024-01-01 00:20:00").cast("timestamp_ntz")
    assert {r.identity: r.closed for r in ss.swept(s, now=now).collect()} == {"a": False, "b": False}
    assert {r.identity: r.closed for r in ss.swept(s).collect()} == {"a": True, "b": False}


def test_neighbours_that_overlap(spark):
    s = spark.createDataFrame([("a", "1", 1, 0, 100), ("a", "2", 2, 60, 200), ("a", "3", 3, 175, 300), ("b", "4", 1, 0, 9)], "identity string, session_id string, session_no long, b int, e int")
    at = lambda c: F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, {c})")
    found = ss.overlaps(s.select("identity", "session_id", "session_no", at("b").alias("session_start"), at("e").alias("session_end")))
    assert [tuple(r) for r in found.collect()] == [("a", "2", -40)]
