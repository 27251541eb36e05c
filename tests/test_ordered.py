"""Running totals and places over ranges of an order, against sorted lists; ranks of many values through them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from trailmark.operators import ordered, scoring


def test_running_totals_equal_a_loop_for_any_number_of_pieces(spark):
    draw = random.Random(3)
    rows = [(draw.choice([None, "a", "a", "a", "b"]), i, draw.choice([None, 1, 5]), "clash") for i in draw.sample(range(10_000), 600)]
    df = spark.createDataFrame(rows, "k string, at long, n long, __note string")
    want, sums = {}, {}
    for k, at, n, _ in sorted(rows, key=lambda r: r[1]):
        sums[k] = sums.get(k, 0) + (n or 0)
        want[k, at] = sums[k]
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = ordered.running(df, ["k"], ["at"], {"upto": F.col("n")}).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert {(r.k, r.at): r.upto for r in got} == want and len(got) == len(rows)
        assert {r.k: r.upto_all for r in got} == sums


def test_places_have_no_gaps(spark):
    df = spark.createDataFrame([(x % 3, -x) for x in range(100)], "a int, b int")
    got = sorted(ordered.numbered(df, ["a", "b"]).collect(), key=lambda r: r.place)
    assert [r.place for r in got] == list(range(1, 101)) and [(r.a, r.b) for r in got] == sorted((x % 3, -x) for x in range(100))
    assert ordered.numbered(df.limit(0), ["a", "b"]).count() == 0


def test_ranks_of_many_values_equal_the_window(spark):
    draw = random.Random(4)
    rows = [(draw.choice([1, 2, None]), draw.choice([None, round(draw.random() * 50, 1)]), draw.random() < 0.3) for _ in range(800)]
    df = spark.createDataFrame(rows, "k int, x double, able boolean")
    cuts = {"p25": (0.25, None), "able90": (0.9, F.col("able"))}
    few, many = (scoring.nearest_ranks(df, "k", F.col("x"), cuts, many=m).collect() for m in (False, True))
    assert sorted(map(str, few)) == sorted(map(str, many))


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_no_window_holds_a_whole_group(spark, keys):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = ordered.running(df, keys, ["id"], {"n": F.lit(1)})._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        assert "Window [" not in line or "__piece" in line or "AS n_all" in line  # the latter over a row a piece
