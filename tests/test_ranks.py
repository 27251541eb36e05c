"""Nearest ranks against sorted lists, and no plan that gathers a group's values."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from trailmark.operators import evaluation, scoring
from trailmark.plans import registry

SF = "/root/testdata/sf0.001"


def test_nearest_ranks_equal_sorted_lists(spark):
    draw = random.Random(1)
    rows = [(k, draw.choice([None, 0.0, *(round(draw.random() * 5, 1) for _ in range(8))]), draw.random() < 0.4) for k in range(12) for _ in range(draw.randint(1, 60))]
    rows += [(100, None, True), (101, 2.5, False)] + [(None, float(i), True) for i in range(6)]
    df = spark.createDataFrame(rows, "k int, x double, able boolean")
    cuts = {f"{tag}{p}": (p / 100, c) for tag, c in (("all", None), ("able", F.col("able"))) for p in (20, 35, 50, 72, 90)}
    got = {r.k: r.asDict() for r in scoring.nearest_ranks(df, "k", F.col("x"), cuts).collect()}
    assert set(got) == {k for k, _, _ in rows}
    for k, r in got.items():
        for tag in ("all", "able"):
            values = sorted(x for key, x, able in rows if key == k and x is not None and (tag == "all" or able))
            assert r["n"] == len(values) or tag == "able"
            for p in (20, 35, 50, 72, 90):
                assert r[f"{tag}{p}"] == (values[round(p / 100 * (len(values) - 1))] if values else None)


def test_thresholds_gather_no_group(spark):
    plans = registry.Plans(spark, SF)
    long = evaluation.versions_long(plans.scored())
    for df in (scoring.dead_click_p90(plans.facts()), plans.calibration(), long, evaluation.score_bands(long), evaluation.threshold_shift(long)):
        assert "collect_list" not in df._jdf.queryExecution().optimizedPlan().toString()
