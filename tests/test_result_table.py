"""The long result table: its columns, failures of one version alone, unknown versions and outcomes, empty input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trailmark.operators import evaluation as ev
from trailmark.operators import scoring as sc

FACTS = "session_id string, session_start timestamp_ntz, status string, stage int, score double, bucket string, event_count long, page_view_count long, product_view_count long, click_count long, useful_click_count long, dead_click_count long, scroll_count long, session_time_spent_ms long, add_to_cart_count long, checkout_started_count long, page_rank int, entry_page_type string, p90 double, extra double, version string"


def sessions(spark, rows):
    full = [(sid, None, status, stage, 1.0, "low", 5, 3, 2, 12, 2, dead, 1, 60_000, cart, 0, 4, "home", 0.5, extra, "clash") for sid, status, stage, dead, cart, extra in rows]
    return spark.createDataFrame(full, FACTS)


def test_a_version_fails_alone(spark):
    df = sessions(spark, [("a", "scored", 2, 0, 0, 1.0), ("b", "scored", 1, 11, 1, None), ("c", "bot", 2, 0, 0, 1.0), ("d", "pending", 0, 0, 0, None), ("e", "scored", 2, 0, 0, float("nan"))])
    known = sc.VERSIONS | {"VS": sc.Version("VS", (*sc.TERMS, ("extra", 100, 0.1)))}
    out = ev.result_table(df, ("V1", "VS"), None, known)
    assert tuple(out.columns) == ev.RESULT and len(ev.RESULT) == 38
    got = {(r.session_id, r.version): r for r in out.collect()}
    assert len(got) == 10
    assert [got[s, "VS"].status for s in "abcde"] == ["scored", "error", "excluded", "pending", "error"]
    assert [got[s, "V1"].status for s in "abcde"] == ["scored", "scored", "excluded", "pending", "scored"]
    assert got["b", "VS"].error_reason == got["e", "VS"].error_reason == "missing: extra" and got["b", "VS"].score is None and got["b", "VS"].bucket is None
    assert got["c", "V1"].exclusion_reason == "bot" and got["d", "V1"].exclusion_reason == "missing_duration"
    assert got["b", "V1"].operational_bucket == "high" and "struggle_penalty" in got["b", "V1"].reason_codes
    assert got["a", "VS"].p35 == got["a", "VS"].score  # the one score of its population
    assert all(r.purchased is None and r.brand_id is None for r in got.values())


def test_outcomes_unknown_versions_and_nothing(spark):
    df = sessions(spark, [("a", "scored", 2, 0, 0, 1.0), ("b", "scored", 0, 0, 0, 1.0)])
    paid = spark.createDataFrame([("a", True, 9.99999)], "session_id string, purchased boolean, order_value double")
    got = {r.session_id: r for r in ev.result_table(df.withColumn("purchased", F.lit(False)), ("V2",), paid).collect()}
    assert (got["a"].purchased, got["a"].order_value, got["b"].purchased) == (True, 10.0, None)
    assert got["b"].bucket == "low" and got["b"].reason_codes.startswith("stage_0_passive")
    with pytest.raises(ValueError, match="V9"):
        ev.result_table(df, ("V1", "V9"))
    assert ev.result_table(df.limit(0)).count() == 0
