"""Dead letters as records of a quarantine topic."""

from __future__ import annotations

from pyspark.sql import functions as F

from trailmark.streaming import contract


def test_headers_key_and_value(spark):
    rows = [("t", 1, 7, b"k", b"{x", "r" * 999 + "éé", 4), ("t", 2, 8, None, None, "odd", None)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, key binary, value binary, reject_reason string, attempts int")
    got = contract.quarantined(contract.dead_letters(df), "dlq", F.lit(5)).collect()
    heads = [{h.key: bytes(h.value) for h in r.headers} for r in got]
    assert tuple(heads[0]) == contract.HEADERS
    assert len(heads[0]["dlq_reason"]) == 1000 and heads[0]["dlq_attempts"] == b"4" and heads[1]["dlq_attempts"] == b"1"
    assert (heads[1]["dlq_source_topic"], heads[1]["dlq_source_partition"], heads[1]["dlq_source_offset"], heads[1]["dlq_failed_at"]) == (b"t", b"2", b"8", b"5")
    assert [(r.topic, r.key and bytes(r.key), bytes(r.value)) for r in got] == [("dlq", b"k", b"{x"), ("dlq", None, b"")]


def test_sound_records_and_letters_without_attempts(spark):
    df = spark.createDataFrame([("t", 1, 7, b"{x", None), ("t", 1, 8, b"{x", "bad")], "topic string, partition int, offset long, value binary, reject_reason string")
    out = contract.dead_letters(df)
    assert [(r.offset, r.attempts) for r in out.collect()] == [(8, 1)] and "key" not in out.columns
    assert contract.quarantined(out, "dlq").first().key is None
    assert contract.quarantined(out.limit(0), "dlq").count() == 0
