"""The session stream from records to tables, against the batch sessions of the same records, for any cut into batches; its steps, counts, key table and restarts."""

from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from trailmark.operators import sessions as ss
from trailmark.sources import adapter
from trailmark.streaming import contract, machine

SF = "/root/testdata/sf0.001"
RECORD = "topic string, partition int, offset long, timestamp timestamp, value string"
NOON = datetime.datetime(2024, 1, 1, 12)


def records_of(spark):
    """Records in order of event time, a third of them of another brand."""
    made = adapter.records(adapter.events(spark, SF).withColumn("received_at", F.col("occurred_at")))
    other = F.when(F.col("offset") % 3 == 0, F.replace("value", F.lit('"brand_id":"b"'), F.lit('"brand_id":"c"'))).otherwise(F.col("value"))
    return made.select("topic", "partition", "offset", F.col("timestamp").cast("timestamp").alias("timestamp"), other.alias("value"))


def message(i, seconds, name="page_viewed", product=None, actor="a", brand="b", sent=None, **more):
    at = NOON + datetime.timedelta(seconds=seconds)
    body = {"schema_version": 1, "type": "click" if name == "click" else "event", "brand_id": brand, "event_id": f"e{i}", "event_name": name, "actor_id": actor, "client_id": "c", "occurred_at": at.isoformat() + "Z", **more}
    if product:
        body["raw"] = {"product_id": product}
    if name == "click":
        body |= {"click": {}, "click_bucket": "useful_click"}
    return ("t", 0, i, at if sent is None else NOON + datetime.timedelta(seconds=sent), json.dumps(body))


def streamed(spark, folder, batches, name, timeout_s=1800, **how):
    """Writes each batch of rows as a file and runs the stream over them, one file a batch; totals of the counts."""
    for rows in batches:
        frame = spark.createDataFrame(rows, RECORD) if isinstance(rows, list) else rows
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # a run that ends with its input leaves the last sessions open
    spark.conf.set("spark.sql.shuffle.partitions", "2")  # state stores of each batch
    counted = machine.Counted()
    spark.streams.addListener(counted)
    try:
        stream = adapter.read_events(spark, f"{folder}/in", RECORD, streaming=True, maxFilesPerTrigger=1)
        for query in machine.run(stream, f"{folder}/out", name, timeout_s, **how):
            assert query.awaitTermination(280) and query.exception() is None
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(counted)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    return counted.totals.get(name, {})


def stored(spark, folder, table):
    return spark.read.parquet(f"{folder}/out/{table}")


@pytest.mark.parametrize("cuts", [1, 3, 20])
def test_any_cut_into_batches_gives_the_batch_sessions(spark, tmp_path, cuts):
    records = records_of(spark).cache()
    bounds = sorted(r.timestamp for r in records.select("timestamp").collect())
    edges = [None, *(bounds[len(bounds) * k // cuts] for k in range(1, cuts)), None]
    at = F.col("timestamp")
    parts = [records.filter((F.lit(True) if a is None else at >= F.lit(a)) & (F.lit(True) if b is None else at < F.lit(b))) for a, b in zip(edges, edges[1:], strict=False)]
    counts = streamed(spark, tmp_path, parts, f"cut{cuts}", timeout_s=86_400)
    sound = contract.messages(contract.parsed(records)).drop("v").withColumn("seq", F.col("offset"))
    batch = ss.keep_first_cart_adds(ss.with_sessions(sound, 86_400)).cache()
    events = stored(spark, tmp_path, "events").select("event_id", "session_id").unionByName(stored(spark, tmp_path, "clicks").select("event_id", "session_id"))
    expected = {(r.event_id, r.session_id) for r in batch.select("event_id", "session_id").collect()}
    alone = ss.identified(sound).filter("identity is null").count()
    got = {(r.event_id, r.session_id) for r in events.collect()}
    assert expected <= got and len(got) == len(expected) + alone == events.count()
    rows = ss.session_rows(batch).cache()
    last = {(r.brand_id, r.identity): r.n for r in batch.groupBy("brand_id", "identity").agg(F.max("session_no").alias("n")).collect()}
    owner = {r.session_id: r.brand_id for r in batch.select("session_id", "brand_id").distinct().collect()}
    facts = lambda r: (r.identity, r.session_id, r.session_start, r.session_end, r.session_time_spent_ms, *(r[c] for c in machine.COUNTERS), r.client_id, r.first_utm_source)
    closed = {facts(r) for r in rows.collect() if r.session_no < last[owner[r.session_id], r.identity]}
    assert {facts(r) for r in stored(spark, tmp_path, "sessions").collect()} == closed and closed
    assert counts["sessions_closed"] == len(closed) and counts["applied"] == len(got) and counts["late"] == counts["duplicates"] == 0
    assert stored(spark, tmp_path, "dead_letters").count() == contract.dead_letters(contract.parsed(records)).count()


def test_steps_back_repeats_and_late_records_are_applied_and_counted(spark, tmp_path):
    add = "product_added_to_cart"
    first = [message(1, 0, add, "P"), message(2, 60), message(3, 30, sent=61), message(4, 100, add, "p"), message(5, 0, actor="z", brand="c"), message(6, 0, actor=None, client_id=None), message(11, 5, actor="q")]
    second = [message(7, 29, sent=200), message(2, 60, sent=201), message(8, 90, sent=90), ("t", 0, 99, NOON, "{broken"), message(12, 5 + 1800 + 1 / 1e6, actor="q")]
    third = [message(9, 40, "click", sent=300), message(10, 40, actor="z", brand="b", received_at="2024-01-01T11:00:00Z")]
    counts = streamed(spark, tmp_path, [first, second, third], "steps")
    by_id = {r.event_id: r.session_id for r in stored(spark, tmp_path, "events").unionByName(stored(spark, tmp_path, "clicks"), allowMissingColumns=True).collect()}
    own = lambda brand, actor, i: machine.session_id(brand, actor, f"e{i}")
    assert by_id["e1"] == by_id["e2"] == by_id["e3"] == own("b", "a", 1)  # 30 s back stays
    assert by_id["e8"] == by_id["e1"]  # late, and applied
    assert by_id["e7"] == by_id["e9"] == own("b", "a", 7)  # 61 s back opens another
    assert by_id["e5"] == own("c", "z", 5) and by_id["e10"] == own("b", "z", 10)  # brands are apart
    assert by_id["e11"] == own("b", "q", 11) and by_id["e12"] == own("b", "q", 12)  # a microsecond over the timeout
    assert "e4" not in by_id and "e6" in by_id
    assert counts["repeated_adds"] == 1 and counts["duplicates"] == 1 and counts["late"] >= 1 and counts["backward"] >= 1 and counts["clock_replaced"] == 1
    assert stored(spark, tmp_path, "dead_letters").count() == 1


def test_key_table_reads_the_touched_partitions_only(spark, tmp_path):
    keys = machine.KeyTable(f"{tmp_path}/keys", "k", parts=8)
    frame = lambda *names: spark.createDataFrame([(n,) for n in names], "k string")
    for number, names in ((0, "abcde"), (1, "defgh")):
        fresh = keys.fresh(frame(*names), number)
        assert sorted(r.k for r in fresh.collect()) == sorted(set(names) - (set("abcde") if number else set()))
        keys.store(fresh, number)
    again = keys.fresh(frame("a", "x"), 2)  # long after any horizon
    assert [r.k for r in again.collect()] == ["x"]
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert sorted(r.k for r in keys.fresh(frame(*"defgh"), 1).collect()) == ["f", "g", "h"]  # the batch comes again


def test_a_stream_goes_on_from_a_batch(spark, tmp_path):
    """Open sessions of a batch are the state to begin with; the stream continues them under the same ids."""
    before = contract.messages(contract.parsed(spark.createDataFrame([message(1, 0, "product_added_to_cart", "P"), message(2, 60), message(3, 0, actor="x")], RECORD))).drop("v").withColumn("seq", F.col("offset"))
    cursors = machine.open_cursors(ss.keep_first_cart_adds(ss.with_sessions(before)))
    counts = streamed(spark, tmp_path, [[message(4, 120, "product_added_to_cart", "p"), message(5, 130), message(6, 130 + 1801), message(7, 10_000, actor="x")]], "goes_on", open_sessions=cursors)
    assert counts["repeated_adds"] == 1 and counts["sessions_closed"] == 2
    closed = {r.session_id: r for r in stored(spark, tmp_path, "sessions").collect()}
    held = closed[machine.session_id("b", "a", "e1")]
    assert (held.event_count, held.add_to_cart_count, held.session_time_spent_ms) == (3, 1, 130_000) and closed[machine.session_id("b", "x", "e3")].event_count == 1
