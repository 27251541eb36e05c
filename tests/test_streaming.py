"""The message contract of the stream, its branches, and sessions of a stream against the batch fold."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from trailmark.operators import sessions as ss
from trailmark.sources import adapter
from trailmark.streaming import contract
from trailmark.streaming import sessions as streaming

GOOD = {"schema_version": 1, "type": "event", "brand_id": "b", "event_id": "1", "event_name": "page_viewed", "occurred_at": "2024-01-01T00:00:00Z"}
CLICK = GOOD | {"type": "click", "event_name": "click", "click": {"x": "7"}}
ADD = GOOD | {"event_name": "product_added_to_cart", "raw": {"product_id": "p"}}
#: A message and why it is refused (none: it is sound).
CASES = [
    (GOOD, None), (CLICK, None), (ADD, None), (GOOD | {"schema_version": 1.0, "raw": None, "actor_id": "  "}, None), (GOOD | {"event_name": "add_to_cart"}, None), (GOOD | {"click_bucket": "odd"}, None),
    ("nonsense", "not valid JSON"), (None, "not valid JSON"), ([1], "must be a JSON object"), (GOOD | {"schema_version": 2}, "schema_version"), (GOOD | {"schema_version": True}, "schema_version"), (GOOD | {"type": "x"}, "unsupported type"),
    (GOOD | {"brand_id": None}, "brand_id is required"), (GOOD | {"event_id": 5}, "event_id must be a string"), (GOOD | {"event_name": " "}, "event_name must not be blank"), (GOOD | {"event_id": "x" * 101}, "longer than 100"),
    (GOOD | {"type": "click", "click": {}}, "go together"), (GOOD | {"occurred_at": "2024-01-01T00:00:00"}, "ending in Z"), (GOOD | {"occurred_at": "2024-13-01T00:00:00Z"}, "not a valid ISO"), (GOOD | {"occurred_at": 5}, "ending in Z"),
    (GOOD | {"visitor_id": "x" * 101}, "longer than 100"), (GOOD | {"url": 5}, "url must be a string"), (GOOD | {"raw": [1]}, "raw must be an object"), (GOOD | {"signals": "x"}, "signals must be an object"),
    (CLICK | {"click": None}, "click payload is required"), (CLICK | {"click_bucket": "odd"}, "invalid click_bucket"), (ADD | {"raw": {}}, "requires raw.product_id"), (ADD | {"raw": {"product_id": 5}}, "requires raw.product_id"), (ADD | {"raw": {"product_id": "9" * 101}}, "raw.product_id is longer"),
]


def records(spark, values):
    rows = [("t", 0, i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, value string")


def test_contract(spark):
    got = contract.parsed(records(spark, [v for v, _ in CASES])).orderBy("offset").collect()
    for r, (_, reason) in zip(got, CASES, strict=True):
        assert (r.reject_reason is None) if reason is None else reason in (r.reject_reason or ""), r.value


def test_rows_of_messages(spark):
    message = ADD | {"received_at": "2023-12-31T23:00:00Z", "client_id": " c ", "url": "http://x/?utm_source=a", "raw": {"product_id": " p ", "quantity": "1e3", "price": "x", "percent": 12.5}}
    rows = contract.messages(contract.parsed(records(spark, [message, CLICK | {"click": {"x": "7.9", "tag_name": " A "}, "signals": {"url_changed": False}}])))
    event, click = contract.event_rows(rows).first(), contract.click_rows(rows).first()
    assert (event.client_id, event.quantity, event.price, event.scroll_percent, event.utm_source, str(event.occurred_at)) == ("c", 1000.0, None, 12.5, "a", "2023-12-31 23:00:00")
    assert (click.click_x, click.click_tag, click.url_changed, click.cart_changed) == (7, "A", False, None)


def test_branches_are_written_and_repeats_change_nothing(spark, tmp_path):
    write = streaming.split_records(f"{tmp_path}/good", f"{tmp_path}/dead")
    for number in (0, 1, 1):
        write(records(spark, [v for v, _ in CASES]), number)
    dead = spark.read.parquet(f"{tmp_path}/dead")
    assert dead.count() == 2 * sum(r is not None for _, r in CASES) and dead.filter("reject_reason is null").count() == 0
    assert spark.read.parquet(f"{tmp_path}/good").count() == 2 * sum(r is None for _, r in CASES)


def test_redelivered_rows_are_not_stored_again(spark, tmp_path):
    write = streaming.append_new(f"{tmp_path}/t", "k", within="day")
    rows = lambda *keys: spark.createDataFrame([(k, "2024-01-01") for k in keys], "k string, day string")
    for number, batch in ((0, rows("a", "b", "b")), (1, rows("b", "c")), (1, rows("b", "c"))):
        write(batch, number)
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/t").collect()) == ["a", "b", "c"]


def test_sessions_of_a_stream_equal_the_batch_fold(spark, tmp_path):
    """Two files of one day's visitors, read as a stream in order of time: what it closes are the batch sessions but each visitor's last."""
    rows = adapter.events(spark, "/root/testdata/sf0.001").filter("occurred_at < '2024-01-12'").select("actor_id", "client_id", "event_name", "product_id", "occurred_at", "received_at", "seq", "event_id", "url", "click_bucket")
    edge = F.lit("2024-01-06").cast("timestamp_ntz")
    rows.filter(F.col("occurred_at") < edge).coalesce(1).write.parquet(f"{tmp_path}/in")
    rows.filter(F.col("occurred_at") >= edge).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = adapter.read_events(spark, f"{tmp_path}/in", rows.schema, streaming=True, maxFilesPerTrigger=1)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # else the idle sweep keeps the query alive
    query = streaming.closed_sessions(stream, timeout_s=86_400).writeStream.format("memory").queryName("closed").outputMode("append").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    query.awaitTermination(150)
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert query.exception() is None and not query.isActive
    got = {(r.identity, r.session_no): (r.session_start, r.session_end, r.event_count) for r in spark.table("closed").collect()}
    batch = ss.sessions(rows, 86_400)
    last = {r.identity: r.n for r in batch.groupBy("identity").agg(F.max("session_no").alias("n")).collect()}
    expected = {(r.identity, r.session_no): (r.session_start, r.session_end, r.event_count) for r in batch.collect() if r.session_no < last[r.identity]}
    assert got == expected and got
