"""Behavioural and click rows from the provided ``events`` and ``pages`` tables, and the readers of raw event streams."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as fn

#: User agents of the adapter, by ``user_id % 7``.
USER_AGENTS = (
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) Mobile/15E148",
    "Mozilla/5.0 (Linux; Android 14; Pixel 8) Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 14; SM-X200) Safari/537.36",
    "Mozilla/5.0 (iPad; CPU OS 17_0 like Mac OS X) Safari/604.1",
    "Mozilla/5.0 (X11; Linux x86_64) Chrome/120.0",
    "Mozilla/5.0 (compatible; Googlebot/2.1)",
    None,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_events(spark: SparkSession, path: str, schema: str, streaming: bool = False, kind: str = "parquet", **options) -> DataFrame:
    """Raw records from files (tests, backfills). A Kafka source with the same columns takes this place on a cluster."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).options(**options).format(kind).load(path)


def kafka_options(servers: str, topics: str, streaming: bool, max_offsets: int = 2000, until_ms: dict[str, dict[str, int]] | None = None) -> dict[str, str]:
    """Options of a Kafka read. A bounded read ends, in each partition (topic: partition: milliseconds), before the first record at or after that time."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topics, "failOnDataLoss": "false"}
    if streaming:
        return options | {"maxOffsetsPerTrigger": str(max_offsets)}
    return options | {"startingOffsets": "earliest"} | ({"endingOffsetsByTimestamp": json.dumps(until_ms)} if until_ms else {"endingOffsets": "latest"})


def read_kafka(spark: SparkSession, servers: str, topics: str, streaming: bool = True, **how) -> DataFrame:
    """Records of the topics as (key, value, topic, partition, offset, timestamp); needs Spark's Kafka package on the class path."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    return reader.options(**kafka_options(servers, topics, streaming, **how)).load()


def present(df: DataFrame, wanted: list[str]) -> list[str]:
    """Those of ``wanted`` that ``df`` has, in that order: for tables whose later columns may be missing."""
    return [c for c in wanted if c in df.columns]


def between(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows with ``first <= column < last``, as plain comparisons that reach the scan (and partitions, if the table has them by that column)."""
    return df.filter((F.col(column) >= F.lit(first).cast("timestamp_ntz")) & (F.col(column) < F.lit(last).cast("timestamp_ntz")))


def table_if_there(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table, or none if there is none of that name."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def activity(spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """One row per event in the common shape of behavioural and click rows, before any correction of time. ``first`` and ``last`` bound the scan."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("page_url"))
    n_pages = pages.count()
    e = table(spark, sf_dir, "events")
    if first and last:
        e = between(e, "ts", first, last)
    k = F.regexp_extract("props", r"(\d+)", 1).cast("long")
    i = F.col("event_id")
    name = (
        F.when((F.col("event_type") == "view") & (i % 2 == 0), "page_viewed")
        .when(F.col("event_type") == "view", "product_viewed")
        .when(F.col("event_type") == "click", "click")
        .when(F.col("event_type") == "signup", "product_added_to_cart")
        .when(F.col("event_type") == "purchase", "checkout_started")
        .otherwise("scroll_depth")
    )
    e = e.withColumns({"event_name": name, "k": k, "page_id": i % max(n_pages, 1)}).join(pages, "page_id", "left")
    single = F.col("event_name").isin("product_viewed", "product_added_to_cart")
    cart = F.concat(F.lit("["), F.col("k"), F.lit(".0, "), F.col("k") + 1, F.lit(".0"), F.when(i % 11 == 0, "").otherwise("]"))
    url = (
        F.when(i % 89 == 0, F.lit(None))
        .when(i % 83 == 0, "")
        .when(i % 10 == 0, "https://shop.example/")
        .when(i % 10 == 1, F.concat(F.lit("https://shop.example/Products/"), "page_id", F.lit("?utm_source=mail&x=1")))
        .when(i % 10 == 2, F.concat(F.lit("https://shop.example/products/"), "page_id", F.lit("/")))
        .when(i % 10 == 3, F.concat(F.lit("https://shop.example/collections/"), F.col("k"), F.lit("/all")))
        .when(i % 10 == 4, F.concat(F.lit("/checkout/"), F.col("k"), F.lit("#pay")))
        .otherwise(F.col("page_url"))
    )
    agent = F.element_at(F.array(*[F.lit(a) for a in USER_AGENTS]), (F.col("user_id") % 7 + 1).cast("int"))
    return e.select(
        F.concat(F.lit("e"), i).alias("event_id"),
        F.col("event_id").alias("seq"),
        "event_name",
        F.when((i % 97 == 0) | (i % 101 == 0), None).otherwise(F.concat(F.lit("u"), "user_id")).alias("actor_id"),
        F.when(i % 101 == 0, None).otherwise(F.concat(F.lit("c"), "user_id")).alias("client_id"),
        url.alias("url"),
        agent.alias("user_agent"),
        F.when(single, F.concat(F.col("k"), F.when(i % 5 == 0, ".0").otherwise(""))).when(F.col("event_name") == "checkout_started", cart).alias("product_id"),
        F.when(single & (i % 7 != 0), F.concat(F.lit("Title "), "k")).when((F.col("event_name") == "checkout_started") & (i % 4 != 0), F.concat(F.lit("['Title "), "k", F.lit("', 'Title "), F.col("k") + 1, F.lit("']"))).alias("product_title"),
        F.when(F.col("event_name") == "click", F.struct(
            F.when(i % 4 == 0, " Button ").when(i % 4 == 1, "A").when(i % 4 == 2, "input").alias("tag"), F.when(i % 5 < 2, F.concat(F.lit(" Btn-"), "k")).alias("element_id"),
            F.when(i % 6 == 0, "Buy").alias("element_name"), F.when(i % 4 == 2, "TEXT").alias("element_type"),
            F.when(i % 4 == 1, url).alias("href"), F.concat(F.lit("  Add  to "), "event_type", F.lit("  "), F.repeat(F.lit("x"), (i % 3 * 40).cast("int"))).alias("value"),
        )).alias("element"),
        F.when(F.col("event_name") == "click", F.when(i % 3 == 0, "useful_click").when(i % 3 == 1, "dead_click")).alias("click_bucket"),
        F.when(F.col("event_name") == "scroll_depth", F.least("value", F.lit(100.0))).alias("scroll_percent"),
        F.col("ts").alias("client_time"),
        F.when(i % 53 == 0, F.expr("ts - INTERVAL 600 SECONDS")).otherwise(F.expr("ts + INTERVAL 90 SECONDS")).alias("received_at"),
    )


def corrected(rows: DataFrame, limit_s: int = 300) -> DataFrame:
    """Adds ``occurred_at``: the client's time, or the receipt where the client's clock runs more than ``limit_s`` ahead of it."""
    ahead = F.col("client_time") > F.col("received_at") + F.expr(f"INTERVAL {limit_s} SECONDS")
    return rows.withColumn("occurred_at", F.when(ahead, F.col("received_at")).otherwise(F.col("client_time")))


def corrected_by_write_time(rows: DataFrame, limit_s: int = 300, ahead_s: int = 19_800) -> DataFrame:
    """``corrected`` for stored rows that keep no receipt: ``ingested_at``, when a database whose clock runs ``ahead_s`` behind the store's wrote the row,
    stands for it. Adds ``occurred_at`` and ``replaced``; rows without a write time keep the client's.
    """
    receipt = F.col("ingested_at") + F.expr(f"INTERVAL {ahead_s} SECONDS")
    replaced = F.coalesce(F.col("client_time") > receipt + F.expr(f"INTERVAL {limit_s} SECONDS"), F.lit(False))
    return rows.withColumns({"occurred_at": F.when(replaced, receipt).otherwise(F.col("client_time")), "replaced": replaced})


def events(spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None) -> DataFrame:
    return corrected(activity(spark, sf_dir, first, last))


def rebuild_window(rows: DataFrame, day: str, margin_s: int = 7200, future_s: int = 129_600, ahead_s: int = 19_860) -> DataFrame:
    """Raw rows needed to rebuild one day: the day and ``margin_s`` on either side, and rows up to ``future_s`` later whose time runs more than ``ahead_s`` ahead of their receipt."""
    begin, end = F.lit(f"{day} 00:00:00").cast("timestamp_ntz"), F.expr(f"timestamp_ntz'{day} 00:00:00' + INTERVAL 86400 SECONDS")
    at = F.col("client_time")
    near = (at >= begin - F.expr(f"INTERVAL {margin_s} SECONDS")) & (at < end + F.expr(f"INTERVAL {margin_s} SECONDS"))
    future = (at >= end) & (at < end + F.expr(f"INTERVAL {future_s} SECONDS")) & (F.expr("timestampdiff(SECOND, received_at, client_time)") > ahead_s)
    return rows.filter(near | future)


def records(rows: DataFrame) -> DataFrame:
    """The rows as broker records (topic, partition, offset, timestamp, value), one in 37 of each kind with a defect, so that the contract has something to refuse."""
    i, d, name = F.col("seq"), F.col("seq") % 37, F.col("event_name")
    click = name == "click"
    stamp = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    raw = F.struct(
        F.when(d == 14, None).when(d == 15, F.repeat(F.lit("9"), 101)).otherwise(F.col("product_id")).alias("product_id"), F.col("product_title"),
        F.when(i % 6 == 0, "2").when(i % 6 == 1, "nan").when(i % 6 == 2, "1e3").alias("quantity"), (i % 50 * 1.5).alias("price"), F.col("scroll_percent").alias("percent"),
    )
    e = F.col("element")
    element = F.struct((i % 1000).alias("x"), F.lit("12").alias("y"), e["tag"].alias("tag_name"), e["element_id"].alias("element_id"), e["element_name"].alias("element_name"), e["element_type"].alias("element_type"), e["href"].alias("href"), e["value"].alias("element_value"))
    signals = F.struct((i % 2 == 0).alias("url_changed"), F.when(i % 3 == 0, True).alias("cart_changed"))
    body = F.to_json(
        F.struct(
            F.lit(1).alias("schema_version"), F.when(click, "click").otherwise("event").alias("type"), F.lit("b").alias("brand_id"), "event_id", "event_name", "actor_id", "client_id",
            stamp("client_time").alias("occurred_at"), stamp("received_at").alias("received_at"), "url", "user_agent", F.when(~click, raw).alias("raw"), F.when(click & (d != 12), element).alias("click"),
            F.when(click, signals).alias("signals"), F.when(d == 13, "odd").otherwise(F.col("click_bucket")).alias("click_bucket"),
        )
    )
    put = lambda text: F.regexp_replace(body, r"^\{", "{" + text)
    value = (
        F.when(d == 0, "{broken").when(d == 1, "[1]").when(d == 2, F.replace(body, F.lit('"schema_version":1'), F.lit('"schema_version":2')))
        .when(d == 3, F.regexp_replace(body, r'"type":"\w+"', '"type":"x"')).when(d == 4, F.regexp_replace(body, r'"event_id":"[^"]*",', "")).when(d == 5, F.replace(body, F.lit('"brand_id":"b"'), F.lit('"brand_id":"  "')))
        .when(d == 6, F.regexp_replace(body, r'"type":"\w+"', F.when(click, '"type":"event"').otherwise('"type":"click"'))).when(d == 7, F.regexp_replace(body, r'("occurred_at":"[^"]*)Z"', '$1"'))
        .when(d == 8, F.regexp_replace(body, r'("occurred_at":")[^"]*"', '$1nonsenseZ"')).when(d == 9, put('"referrer":5,')).when(d == 10, put('"visitor_id":"' + "v" * 101 + '",')).when((d == 11) & ~click, put('"signals":[1],')).otherwise(body)
    )
    return rows.select("seq", fn.topic(name).alias("topic"), (i % 3).cast("int").alias("partition"), i.alias("offset"), F.col("received_at").alias("timestamp"), value.alias("value"))
