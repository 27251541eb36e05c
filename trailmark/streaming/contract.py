"""The message contract: records of (topic, value) checked, refused with a reason, or turned into typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import ordered
from ..sources import adapter

#: Fixed values of the contract.
VERSION, LONGEST_ID, BUCKETS = 1, 100, ("useful_click", "dead_click")
IDS = ("brand_id", "event_id", "event_name", "actor_id", "client_id", "visitor_id")
TEXTS, OBJECTS = ("url", "referrer", "user_agent"), ("raw", "click", "signals")
SENT = ("timestamp", "topic", "partition", "offset")
ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.]\d{1,6})?)?)?)?$"


def _kind(v: Column, field: str) -> Column:
    """The JSON type of a field; null if it is absent or null."""
    kind = F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant"))
    return F.nullif(kind, F.lit("VOID"))


def _text(v: Column, field: str) -> Column:
    return F.try_variant_get(v, f"$.{field}", "string")


def store_time(value: Column) -> Column:
    """A store-local time whose trailing Z is a mark, not a zone: its digits are kept. Null if it is anything else."""
    digits = F.regexp_replace(value, "Z$", "")
    return F.when(F.endswith(value, F.lit("Z")) & digits.rlike(ISO), digits.try_cast("timestamp_ntz"))


#: What the checks of a record read, each taken from the variant once: the types of these fields, the texts of those, and whether objects are there and are some.
KINDS = ("schema_version", "type", *IDS, *TEXTS, "occurred_at", "click_bucket")


def _taken(v: Column) -> dict[str, Column]:
    out = {f"__kind_{f}": _kind(v, f) for f in KINDS} | {f"__text_{f}": _text(v, f) for f in ("type", *IDS, "occurred_at", "click_bucket")}
    for f in OBJECTS:  # an object's full type, which lists its fields, is not asked for
        part = F.try_variant_get(v, f"$.{f}", "variant")
        out[f"__there_{f}"] = part.isNotNull() & ~F.is_variant_null(part)
        out[f"__object_{f}"] = F.try_variant_get(v, f"$.{f}", "struct<product_id variant>").isNotNull()
    product = F.try_variant_get(v, "$.raw.product_id", "variant")
    return out | {"__kind_product": F.schema_of_variant(product), "__text_product": _text(v, "raw.product_id"), "__version": F.try_variant_get(v, "$.schema_version", "double")}


def _bad_text(field: str, required: bool, is_id: bool) -> Column:
    kind = F.col(f"__kind_{field}")
    checks = F.when(kind.isNull(), F.lit(f"{field} is required") if required else F.lit(None))
    checks = checks.when(kind != "STRING", f"{field} must be a string")
    if not is_id:
        return checks
    text = F.col(f"__text_{field}")
    checks = checks.when(~text.rlike(r"\S"), F.lit(f"{field} must not be blank") if required else F.lit(None))
    return checks.when(F.length(text) > LONGEST_ID, f"{field} is longer than {LONGEST_ID} characters")


#: The wordings below are fixed values: a dead letter shows them.
def reject_reason(value: Column, v: Column) -> Column:
    """Why a record is refused (the first check it fails); null if it is sound. ``v`` is the value parsed as a variant, null if it is no JSON; the columns of ``_taken`` stand beside it."""
    kind, text = (lambda f: F.col(f"__kind_{f}")), (lambda f: F.col(f"__text_{f}"))
    version, type_ = kind("schema_version"), text("type")
    click = type_ == "click"
    product, product_kind = text("product"), kind("product")
    adds = text("event_name") == "product_added_to_cart"
    checks = [
        F.when(v.isNull(), "payload is not valid JSON"),
        F.when(~F.startswith(F.ltrim(value, F.lit(" \t\r\n")), F.lit("{")), "payload must be a JSON object"),
        F.when(version.isNull() | version.isin("BOOLEAN", "STRING") | (F.coalesce("__version", F.lit(0.0)) != VERSION), "unsupported schema_version"),
        F.when(~F.coalesce((kind("type") == "STRING") & type_.isin("event", "click"), F.lit(False)), "unsupported type"),
        *[_bad_text(f, True, True) for f in IDS[:3]],
        F.when(click != (text("event_name") == "click"), "type click and event_name click must go together"),
        F.when(~F.coalesce((kind("occurred_at") == "STRING") & F.endswith(text("occurred_at"), F.lit("Z")), F.lit(False)), "occurred_at must be an ISO timestamp ending in Z"),
        F.when(store_time(text("occurred_at")).isNull(), "occurred_at is not a valid ISO timestamp"),
        *[_bad_text(f, False, True) for f in IDS[3:]],
        *[_bad_text(f, False, False) for f in TEXTS],
        *[F.when(F.col(f"__there_{f}") & ~F.col(f"__object_{f}"), f"{f} must be an object") for f in OBJECTS],
        F.when(click & ~F.col("__there_click"), "click payload is required for a click"),
        F.when(click & kind("click_bucket").isNotNull() & ~F.coalesce(text("click_bucket").isin(*BUCKETS), F.lit(False)), "invalid click_bucket"),
        F.when(adds & ((F.coalesce(product_kind, F.lit("VOID")) != "STRING") | ~F.coalesce(product.rlike(r"\S"), F.lit(False))), "product_added_to_cart requires raw.product_id"),
        F.when(adds & (F.length(product) > LONGEST_ID), f"raw.product_id is longer than {LONGEST_ID} characters"),
    ]
    return F.get(F.filter(F.array(*checks), lambda c: c.isNotNull()), F.lit(0))  # one array, so that the optimizer has no conditions to spread


def parsed(records: DataFrame) -> DataFrame:
    """Adds ``v`` (the value as a variant) and ``reject_reason``: valid and dead-letter rows are two filters on it."""
    text = F.col("value").cast("string")
    rows = records.withColumn("v", F.try_parse_json(text))
    return rows.withColumns(_taken(F.col("v"))).select(*rows.columns, reject_reason(text, F.col("v")).alias("reject_reason"))


def dead_letters(checked: DataFrame) -> DataFrame:
    """Refused records as they came, with the reason, where they stood and how often they were tried: ``attempts`` of the records, once if they have none."""
    tried = F.coalesce("attempts", F.lit(1)).cast("int") if "attempts" in checked.columns else F.lit(1)
    return checked.filter("reject_reason is not null").select("topic", "partition", "offset", *[c for c in ("key",) if c in checked.columns], "value", "reject_reason", tried.alias("attempts"))


#: The headers of a quarantined record.
HEADERS = ("dlq_reason", "dlq_source_topic", "dlq_source_partition", "dlq_source_offset", "dlq_attempts", "dlq_failed_at")
LONGEST_REASON = 1000


def quarantined(letters: DataFrame, topic: str, failed_at: Column | None = None) -> DataFrame:
    """Dead letters as records for a Kafka sink: key and value as they came (an empty value for none), and what is known of them in headers.

    The reason is cut to 1,000 bytes of UTF-8; ``failed_at`` (seconds) is the time of writing unless given.
    """
    at = F.unix_timestamp() if failed_at is None else failed_at
    of = [F.substring(F.encode("reject_reason", "utf-8"), 1, LONGEST_REASON), *[F.encode(c.cast("string"), "utf-8") for c in (F.col("topic"), F.col("partition"), F.col("offset"), F.col("attempts"), at)]]
    headers = F.array(*[F.struct(F.lit(name).alias("key"), value.alias("value")) for name, value in zip(HEADERS, of, strict=True)])
    key = F.col("key").cast("binary") if "key" in letters.columns else F.lit(None).cast("binary")
    return letters.select(F.lit(topic).alias("topic"), key.alias("key"), F.coalesce(F.col("value").cast("binary"), F.lit(b"")).alias("value"), headers.alias("headers"))


def _id(v: Column, field: str) -> Column:
    return F.nullif(F.trim(_text(v, field)), F.lit(""))


def messages(checked: DataFrame) -> DataFrame:
    """Sound messages as rows: identities, times (the future clock corrected), page, product and click fields, in the shape the sessionizer takes."""
    v = F.col("v")
    at, received = store_time(_text(v, "occurred_at")), store_time(_text(v, "received_at"))
    rows = checked.filter("reject_reason is null").select(
        "v", _text(v, "type").alias("type"), *[_id(v, f).alias(f) for f in IDS], *[F.nullif(_text(v, f), F.lit("")).alias(f) for f in TEXTS],
        at.alias("client_time"), received.alias("received_at"), F.when(_text(v, "click_bucket").isin(*BUCKETS), _text(v, "click_bucket")).alias("click_bucket"),
        F.try_variant_get(v, "$.raw.product_id", "string").alias("product_id"), *[c for c in checked.columns if c in ("seq", "topic", "offset", "partition", "timestamp", "value")],
    )
    return adapter.corrected(rows)


def _number(v: Column, path: str) -> Column:
    """A number, or a text that reads as one; null otherwise, and for what is not finite."""
    x = F.try_variant_get(v, path, "string").try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def event_rows(rows: DataFrame, *more: str) -> DataFrame:
    """Behavioural rows: product fields of ``raw`` as texts and numbers, scroll percent, the raw object as JSON, the five utm values of the URL."""
    v = F.col("v")
    raw = lambda f: F.try_variant_get(v, f"$.raw.{f}", "string").alias(f)
    numbers = {"quantity": "quantity", "price": "price", "checkout_total": "checkout_total", "scroll_percent": "percent"}
    return rows.filter("type = 'event'").withColumn("__utm", fn.utm_pairs(F.col("url"))).select(
        "event_id", "event_name", "actor_id", "client_id", "visitor_id", *TEXTS, *[raw(f) for f in ("product_id", "variant_id", "product_title", "variant_title", "currency")],
        *[_number(v, f"$.raw.{source}").alias(f) for f, source in numbers.items()], F.to_json(F.try_variant_get(v, "$.raw", "variant")).alias("data"), "occurred_at",
        *[fn.utm_of(F.col("__utm"), name).alias(name) for name in fn.UTM], *more,
    )


def click_rows(rows: DataFrame, *more: str) -> DataFrame:
    """Click rows: place, element, signals, bucket, and both objects as one JSON text."""
    v = F.col("v")
    part = lambda path: F.try_variant_get(v, path, "string")
    trimmed = lambda path: F.nullif(F.trim(part(path)), F.lit(""))
    whole = lambda path: F.try_variant_get(v, path, "string").try_cast("double").try_cast("int")
    signal = lambda f: F.try_variant_get(v, f"$.signals.{f}", "boolean").alias(f)
    return rows.filter("type = 'click'").withColumn("__utm", fn.utm_pairs(F.col("url"))).select(
        "event_id", "event_name", "actor_id", "client_id", "visitor_id", *TEXTS, whole("$.click.x").alias("click_x"), whole("$.click.y").alias("click_y"), trimmed("$.click.tag_name").alias("click_tag"),
        *[trimmed(f"$.click.{f}").alias(f"click_{f}") for f in ("element_id", "element_name", "element_type")], part("$.click.element_value").alias("click_element_value"), part("$.click.href").alias("click_href"),
        *[signal(f) for f in ("url_changed", "cart_changed", "ui_changed", "meaningful_scroll")], "click_bucket",
        F.to_json(F.struct(F.try_variant_get(v, "$.click", "variant").alias("click"), F.try_variant_get(v, "$.signals", "variant").alias("signals"))).alias("data"), "occurred_at", *[fn.utm_of(F.col("__utm"), name).alias(name) for name in fn.UTM], *more,
    )


def in_send_order(records: DataFrame) -> DataFrame:
    """One order over all partitions: time of sending, topic, partition, offset."""
    return records.orderBy(*SENT)


def numbered_in_send_order(records: DataFrame) -> DataFrame:
    """Adds ``place``, each record's number (from 1) in that order."""
    return ordered.numbered(records, list(SENT))


def released(buffered: DataFrame, partitions: DataFrame, now: str, slack_s: int = 10) -> DataFrame:
    """Buffered records that may be applied now, in one order over all partitions.

    A record may go once no partition can still send one that belongs before it: each partition (topic, partition, caught_up) has a buffered record at or
    after it, or is caught up and the record is ``slack_s`` and a second old. An empty partition that is not caught up holds everything back.
    """
    place = F.struct("timestamp", "topic", "partition", "offset")
    lasts = partitions.join(buffered.groupBy("topic", "partition").agg(F.max(place).alias("last")), ["topic", "partition"], "left")
    bounds = lasts.agg(
        F.count_if(~F.col("caught_up") & F.col("last").isNull()).alias("silent"), F.min(F.when(~F.col("caught_up"), F.col("last"))).alias("behind"),
        F.count_if(F.col("last").isNull()).alias("empty"), F.min("last").alias("all"),
    )
    old = F.expr(f"timestamp_ntz'{now}'") >= F.col("timestamp") + F.expr(f"INTERVAL {slack_s + 1} SECONDS")
    ready = (F.col("silent") == 0) & (F.col("behind").isNull() | (place <= F.col("behind"))) & (old | ((F.col("empty") == 0) & (place <= F.col("all"))))
    return in_send_order(buffered.crossJoin(F.broadcast(bounds)).filter(ready).select(*buffered.columns))  # one row
