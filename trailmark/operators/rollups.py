"""The daily rollups, each one declarative aggregation per date and key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fn

DAY = "summary_date"


def daily_summary(swept: DataFrame) -> DataFrame:
    """Per day of start: counts, sums, means and click rates of closed sessions; ``sessions_started`` adds the open ones. One pass over ``swept``."""
    sums = {"total_events": "event_count", "page_views": "page_view_count", "product_views": "product_view_count", "clicks": "click_count", "useful_clicks": "useful_click_count", "dead_clicks": "dead_click_count", "add_to_carts": "add_to_cart_count", "checkout_starts": "checkout_started_count", "scroll_events": "scroll_count"}
    means = {"avg_session_time_ms": "session_time_spent_ms", "avg_events_per_session": "event_count", "avg_product_views_per_session": "product_view_count", "avg_clicks_per_session": "click_count"}
    shut = lambda c: F.when(F.col("closed"), F.col(c))
    out = swept.groupBy(F.to_date("session_start").alias(DAY)).agg(
        F.count_if("closed").alias("sessions"),
        F.countDistinct(shut("identity")).alias("unique_actors"),
        *[F.coalesce(F.sum(shut(c)), F.lit(0)).alias(k) for k, c in sums.items()],
        *[fn.rounded(F.avg(shut(c)), 4).alias(k) for k, c in means.items()],
        F.count("*").alias("sessions_started"),
    )
    return out.withColumns({"useful_click_rate": fn.safe_ratio(F.col("useful_clicks"), F.col("clicks")), "dead_click_rate": fn.safe_ratio(F.col("dead_clicks"), F.col("clicks"))})


def page_behavior(rows: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """Per day and page: views (all behavioural events with a URL), actors, sessions, clicks, scrolls, carts, checkouts.

    Distinct counts are per raw path and then added over paths that normalise alike, and the mean scroll is weighted by rows;
    ``exact_distinct`` counts each actor and session once a page instead. Sums are of whole numbers (scroll in millionths, means of raw paths in
    billionths), so that no order of partitions shows in the result.
    """
    day = F.to_date("occurred_at").alias(DAY)
    seen = rows.filter((F.col("event_name") != "click") & (F.col("url") != ""))
    # a session has one actor at most, so what is counted by session is added up, and no row is multiplied for several distinct counts
    each = seen.groupBy(day, fn.raw_path(F.col("url")).alias("raw"), "session_id").agg(
        F.count("*").alias("page_views"), F.max("actor_id").alias("actor_id"), F.sum(F.round(F.col("scroll_percent") * 1e6).cast("long")).alias("millionths"), F.count("scroll_percent").alias("with_scroll"), F.max("scroll_percent").alias("most"),
        F.count_if(F.col("event_name") == "product_added_to_cart").alias("atc"), F.count_if(F.col("event_name") == "checkout_started").alias("checkout"),
    )
    raw = each.groupBy(DAY, "raw").agg(
        *[F.sum(c).alias(c) for c in ("page_views", "millionths", "with_scroll", "atc", "checkout")], F.countDistinct("actor_id").alias("actors"), F.count("session_id").alias("sessions"), F.max("most").alias("most")
    )
    page = fn.page_path(F.col("raw")).alias("page_path")
    mean = F.floor(F.col("millionths").cast("double") / F.col("with_scroll") * 1000 + 0.5).cast("decimal(18,0)")  # exact whole numbers in, one rounding
    weight = F.when(F.col("with_scroll") > 0, F.col("page_views").cast("decimal(18,0)"))
    views = raw.groupBy(DAY, page).agg(
        F.sum("page_views").alias("page_views"), F.sum("actors").alias("unique_actors"), F.sum("sessions").alias("unique_sessions"),
        fn.rounded(F.sum(F.when(F.col("with_scroll") > 0, mean * weight)).cast("double") / F.sum(weight).cast("double") / 1e9, 2).alias("avg_scroll_percent"), F.max("most").alias("max_scroll_percent"),
        F.sum("atc").alias("add_to_cart_events"), F.sum("checkout").alias("checkout_started_events"),
    )
    if exact_distinct:
        true = seen.groupBy(day, fn.page_path(F.col("url")).alias("page_path")).agg(F.countDistinct("actor_id").alias("unique_actors"), F.countDistinct("session_id").alias("unique_sessions"))
        views = views.drop("unique_actors", "unique_sessions").join(true, [DAY, "page_path"])
    clicks = rows.filter("event_name = 'click'").groupBy(day, fn.page_path(fn.raw_path(F.col("url"))).alias("page_path")).agg(
        F.count("*").alias("clicks"), F.count_if(F.col("click_bucket") == "useful_click").alias("useful_clicks"), F.count_if(F.col("click_bucket") == "dead_click").alias("dead_clicks")
    )
    out = views.join(clicks, [DAY, "page_path"], "full_outer")
    counts = [c for c in out.columns if c not in (DAY, "page_path", "avg_scroll_percent", "max_scroll_percent")]
    return out.fillna(0, counts).withColumn("dead_click_rate", fn.safe_ratio(F.col("dead_clicks"), F.col("clicks")))


def click_behavior(rows: DataFrame) -> DataFrame:
    """Per day, page and click target, with the target's cleaned fields."""
    e = lambda name: F.col("element")[name]
    target = fn.click_target(e("tag"), e("element_id"), e("element_name"), e("element_type"), e("href"), e("value"))
    clicks = rows.filter("event_name = 'click'").select(F.to_date("occurred_at").alias(DAY), fn.page_path(fn.raw_path(F.col("url"))).alias("page_path"), target.alias("t"), "click_bucket", "actor_id").select("*", "t.*")
    fields = ["tag", "element_id", "element_name", "element_type", "href", "value"]
    return clicks.groupBy(DAY, "page_path", "target_hash").agg(
        *[F.min(f).alias(f) for f in fields],  # equal inside a hash
        F.count("*").alias("clicks"), F.count_if(F.col("click_bucket") == "useful_click").alias("useful_clicks"), F.count_if(F.col("click_bucket") == "dead_click").alias("dead_clicks"), F.countDistinct("actor_id").alias("unique_actors"),
    )


def _product_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per key and product: single-product events grouped on the raw id and then on the cleaned one, carts exploded."""
    day = F.to_date("occurred_at").alias(DAY)
    names = keys
    title = F.min(F.nullif(F.trim("product_title"), F.lit(""))).alias("title")  # the smallest, where the reference takes any
    viewed = F.col("event_name") == "product_viewed"
    single = rows.filter((F.col("product_id") != "") & ~F.startswith("product_id", F.lit("[")))
    each = single.groupBy(day, *names, "product_id", "session_id").agg(
        F.count_if(viewed).alias("views"), F.max(F.when(viewed, F.col("actor_id"))).alias("viewer"),
        F.count_if(F.col("event_name") == "product_added_to_cart").alias("atc"), F.count_if(F.col("event_name") == "checkout_started").alias("checkouts"), title,
    )
    raw = each.groupBy(DAY, *names, "product_id").agg(
        *[F.sum(c).alias(c) for c in ("views", "atc", "checkouts")], F.countDistinct("viewer").alias("viewers"), F.count_if((F.col("views") > 0) & F.col("session_id").isNotNull()).alias("sessions"), F.min("title").alias("title")
    )
    clean = raw.withColumn("product_id", fn.product_id(F.col("product_id"))).filter("product_id <> ''")
    carts = rows.filter((F.col("event_name") == "checkout_started") & F.startswith("product_id", F.lit("[")))
    carts = carts.select(day, *names, F.inline(fn.cart_items(F.col("product_id"), F.col("product_title")))).groupBy(DAY, *names, "product_id").agg(F.count("*").alias("checkouts"), title)
    return clean.unionByName(carts, allowMissingColumns=True)


def _product_sums(counts: DataFrame, keys: list[str]) -> DataFrame:
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    return counts.groupBy(DAY, *keys, "product_id").agg(total("views", "product_views"), total("viewers", "unique_viewers"), total("sessions", "unique_sessions"), total("atc", "add_to_cart_count"), total("checkouts", "checkout_started_count"), F.min("title").alias("product_title"))


def product_behavior(rows: DataFrame) -> DataFrame:
    out = _product_sums(_product_counts(rows, []), [])
    capped = lambda c: F.least(fn.safe_ratio(F.col(c), F.col("product_views")), F.lit(99.9999))
    capped_rate = lambda c: F.when(F.col("product_views") > 0, capped(c))
    return out.withColumns({"sessions_with_product_view": F.col("unique_sessions"), "view_to_atc_rate": capped_rate("add_to_cart_count"), "view_to_checkout_rate": capped_rate("checkout_started_count")})


def behavior_level() -> Column:
    """Level of an event's session; ``s_id`` null means it has none."""
    return (
        F.when(F.col("s_id").isNull() | (F.col("s_status") == "bot"), "unclassified")
        .when((F.col("s_ms") < 5000) | ((F.col("s_clicks") == 0) & (F.col("s_scrolls") == 0)), "low")
        .when((F.col("s_clicks") > 0) & ((F.col("s_atc") > 0) | (F.col("s_checkout") > 0)), "high")
        .otherwise("medium")
    )


def with_levels(rows: DataFrame, scored: DataFrame) -> DataFrame:
    """Events left-joined to their scored session, with behaviour and score levels. AQE splits the sessions of a hot bot."""
    s = scored.select(F.col("session_id").alias("s_id"), F.col("status").alias("s_status"), F.col("session_time_spent_ms").alias("s_ms"), F.col("click_count").alias("s_clicks"), F.col("scroll_count").alias("s_scrolls"), F.col("add_to_cart_count").alias("s_atc"), F.col("checkout_started_count").alias("s_checkout"), F.col("bucket").alias("s_bucket"))
    joined = rows.join(s, rows.session_id == s.s_id, "left")
    score_level = F.when(F.col("s_status") == "scored", F.col("s_bucket")).otherwise("unclassified")
    return joined.withColumns({"behavior_level": behavior_level(), "score_level": F.coalesce(score_level, F.lit("unclassified"))})


def product_intent(rows: DataFrame, scored: DataFrame) -> DataFrame:
    """Per day, basis (behavior or score), level and product."""
    counts = _product_counts(with_levels(rows, scored), ["behavior_level", "score_level"])
    bases = F.array(F.struct(F.lit("behavior").alias("basis"), F.col("behavior_level").alias("level")), F.struct(F.lit("score").alias("basis"), F.col("score_level").alias("level")))
    return _product_sums(counts.withColumn("b", F.explode(bases)).select("*", "b.basis", "b.level"), ["basis", "level"])


def path_daily(sessions: DataFrame) -> DataFrame:
    """Per day and collapsed event path."""
    path = fn.sequence_path(F.col("names"))
    out = sessions.withColumn("sequence", path).groupBy(F.to_date("session_start").alias(DAY), F.sha1("sequence").alias("sequence_hash"), "sequence").agg(
        F.count("*").alias("session_count"), F.countDistinct("identity").alias("unique_actor_count"), F.count_if(F.col("add_to_cart_count") > 0).alias("sessions_with_atc"), F.count_if(F.col("checkout_started_count") > 0).alias("sessions_with_checkout")
    )
    return out.withColumns({"conversion_to_atc": fn.safe_ratio(F.col("sessions_with_atc"), F.col("session_count")), "conversion_to_checkout": fn.safe_ratio(F.col("sessions_with_checkout"), F.col("session_count")), "first_event": F.left(F.substring_index("sequence", ">", 1), F.lit(100))})


def heatmap(rows: DataFrame, scored: DataFrame) -> DataFrame:
    """Per day, page and device: page views, sessions, and sessions at each behaviour level, added over raw paths."""
    seen = with_levels(rows.filter((F.col("event_name") == "page_viewed") & (F.col("url") != "")), scored)
    keys = [F.to_date("occurred_at").alias(DAY), fn.raw_path(F.col("url")).alias("raw"), fn.device(F.col("user_agent")).alias("device_type")]
    each = seen.groupBy(*keys, "session_id").agg(F.count("*").alias("page_views"), F.max("behavior_level").alias("level"))  # a session has one level
    at = lambda level: F.count_if(F.col("session_id").isNotNull() & (F.col("level") == level)).alias(f"{level}_sessions")
    raw = each.groupBy(DAY, "raw", "device_type").agg(F.sum("page_views").alias("page_views"), F.count("session_id").alias("sessions"), at("high"), at("medium"), at("low"))
    out = raw.groupBy(DAY, fn.page_path(F.col("raw")).alias("page_path"), "device_type")
    return out.agg(*[F.sum(c).alias(c) for c in ("page_views", "sessions", "high_sessions", "medium_sessions", "low_sessions")]).filter("page_path <> '(unknown)'")


def affected_dates(changed: DataFrame, overlap_s: int = 3600, most_days: int = 31, since: str | None = None, first_run_s: int = 21_600) -> DataFrame:
    """Days to recompute: from the earliest change less the overlap to the latest, no further back than ``most_days``.

    ``since`` is the watermark of the last run (rows received at or after it, less the overlap, are changes), or "first" for a first run: the last
    ``first_run_s`` before the newest receipt.
    """
    if since == "first":
        newest = changed.agg(F.max("received_at").alias("__newest"))
        changed = changed.crossJoin(F.broadcast(newest)).filter(F.col("received_at") >= F.expr(f"__newest - INTERVAL {first_run_s} SECONDS"))  # one row
    elif since:
        changed = changed.filter(F.col("received_at") >= F.expr(f"timestamp_ntz'{since}' - INTERVAL {overlap_s} SECONDS"))
    span = changed.agg(F.max("occurred_at").alias("hi"), F.min("received_at").alias("lo")).filter("hi is not null")
    first = F.greatest(F.to_date(F.expr(f"lo - INTERVAL {overlap_s} SECONDS")), F.date_sub(F.to_date("hi"), most_days - 1))
    return span.select(F.explode(F.sequence(first, F.to_date("hi"))).alias(DAY))
