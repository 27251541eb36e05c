"""Diagnostic reports over one set of sessions and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as fn


def reconciliation(bucketed: DataFrame) -> DataFrame:
    return bucketed.groupBy("status").agg(F.count("*").alias("sessions"), F.countDistinct("session_id").alias("distinct_sessions"), F.countDistinct("identity").alias("actors"), F.sum("event_count").alias("events"))


def level_split(bucketed: DataFrame) -> DataFrame:
    """Behaviour levels by the rollup rule and by the report's older rule, in which a product view also makes high."""
    low = (F.col("session_time_spent_ms") < 5000) | ((F.col("click_count") == 0) & (F.col("scroll_count") == 0))
    cart = (F.col("add_to_cart_count") > 0) | (F.col("checkout_started_count") > 0)
    rule = F.when(F.col("status") == "bot", "unclassified").when(low, "low").when((F.col("click_count") > 0) & cart, "high").otherwise("medium")
    older = F.when(F.col("status") == "bot", "bot").when(low, "low").when((F.col("click_count") > 0) & (cart | (F.col("product_view_count") > 0)), "high").otherwise("medium")
    return bucketed.groupBy(rule.alias("level"), older.alias("report_level")).agg(F.count("*").alias("sessions"))


def histogram(bucketed: DataFrame, width: int = 10) -> DataFrame:
    """Scores in inclusive ranges, empty ones too."""
    bins = bucketed.sparkSession.range(100 // width).select(F.col("id").alias("bin"))
    own = F.least(F.floor(F.col("score") / width), F.lit(100 // width - 1))
    counts = bucketed.filter("status = 'scored'").groupBy(own.alias("bin")).agg(F.count("*").alias("n"))
    return bins.join(counts, "bin", "left").fillna(0, ["n"])


def score_frequency(bucketed: DataFrame) -> DataFrame:
    """Frequency of each score with its running share, most frequent first. There is one row per score of two decimals here: 10,001 at most."""
    counts = bucketed.filter("status = 'scored'").groupBy("score").agg(F.count("*").alias("n"))
    order = Window.orderBy(F.col("n").desc(), "score").rowsBetween(Window.unboundedPreceding, 0)
    return counts.select("score", "n", fn.safe_ratio(F.sum("n").over(order), F.sum("n").over(Window.partitionBy())).alias("running_share"))


def feature_rollup(bucketed: DataFrame) -> DataFrame:
    """Features by bucket with a grand total."""
    rows = bucketed.filter("status = 'scored'").rollup("bucket")
    out = rows.agg(F.count("*").alias("n"), *[fn.rounded(F.avg(c), 4).alias(c) for c in ("event_count", "page_view_count", "product_view_count", "click_count", "useful_click_count", "dead_click_count", "scroll_count")], F.grouping("bucket").alias("g"))
    return out.withColumn("bucket", F.when(F.col("g") == 1, "all").otherwise(F.col("bucket"))).drop("g")


def engagement_cohorts(bucketed: DataFrame) -> DataFrame:
    """Overlapping cohorts, each session in all it belongs to."""
    cohorts = {"any_click": F.col("click_count") > 0, "useful_click": F.col("useful_click_count") > 0, "scrolled": F.col("scroll_count") > 0, "two_pages": F.col("page_view_count") >= 2, "product": F.col("product_view_count") > 0, "bounce": (F.col("event_count") <= 2) | (F.col("session_time_spent_ms") < 5000)}
    of = F.explode(F.array_compact(F.array(*[F.when(c, k) for k, c in cohorts.items()])))
    rows = bucketed.filter("status <> 'bot'").withColumn("cohort", of)
    out = rows.groupBy("cohort").agg(F.count("*").alias("n"), F.count_if(F.col("add_to_cart_count") > 0).alias("atc"), F.count_if(F.col("checkout_started_count") > 0).alias("checkout"))
    return out.withColumn("atc_share", fn.safe_ratio(F.col("atc"), F.col("n")))


def bounce_top(bucketed: DataFrame, k: int = 10) -> DataFrame:
    keys = ["page_view_count", "product_view_count", "click_count", "scroll_count", "add_to_cart_count", "checkout_started_count"]
    rows = bucketed.filter((F.col("event_count") <= 2) | (F.col("session_time_spent_ms") < 5000))
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), *keys).limit(k)


def page_types(bucketed: DataFrame) -> DataFrame:
    return bucketed.filter("status = 'scored'").groupBy("entry_page_type").agg(F.count("*").alias("n"), F.count_if(F.col("bucket") != F.col("operational_bucket")).alias("overridden"), F.count_if(F.col("operational_bucket") == "high").alias("operational_high"))


def view_duplication(rows: DataFrame) -> DataFrame:
    """Product views repeated in a session: how many (session, product) pairs, extra views, and those within five seconds."""
    views = rows.filter("event_name = 'product_viewed' and product_id is not null")
    pairs = views.groupBy("session_id", "product_id").agg(F.count("*").alias("n"), F.expr("timestampdiff(SECOND, min(occurred_at), max(occurred_at))").alias("span")).filter("n > 1")
    return pairs.agg(F.count("*").alias("pairs"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_views"), F.count_if(F.col("span") <= 5).alias("rapid"))


def event_census(rows: DataFrame) -> DataFrame:
    return rows.groupBy("event_name").agg(F.count("*").alias("events"), F.countDistinct("session_id").alias("sessions"), F.countDistinct("actor_id").alias("actors"), F.count("scroll_percent").alias("with_percent"))


def backlog(swept: DataFrame) -> DataFrame:
    return swept.groupBy(F.to_date("session_start").alias("day")).agg(F.count("*").alias("sessions"), F.count_if(~F.col("closed")).alias("open"))


def sessions_without_events(sessions: DataFrame, rows: DataFrame) -> DataFrame:
    """Per day, sessions none of whose events is behavioural (all clicks)."""
    seen = rows.filter("event_name <> 'click'").select("session_id").distinct()
    return sessions.join(seen, "session_id", "left_anti").groupBy(F.to_date("session_start").alias("day")).agg(F.count("*").alias("sessions"))


def dead_clicks(bucketed: DataFrame) -> DataFrame:
    rate = F.col("dead_click_count") / F.nullif(F.col("click_count"), F.lit(0))
    band = F.when(rate.isNull(), "none").when(rate == 0, "zero").when(rate <= 0.5, "up_to_half").when(rate < 1, "most").otherwise("all")
    return bucketed.groupBy(band.alias("band")).agg(F.count("*").alias("sessions"), F.sum("click_count").alias("clicks"), F.sum("dead_click_count").alias("dead"))


def health(bucketed: DataFrame, rows: DataFrame) -> DataFrame:
    """Carts without browsing, sessions the score cannot see, and duplicate ids, in one row."""
    browse = (F.col("page_view_count") == 0) & (F.col("product_view_count") == 0)
    cart = (F.col("add_to_cart_count") > 0) | (F.col("checkout_started_count") > 0)
    a = bucketed.agg(F.count_if(browse & cart).alias("carts_without_browsing"), F.count_if((F.col("score") <= 0) & cart).alias("score_blind"), (F.count("session_id") - F.countDistinct("session_id")).alias("duplicate_sessions"))
    return a.crossJoin(rows.agg((F.count("event_id") - F.countDistinct("event_id")).alias("duplicate_events")))  # one row each


BOUNCED = "(event_count <= 2 or session_time_spent_ms < 5000)"
#: Order of buckets in reports: high first.
FIELD = ("high", "medium", "low")


def field_order(c: Column) -> Column:
    """A value's place in the reports' order of buckets, from 1; 0 for others."""
    return F.array_position(F.array(*map(F.lit, FIELD)), c).cast("int")


def why_low(bucketed: DataFrame) -> DataFrame:
    """Sessions of low behaviour by cause, of medium by what they lack for high, of high by what made them so, each in the reports' order."""
    ms, clicks = F.col("session_time_spent_ms"), F.col("click_count")
    brief, still = ms < 5000, (clicks == 0) & (F.col("scroll_count") == 0)
    cart, checkout = F.col("add_to_cart_count") > 0, F.col("checkout_started_count") > 0
    level = F.when(F.col("status") == "bot", "unclassified").when(brief | still, "low").when((clicks > 0) & (cart | checkout), "high").otherwise("medium")
    low = F.when(brief & still, "short and no engagement").when(brief, "short").otherwise("no engagement")
    medium = F.when((clicks == 0) & (cart | checkout), "no click").when(clicks == 0, "scroll only").otherwise("no cart or checkout")
    high = F.when(cart & checkout, "cart and checkout").when(cart, "cart").otherwise("checkout")
    rows = bucketed.select(level.alias("level"), F.when(level == "low", low).when(level == "medium", medium).when(level == "high", high).otherwise("bot").alias("cause"))
    return rows.groupBy("level", "cause").agg(F.count("*").alias("sessions"), F.max(field_order(F.col("level"))).alias("place"))


def score_percentiles(bucketed: DataFrame) -> DataFrame:
    """Of all scored sessions: extremes, mean, true median, nearest ranks, how many scores differ, the commonest and its count, in one row."""
    from . import scoring

    rows = bucketed.filter("status = 'scored'").withColumn("all", F.lit(1))
    counts = rows.groupBy("score").agg(F.count("*").alias("c"))  # 10,001 scores at most
    whole, upto = Window.partitionBy(), Window.orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumns({"n": F.sum("c").over(whole), "upto": F.sum("c").over(upto)})
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col("score")))
    one = ranked.agg(F.sum("c").alias("scored"), F.min("score").alias("least"), F.max("score").alias("most"), ((at(F.floor((F.col("n") - 1) / 2)) + at(F.floor(F.col("n") / 2))) / 2).alias("median"), F.count("*").alias("distinct_scores"), F.max(F.struct("c", (-F.col("score")).alias("s"))).alias("top"))
    near = scoring.nearest_ranks(rows, "all", F.col("score"), {f"p{p}": (p / 100, None) for p in (10, 25, 35, 50, 72, 75, 90, 95)}).drop("all", "n")
    return one.select("scored", "least", "most", "median", "distinct_scores", (-F.col("top.s")).alias("mode"), F.col("top.c").alias("mode_count")).crossJoin(near)  # one row each


def buckets(bucketed: DataFrame, actors: DataFrame) -> DataFrame:
    """Sessions by predictive and by operational bucket, and visitors by their best session's, one table."""
    rows = bucketed.filter("status = 'scored'")
    part = lambda df, kind, c: df.groupBy(F.coalesce(c, F.lit("(null)")).alias("bucket")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "bucket", "n")
    return part(rows, "predictive", "bucket").unionByName(part(rows, "operational", "operational_bucket")).unionByName(part(actors, "visitor", "best_bucket"))


def cohorts(bucketed: DataFrame) -> DataFrame:
    """Overlapping cohorts of scored sessions: size, mean score, bucket mix. Each is counted in one pass."""
    product, cart, checkout = (F.col(c) > 0 for c in ("product_view_count", "add_to_cart_count", "checkout_started_count"))
    bounced = F.expr(BOUNCED)
    only = (F.col("click_count") == 0) & (F.col("scroll_count") == 0) & ~product & ~cart & ~checkout
    # fixed values: the cohorts' names
    kinds = {"with product views": product, "without product views": ~product, "with add to cart": cart, "with checkout started": checkout, "page views only": only, "bounced": bounced, "not bounced": ~bounced}
    of = F.explode(F.array_compact(F.array(*[F.when(c, k) for k, c in kinds.items()])))
    rows = bucketed.filter("status = 'scored'").withColumn("cohort", of)
    return rows.groupBy("cohort").agg(F.count("*").alias("sessions"), _mean("score").alias("avg_score"), *[F.count_if(F.col("bucket") == b).alias(b) for b in FIELD])


def _mean(score: str) -> Column:
    """The mean of scores with two decimals, from a whole sum of hundredths."""
    return fn.rounded(F.sum(F.round(F.col(score) * 100).cast("long")) / F.count(score) / 100.0, 4)


def features_by_bucket(bucketed: DataFrame) -> DataFrame:
    """What drives a bucket: means and shares over scored sessions, by predictive and by operational bucket, high first."""
    kinds = F.explode(F.array(F.struct(F.lit("predictive").alias("kind"), F.col("bucket").alias("of")), F.struct(F.lit("operational").alias("kind"), F.col("operational_bucket").alias("of"))))
    rows = bucketed.filter("status = 'scored'").select("*", kinds.alias("k")).groupBy("k.kind", F.col("k.of").alias("bucket"))
    means = {f"avg_{c}": fn.rounded(F.avg(c), 4) for c in ("product_view_count", "page_view_count", "scroll_count", "useful_click_count", "dead_click_count", "event_count")}
    shares = {"pct_atc": "add_to_cart_count > 0", "pct_checkout": "checkout_started_count > 0", "pct_bounced": BOUNCED}
    out = rows.agg(F.count("*").alias("sessions"), *[c.alias(k) for k, c in means.items()], fn.rounded(F.avg("session_time_spent_ms") / 1000, 4).alias("avg_seconds"), *[fn.percent(F.count_if(F.expr(c)), F.count("*")).alias(k) for k, c in shares.items()], _mean("score").alias("avg_score"))
    return out.withColumn("place", field_order(F.col("bucket")))


def bounce_rule(bucketed: DataFrame) -> DataFrame:
    few, brief = F.col("event_count") <= 2, F.col("session_time_spent_ms") < 5000
    return bucketed.filter("status = 'scored'").agg(F.count_if(few).alias("two_or_fewer_events"), F.count_if(brief).alias("under_5s"), F.count_if(few & ~brief).alias("by_event_count_only"), F.count_if(brief & ~few).alias("by_duration_only"), F.count("*").alias("scored"))


def clicks(rows: DataFrame) -> DataFrame:
    """Useful and dead clicks a day, and what has no bucket."""
    own = rows.filter("event_name = 'click'").groupBy(F.to_date("occurred_at").alias("day"))
    kind = F.col("click_bucket")
    out = own.agg(F.count("*").alias("clicks"), F.count_if(kind == "useful_click").alias("useful"), F.count_if(kind == "dead_click").alias("dead"), F.count_if(kind.isNull()).alias("unclassified"))
    return out.withColumn("dead_pct", fn.percent(F.col("dead"), F.col("clicks")))


def freshness(rows: DataFrame, sessions: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The newest receipt, its event, the newest session end and the newest day with thresholds, in one row."""
    a = rows.agg(F.max("received_at").alias("last_received"), F.max_by("event_id", F.struct("received_at", "seq")).alias("last_event"))
    b, c = sessions.agg(F.max("session_end").alias("last_session_end")), thresholds.agg(F.max("day").alias("last_threshold_day"))
    return a.crossJoin(b).crossJoin(c)  # one row each


def against_external(bucketed: DataFrame, external: dict[str, float] | None) -> DataFrame:
    """Own shares of buckets against another tool's, in percentage points; without its figures the columns are null."""
    spark = bucketed.sparkSession
    theirs = spark.createDataFrame([(b, None if external is None else float(external[b])) for b in FIELD], "bucket string, external_pct double")
    own = bucketed.filter("status = 'scored'").groupBy("bucket").agg(F.count("*").alias("sessions"), F.countDistinct("identity").alias("visitors"))
    both = theirs.join(own, "bucket", "left").fillna(0, ["sessions", "visitors"])
    out = both.withColumn("own_pct", fn.percent(F.col("sessions"), F.sum("sessions").over(Window.partitionBy())))  # three rows
    return out.withColumn("delta_pp", fn.rounded(F.col("own_pct") - F.col("external_pct"), 2))


def bounce_impact(bucketed: DataFrame) -> DataFrame:
    few, brief = F.col("event_count") <= 2, F.col("session_time_spent_ms") < 5000
    group = F.when(few & brief, "both").when(few, "events only").when(brief, "duration only").otherwise("no penalty")
    out = bucketed.filter("status = 'scored'").groupBy(group.alias("group")).agg(F.count("*").alias("sessions"), _mean("score").alias("avg_score"), fn.percent(F.count_if(F.col("score") == 0), F.count("*")).alias("zero_pct"), *[fn.percent(F.count_if(F.col("bucket") == b), F.count("*")).alias(f"{b}_pct") for b in FIELD])
    return out


def override_impact(bucketed: DataFrame) -> DataFrame:
    """What forces sessions to high, in one row."""
    forced = (F.col("operational_bucket") == "high") & (F.col("bucket") != "high")
    causes = {"with_atc": F.col("add_to_cart_count") > 0, "with_checkout": F.col("checkout_started_count") > 0, "entered_on_checkout": F.col("entry_page_type") == "checkout", "operational_high": F.col("operational_bucket") == "high", "predictive_high": F.col("bucket") == "high", "forced_high": forced}
    return bucketed.filter("status = 'scored'").agg(F.count("*").alias("scored"), *[F.count_if(c).alias(k) for k, c in causes.items()], fn.percent(F.count_if(causes["operational_high"]), F.count("*")).alias("operational_high_pct"))


def premature_closes(swept: DataFrame, timeout_s: int = 1800, grace_s: int = 60) -> DataFrame:
    """Per day: sessions, closed ones, and closed ones that were written before ``timeout_s`` had passed since their last event.

    ``written_at`` of the session rows says when; the sweep must wait ``timeout_s`` and ``grace_s``.
    """
    early = F.col("closed") & (F.col("written_at") < F.col("session_end") + F.expr(f"INTERVAL {timeout_s} SECONDS"))
    out = swept.groupBy(F.to_date("session_start").alias("day")).agg(F.count("*").alias("sessions"), F.count_if("closed").alias("closed"), F.count_if(early).alias("premature"))
    return out.withColumn("premature_pct", fn.percent(F.col("premature"), F.col("closed")))


def open_cursors(swept: DataFrame) -> DataFrame:
    """How many sessions are open and their newest event, in one row."""
    return swept.filter("not closed").agg(F.count("*").alias("open"), F.max("session_end").alias("newest"))
