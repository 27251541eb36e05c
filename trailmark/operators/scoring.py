"""Intent scoring: enrichment, exclusions, scores of all model versions, thresholds, buckets, actors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as fn
from . import ordered

#: Fixed values of the production and candidate models: caps and weights, page modifiers, penalties, thresholds.
TERMS = (("product_view_count", 4, 11.0), ("useful_click_count", 12, 2.2), ("minutes", 6, 4.5), ("scroll_count", 8, 1.8), ("page_view_count", 6, 1.5))
STAGE_TERMS = (("product_view_count", 4, 8.0), ("page_view_count", 6, 3.0), ("useful_click_count", 12, 4.0), ("minutes", 6, 4.0), ("scroll_count", 8, 1.0))
MODIFIERS = {"checkout": 1.15, "pdp": 1.05, "collection": 0.95, "home": 0.85, "other": 0.70}
RANKED = ("other", "home", "collection", "pdp", "checkout")
#: Codes of evidence stages and of the bonuses, as they stand in result rows.
STAGE_CODES = ("stage_0_passive", "stage_1_exploration", "stage_2_strong")
BONUS_CODES = ("bonus_page_views_ge2", "bonus_product_views_ge2", "bonus_useful_clicks_ge2", "bonus_useful_clicks_ge5", "bonus_product_and_pages")
#: Thresholds where a day has too few sessions of its own.
FALLBACK = (25.0, 55.0)
MIN_SESSIONS = 500


def with_page_types(rows: DataFrame) -> DataFrame:
    """Adds ``__page_type``, the page type of page views that have a URL: computed once a row, not once in each aggregate that reads it."""
    seen = (F.col("event_name") == "page_viewed") & (F.col("url") != "")
    return rows.withColumn("__page_type", F.when(seen, fn.page_type(fn.page_path(F.col("url")))))


def enrichments() -> list[Column]:
    """Aggregates over a session's events (``with_page_types``): entry page type, rank of the best page type, user agent (from clicks if no page view has one)."""
    kind, seen = F.col("__page_type"), F.col("__page_type").isNotNull()
    rank = F.array_position(F.array(*map(F.lit, RANKED)), kind).cast("int")
    return [
        F.coalesce(F.min_by(kind, F.when(seen, F.struct("occurred_at", "seq"))), F.lit("other")).alias("entry_page_type"),
        F.coalesce(F.max(F.when(seen, rank)), F.lit(1)).alias("page_rank"),
        F.coalesce(F.max(F.when(seen, F.col("user_agent"))), F.max(F.when(F.col("event_name") == "click", F.col("user_agent")))).alias("user_agent"),
    ]


def enrichment(rows: DataFrame) -> DataFrame:
    return with_page_types(rows).groupBy("session_id").agg(*enrichments())


def deepest(rows: DataFrame) -> DataFrame:
    """Per session: deepest scroll, distinct products viewed and added. One of the extra tables that may be joined to session records."""
    of = lambda name: F.countDistinct(F.when(F.col("event_name") == name, fn.product_id(F.col("product_id"))))
    return rows.groupBy("session_id").agg(F.max("scroll_percent").alias("deepest_scroll"), of("product_viewed").alias("products_viewed"), of("product_added_to_cart").alias("products_added"))


def with_extras(sessions: DataFrame, extras: list[DataFrame]) -> DataFrame:
    """Session records with the columns of each extra table (one row a session id), null where it has none."""
    for extra in extras:
        sessions = sessions.join(extra, "session_id", "left")
    return sessions


def classified(sessions: DataFrame) -> DataFrame:
    """Adds ``status`` and ``reason``: invalid_session, then missing_duration (pending), bot, zero_signal, else scored."""
    ms = F.col("session_time_spent_ms")
    invalid = F.col("session_id").isNull() | (F.col("session_id") == "") | F.col("session_start").isNull() | F.coalesce(ms < 0, F.lit(False))
    reason = F.when(invalid, "invalid_session").when(ms.isNull(), "missing_duration").when(status() == "bot", "bot").when(status() == "zero_signal", "zero_signal")
    kind = F.when(reason.isNull(), "scored").when(reason == "missing_duration", "pending").otherwise("excluded")
    return sessions.withColumns({"status": kind, "reason": reason})


def status(minimum_ms: int = 1000) -> Column:
    zero = (F.col("event_count") <= 1) & (F.col("session_time_spent_ms") < minimum_ms) & (F.col("click_count") == 0) & (F.col("scroll_count") == 0)
    return F.when(F.col("session_time_spent_ms").isNull(), "pending").when(fn.is_bot(F.col("user_agent")), "bot").when(zero, "zero_signal").otherwise("scored")


def stage() -> Column:
    """How much evidence a session holds: 0 passive, 1 exploring, 2 strong."""
    pv, pages, useful, scrolls, ms = (F.col(c) for c in ("product_view_count", "page_view_count", "useful_click_count", "scroll_count", "session_time_spent_ms"))
    strong = ((pv >= 2) & (pages >= 2)) | (useful >= 2) | (scrolls >= 2) | (ms >= 30000)
    some = (pv >= 2) | (pages >= 2) | (useful >= 1) | (scrolls >= 1) | (ms >= 10000)
    return F.when(strong, 2).when(some, 1).otherwise(0)


@dataclass(frozen=True)
class Version:
    """A scoring model as column expressions; register one to have it evaluated beside the others."""

    name: str
    terms: tuple = TERMS
    bounce: tuple[float, float] = (-20.0, -20.0)  # short in events and in time, in either
    struggle: float = -12.0
    bonuses: bool = False
    eligible_thresholds: bool = False
    floor: bool = True  # stage 0 is always low
    high_from_stage: int = 0
    modifiers: tuple = tuple(MODIFIERS.items())
    zero_if_bounced: bool = False  # a bounce by all its limits scores 0
    percentiles_of: str = "positive"  # or "all_eligible", zeros included
    labelled: bool = False  # codes name the stage and the bonuses

    def raw(self) -> Column:
        value = {"minutes": F.col("session_time_spent_ms") / 60000.0}
        raw = sum((F.least(value.get(c, F.col(c)).cast("double"), F.lit(float(cap))) * w for c, cap, w in self.terms), F.lit(0.0))
        if self.bonuses:
            pv, pages, useful = F.col("product_view_count"), F.col("page_view_count"), F.col("useful_click_count")
            raw = raw + 5.0 * sum((c.cast("int") for c in (pages >= 2, pv >= 2, useful >= 2, useful >= 5, (pv >= 2) & (pages >= 2))), F.lit(0))
        return raw

    def bounce_part(self) -> Column:
        few, brief = F.col("event_count") <= 2, F.col("session_time_spent_ms") < 5000
        return F.when(few & brief, self.bounce[0]).when(few | brief, self.bounce[1]).otherwise(0.0)

    def struggle_part(self) -> Column:
        return F.when(stuck(), self.struggle).otherwise(0.0)

    def modifier(self) -> Column:
        return F.element_at(F.array(*[F.lit(dict(self.modifiers)[t]) for t in RANKED]), F.col("page_rank"))

    def score(self) -> Column:
        value = fn.rounded(F.greatest(F.lit(0.0), F.least((self.raw() + self.struggle_part() + self.bounce_part()) * self.modifier(), F.lit(100.0))), 2)
        if self.zero_if_bounced:
            bounced = (F.col("event_count") <= 2) & (F.col("session_time_spent_ms") < 5000) & (F.col("useful_click_count") == 0) & (F.col("scroll_count") == 0)
            value = F.when(bounced, 0.0).otherwise(value)
        return value

    def broken(self) -> Column:
        """Why a session has no score of this version: the inputs it lacks; null if it has all."""
        value = {"minutes": F.col("session_time_spent_ms")}
        lacking = F.concat_ws(", ", *[F.when(value.get(c, F.col(c)).isNull() | F.isnan(value.get(c, F.col(c)).cast("double")), c) for c, _, _ in self.terms])
        return F.when(lacking != "", F.concat(F.lit("missing: "), lacking))

    def codes(self) -> Column:
        """What moved the score, joined by ``|``."""
        pv, pages, useful = F.col("product_view_count"), F.col("page_view_count"), F.col("useful_click_count")
        own = [F.element_at(F.array(*map(F.lit, STAGE_CODES)), F.col("stage") + 1)] if self.labelled else []
        hits = (pages >= 2, pv >= 2, useful >= 2, useful >= 5, (pv >= 2) & (pages >= 2))
        bonuses = [F.when(hit, code) for code, hit in zip(BONUS_CODES, hits, strict=True)] if self.labelled and self.bonuses else []
        bounce = "bounce_penalty" if self.bounce[0] == self.bounce[1] else "bounce_adjustment"
        page = F.element_at(F.array(*map(F.lit, RANKED)), F.col("page_rank"))
        return F.concat_ws("|", *own, *bonuses, F.when(self.struggle_part() < 0, "struggle_penalty"), F.when(self.bounce_part() < 0, bounce), F.concat(F.lit("page_modifier_"), page))

    def components(self) -> Column:
        """Score, its parts and the codes of what moved it."""
        page = F.element_at(F.array(*map(F.lit, RANKED)), F.col("page_rank"))
        codes = F.concat_ws("|", F.when(self.struggle_part() < 0, "struggle_penalty"), F.when(self.bounce_part() < 0, "bounce_penalty"), F.concat(F.lit("page_modifier_"), page))
        return F.struct(self.score().alias("score"), self.raw().alias("raw_score"), self.struggle_part().alias("struggle_penalty"), self.bounce_part().alias("bounce_penalty"), self.modifier().alias("modifier"), page.alias("page_type"), codes.alias("reason_codes"))


def stuck() -> Column:
    """Ten clicks or more, dead ones above the day's 90th percentile."""
    return F.coalesce((F.col("click_count") >= 10) & (F.col("dead_click_count") / F.nullif(F.col("click_count"), F.lit(0)) > F.col("p90")), F.lit(False))


VERSIONS = {
    v.name: v
    for v in (
        Version("V1", floor=False),
        Version("V2", bounce=(-5.0, -2.0), labelled=True),
        Version("V3", STAGE_TERMS, (-2.0, -1.0), 0.0, True, labelled=True),
        Version("V4", bounce=(-5.0, -2.0), eligible_thresholds=True, labelled=True),
        Version("V5", STAGE_TERMS, (-2.0, -1.0), 0.0, True, True, True, 2, labelled=True),
        Version("V1C", eligible_thresholds=True, high_from_stage=2),
        Version("V6", bounce=(-5.0, -2.0), eligible_thresholds=True, high_from_stage=2),
    )
}


#: Page modifiers of the replay variants D and F.
REVISED = (("checkout", 1.15), ("pdp", 1.05), ("collection", 1.00), ("home", 0.95), ("other", 0.90))
#: Replay variants of the production model: without or with another bounce rule, other modifiers, thresholds over all eligible sessions.
REPLAYS = {
    v.name: v
    for v in (
        Version("A", floor=False),
        Version("B", floor=False, bounce=(0.0, 0.0)),
        Version("C", floor=False, bounce=(0.0, 0.0), zero_if_bounced=True),
        Version("D", floor=False, modifiers=REVISED),
        Version("E", floor=False, percentiles_of="all_eligible"),
        Version("F", floor=False, bounce=(0.0, 0.0), zero_if_bounced=True, modifiers=REVISED, percentiles_of="all_eligible"),
        Version("F2", floor=False, bounce=(0.0, 0.0), zero_if_bounced=True, modifiers=REVISED),
    )
}


def register_version(version: Version) -> None:
    VERSIONS[version.name] = version


def nearest_ranks(rows: DataFrame, key: str, value: Column, cuts: dict[str, tuple[float, Column | None]], many: bool = False) -> DataFrame:
    """Per ``key``: ``n`` values, and for each cut (p, condition or none) the element at ``round_half_even(p * (n - 1))`` of the sorted values with that condition.

    Equal values are counted first, and running counts go over the distinct values only, so that no group of rows is held in one place. Nulls do not count.
    ``many``: a group may have any number of distinct values (durations; scores have 10,001), and these are dealt over tasks by ranges (``ordered.running``).
    """
    whole = F.lit(True)
    counts = rows.groupBy(key, value.alias("__value")).agg(F.count(value).alias("__n"), *[F.count(F.when(whole if c is None else c, value)).alias(f"__of_{name}") for name, (_, c) in cuts.items()])
    if many:
        sums = ordered.running(counts, [key], ["__value"], {f"__upto_{name}": F.col(f"__of_{name}") for name in cuts})
    else:
        group = Window.partitionBy(key)
        upto = group.orderBy("__value").rowsBetween(Window.unboundedPreceding, 0)
        sums = counts.select("*", *[F.sum(f"__of_{name}").over(upto).alias(f"__upto_{name}") for name in cuts], *[F.sum(f"__of_{name}").over(group).alias(f"__upto_{name}_all") for name in cuts])
    ranked = sums.select(key, "__value", "__n", *[((F.col(f"__of_{name}") > 0) & (F.col(f"__upto_{name}") > F.bround(p * (F.col(f"__upto_{name}_all") - 1), 0))).alias(f"__past_{name}") for name, (p, _) in cuts.items()])
    return ranked.groupBy(key).agg(F.sum("__n").alias("n"), *[F.min(F.when(F.col(f"__past_{name}"), F.col("__value"))).alias(name) for name in cuts])


def dead_click_p90(sessions: DataFrame) -> DataFrame:
    """Per day, the nearest-rank 90th percentile of dead-click rates over sessions with ten clicks or more."""
    busy = sessions.filter("click_count >= 10").withColumn("day", F.to_date("session_start"))
    return nearest_ranks(busy, "day", F.col("dead_click_count") / F.col("click_count"), {"p90": (0.9, None)}).select("day", "p90")


def scored_sessions(facts: DataFrame) -> DataFrame:
    """Session facts (counters and enrichment) with status, evidence stage, their day's P90 and the production score (null unless scored)."""
    rich = facts.withColumn("day", F.to_date("session_start"))
    rich = rich.join(F.broadcast(dead_click_p90(facts)), "day", "left")  # a row per day
    rich = rich.withColumns({"status": status(), "stage": stage()})
    return rich.withColumn("score", F.when(F.col("status") == "scored", VERSIONS["V1"].score()))


def calibration(scored: DataFrame, minimum: int = MIN_SESSIONS, score: str = "score") -> DataFrame:
    """Per day: P35 and P72 of positive scores with evidence, or the fixed fallback below ``minimum`` of them."""
    able = scored.filter((F.col("status") == "scored") & (F.col("stage") >= 1) & (F.col(score) > 0))
    days = scored.filter("status = 'scored'").groupBy("day").agg(F.count("*").alias("scored"))
    cuts = nearest_ranks(able, "day", F.col(score), {"a": (0.35, None), "b": (0.72, None)})
    rates = dead_click_p90(scored)
    out = days.join(cuts, "day", "left").join(rates, "day", "left").withColumn("own", F.coalesce("n", F.lit(0)) >= minimum)
    return out.select("day", "scored", F.coalesce("n", F.lit(0)).alias("population"), F.when(F.col("own"), F.col("a")).otherwise(FALLBACK[0]).alias("p35"), F.when(F.col("own"), F.col("b")).otherwise(FALLBACK[1]).alias("p72"), "p90", F.when(F.col("own"), "percentile").otherwise("fixed_fallback").alias("basis"))


def thresholds_as_of(days: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Backward as-of: each day gets the newest thresholds at or before it, else the constants and no P90. A row whose P90 is null is not passed over for an older one.

    Merge by order instead of a range join: both sides are put in one sequence and the last thresholds seen are carried on. There is one row per date.
    """
    marks = thresholds.select("day", F.struct("day", "p35", "p72", "p90").alias("t"), F.lit(0).alias("side"))
    asked = days.select("day", F.lit(None).cast(marks.schema["t"].dataType).alias("t"), F.lit(1).alias("side"))
    order = Window.orderBy("day", "side").rowsBetween(Window.unboundedPreceding, 0)
    carried = marks.unionByName(asked).withColumn("t", F.last("t", ignorenulls=True).over(order)).filter("side = 1")
    return carried.select("day", F.col("t.day").alias("from_day"), F.coalesce("t.p35", F.lit(FALLBACK[0])).alias("p35"), F.coalesce("t.p72", F.lit(FALLBACK[1])).alias("p72"), F.col("t.p90").alias("p90"))


def bucket(score: Column, floor: bool = True, high_from_stage: int = 2) -> Column:
    low = (score <= 0) | (score < F.col("p35"))
    if floor:
        low = low | (F.col("stage") == 0)
    return F.when(low, "low").when((score < F.col("p72")) | (F.col("stage") < high_from_stage), "medium").otherwise("high")


def with_buckets(scored: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Scored sessions with ``bucket`` and ``operational_bucket`` (cart, checkout or a checkout landing are always high)."""
    days = thresholds_as_of(scored.select("day").distinct(), thresholds).drop("p90")
    out = scored.join(F.broadcast(days), "day", "left")  # a row per day
    sure = (F.col("entry_page_type") == "checkout") | (F.col("checkout_started_count") > 0) | (F.col("add_to_cart_count") > 0)
    out = out.withColumn("bucket", F.when(F.col("status") == "scored", bucket(F.col("score"))))
    return out.withColumn("operational_bucket", F.when(F.col("status") == "scored", F.when(sure, "high").otherwise(F.col("bucket"))))


def actors(bucketed: DataFrame) -> DataFrame:
    """Each actor's best scored session (ties to the smaller session id) and how many were scored; none: nulls."""
    scored = F.when(F.col("status") == "scored", F.struct((-F.col("score")).alias("order"), "session_id", "score", "bucket"))
    found = bucketed.groupBy("identity").agg(F.min(scored).alias("best"), F.count(scored).alias("scored_sessions"))
    return found.select("identity", F.col("best.session_id").alias("best_session"), F.col("best.score").alias("best_score"), F.col("best.bucket").alias("best_bucket"), "scored_sessions")


def touched_actors(pages: list[DataFrame]) -> DataFrame:
    """The actors of all given sets of sessions, scored and excluded alike, once each."""
    found = pages[0].select("identity")
    for page in pages[1:]:
        found = found.union(page.select("identity"))
    return found.distinct()


def scoring_window(sessions: DataFrame, watermark: str, now: str, changed: str = "session_end", overlap_s: int = 3600, lookback_days: int = 3) -> DataFrame:
    """Sessions to score: changed from an hour before the watermark up to now, and those of the last days that are still pending."""
    at, end = F.col(changed), F.lit(now).cast("timestamp_ntz")
    fresh = (at >= F.expr(f"timestamp_ntz'{watermark}' - INTERVAL {overlap_s} SECONDS")) & (at < end)
    waiting = (F.col("status") == "pending") & (F.col("session_start") >= F.expr(f"timestamp_ntz'{now}' - INTERVAL {lookback_days} DAYS")) & (at < end)
    return sessions.filter(fresh | waiting)
