"""Side-by-side evaluation of scoring versions: long results, transitions, lifts, bands, agreement, landing cohort, diagnostics."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scalars as fn
from . import scoring

#: Names of buckets; those of threshold methods stand in ``thresholds``.
BUCKETS = ("low", "medium", "high")
#: Scored sessions a version needs for percentiles that are not noisy.
ENOUGH = 500
FACTS = (
    "session_id", "identity", "day", "stage", "event_count", "page_view_count", "product_view_count", "click_count", "useful_click_count", "dead_click_count",
    "scroll_count", "session_time_spent_ms", "add_to_cart_count", "checkout_started_count", "p90",
)
CART, CHECKOUT = "add_to_cart_count > 0", "checkout_started_count > 0"


def _side_by_side(scored: DataFrame, versions: dict[str, scoring.Version]) -> DataFrame:
    """One row per scored session, all versions beside each other: ``vs``, in their order, each with score, raw score, bounce part and what its buckets go by."""
    base = scored.filter("status = 'scored'").drop("score", "bucket")
    rows = [
        F.struct(F.lit(n).alias("version"), v.score().alias("score"), v.raw().alias("raw_score"), v.bounce_part().alias("bounce"), F.lit(v.eligible_thresholds).alias("own"), F.lit(v.floor).alias("floor"), F.lit(v.high_from_stage).alias("high_from"), F.lit(v.percentiles_of == "all_eligible").alias("zeros"))
        for n, v in versions.items()
    ]
    return base.select(*FACTS, F.array(*rows).alias("vs"))


def _exploded(across: DataFrame, *more: Column) -> DataFrame:
    """One row per session and version."""
    return across.select(*FACTS, *more, F.explode("vs").alias("v")).select("*", "v.*").drop("v")


def thresholds(long: DataFrame, mode: str = "common", keys: tuple[str, ...] = ("version",), enough: int = ENOUGH) -> DataFrame:
    """Per version (or ``keys``): P35 and P72 of its own population, the method that gave them and the population's size.

    The population are positive scores (with evidence, where the version asks for it; zeros too, where it counts them). "common" takes percentiles of any
    population (``percentile_small_sample`` below ``enough``; 0 and 0 of none, ``no_engaged_sessions``); "production" takes the constants below ``enough``.
    """
    if mode not in ("common", "production"):
        raise ValueError(f"unknown threshold mode {mode!r}")
    able = ((F.col("score") > 0) | F.col("zeros")) & (~F.col("own") | (F.col("stage") >= 1))
    key = F.struct(*keys)
    cuts = scoring.nearest_ranks(long.withColumn("__key", key), "__key", F.when(able, F.col("score")), {"p35": (0.35, None), "p72": (0.72, None)}).select("__key.*", "n", "p35", "p72")
    many = F.col("n") >= enough
    if mode == "production":
        low, high = (F.when(many, F.col(c)).otherwise(v) for c, v in zip(("p35", "p72"), scoring.FALLBACK, strict=True))
        method = F.when(many, "percentile").otherwise("fixed_fallback")
    else:
        low, high = (F.coalesce(c, F.lit(0.0)) for c in ("p35", "p72"))
        method = F.when(many, "percentile").when(F.col("n") > 0, "percentile_small_sample").otherwise("no_engaged_sessions")
    return cuts.select(*keys, low.alias("p35"), high.alias("p72"), method.alias("method"), F.col("n").alias("population"))


def _buckets(v, stage: Column, p35: Column, p72: Column) -> tuple[Column, Column]:
    """The bucket of a version's score with and without the floor of its evidence."""
    plain = F.when((v["score"] <= 0) | (v["score"] < p35), "low").when(v["score"] < p72, "medium").otherwise("high")
    return F.when(v["floor"] & (stage == 0), "low").when((plain == "high") & (stage < v["high_from"]), "medium").otherwise(plain), plain


def _cuts_of_versions(cuts: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Thresholds (a row per version) as one row: ``cuts``, a map by version."""
    cut = F.struct("p35", "p72", "method", "population")
    return cuts.agg(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.max(F.when(F.col("version") == n, cut)) for n in names])).alias("cuts"))


def versions_across(scored: DataFrame, names: tuple[str, ...] = tuple(scoring.VERSIONS), mode: str = "common") -> DataFrame:
    """One row per scored session with every version's score and bucket side by side in ``vs``, by thresholds over the whole set (each its own population).

    Only stage, score and flags are unpivoted to find the thresholds, which are a few numbers a version and come back in one broadcast row; versions are
    compared inside a row, without a join.
    """
    across = _side_by_side(scored, {n: scoring.VERSIONS[n] for n in names})
    cuts = thresholds(across.select("stage", F.explode(F.transform("vs", lambda v: F.struct(*[v[c].alias(c) for c in ("version", "score", "own", "zeros")]))).alias("v")).select("stage", "v.*"), mode)
    row = _cuts_of_versions(cuts, names)
    fields = ("version", "score", "raw_score", "bounce", "own", "floor", "high_from", "zeros")

    def judged(v):
        cut = F.col("cuts")[v["version"]]
        floored, plain = _buckets(v, F.col("stage"), cut["p35"], cut["p72"])
        return F.struct(*[v[c].alias(c) for c in fields], *[cut[c].alias(c) for c in ("p35", "p72", "method", "population")], floored.alias("bucket"), plain.alias("bucket_without_floor"))

    return across.crossJoin(F.broadcast(row)).select(*FACTS, F.transform("vs", judged).alias("vs"))


def versions_long(scored: DataFrame, names: tuple[str, ...] = tuple(scoring.VERSIONS), mode: str = "common") -> DataFrame:
    """One row per scored session and version: score and bucket by thresholds over the whole set (its own percentile population)."""
    return _exploded(versions_across(scored, names, mode))


def result_rows(scored: DataFrame, everything: DataFrame, names: tuple[str, ...] = tuple(scoring.VERSIONS), known: dict[str, scoring.Version] | None = None) -> DataFrame:
    """The long result table: a row per session and version, excluded sessions and failed versions included.

    A version that is not registered gives rows with status ``error`` instead of stopping the others. Numbers are rounded to 4.
    """
    known = scoring.VERSIONS if known is None else known
    good = versions_long(scored, tuple(n for n in names if n in known))
    r4 = lambda c: fn.rounded(F.col(c).cast("double"), 4).alias(c)
    facts = ["event_count", "page_view_count", "product_view_count", "click_count", "useful_click_count", "dead_click_count", "scroll_count", "add_to_cart_count", "checkout_started_count", "session_time_spent_ms"]
    done = good.select("session_id", "identity", "day", "version", F.lit("scored").alias("status"), F.lit(None).cast("string").alias("reason"), r4("score"), r4("raw_score"), r4("bounce"), "stage", "bucket", "bucket_without_floor", r4("p35"), r4("p72"), "method", "population", *facts)
    left = everything.filter("status <> 'scored'").crossJoin(F.broadcast(scored.sparkSession.createDataFrame([(n,) for n in names if n in known], "version string")))  # a row per version
    out = left.select("session_id", "identity", "day", "version", F.lit("excluded").alias("status"), F.col("status").alias("reason"), *facts)
    bad = [n for n in names if n not in known]
    broken = scored.filter("status = 'scored'").select("session_id", "identity", "day", F.explode(F.array(*map(F.lit, bad)) if bad else F.array().cast("array<string>")).alias("version"), F.lit("error").alias("status"), F.lit("unknown version").alias("reason"), *facts)
    return done.unionByName(out, allowMissingColumns=True).unionByName(broken, allowMissingColumns=True)


#: The columns of the long result table, in their order.
RESULT = (
    "session_id", "brand_id", "session_start", "version", "score", "bucket", "operational_bucket", "status", "exclusion_reason", "error_reason", "reason_codes", "evidence_stage",
    "bucket_without_floor", "product_views", "useful_clicks", "dead_clicks", "click_count", "scrolls", "page_views", "minutes", "event_count", "add_to_cart_count",
    "checkout_started_count", "entry_page_type", "highest_page_type", "struggle_penalty", "bounce_penalty", "page_modifier", "raw_score", "p35", "p72", "p90", "threshold_method",
    "production_score", "production_bucket", "production_status", "purchased", "order_value",
)


def result_table(sessions: DataFrame, names: tuple[str, ...] = tuple(scoring.VERSIONS), outcomes: DataFrame | None = None, known: dict[str, scoring.Version] | None = None, mode: str = "common") -> DataFrame:
    """The long result table in full: a row per session and version, with the columns of ``RESULT``, numbers rounded to 4.

    ``sessions`` have facts and production's score, bucket and status. A session that is not scored is ``excluded`` or ``pending`` with its reason in every
    version; one that lacks an input of a version is an ``error`` of that version alone, and no part of its thresholds. A version that is not registered
    is a ValueError. ``outcomes`` (session_id, purchased, order_value; a row per session) are null where they are not known. All versions stand side by
    side in a row until their thresholds, a few numbers each, come back; only then are rows multiplied.
    """
    known = scoring.VERSIONS if known is None else known
    if unknown := [n for n in names if n not in known]:
        raise ValueError(f"versions that are not registered: {unknown}")
    ok = F.col("status") == "scored"
    r4 = lambda c: fn.rounded(c.cast("double"), 4)

    def outcome(v: scoring.Version) -> Column:
        parts = {"score": v.score(), "raw_score": v.raw(), "struggle_penalty": v.struggle_part(), "bounce_penalty": v.bounce_part(), "page_modifier": v.modifier(), "reason_codes": v.codes(), "evidence_stage": F.when(F.lit(v.floor), F.col("stage"))}
        flags = {"own": v.eligible_thresholds, "floor": v.floor, "high_from": v.high_from_stage, "zeros": v.percentiles_of == "all_eligible"}
        found = F.when(ok & v.broken().isNull(), F.struct(*[c.alias(k) for k, c in parts.items()]))
        return F.struct(F.lit(v.name).alias("version"), F.when(ok, v.broken()).alias("error_reason"), found.alias("of"), *[F.lit(x).alias(k) for k, x in flags.items()])

    if outcomes is None:
        sessions = sessions.withColumns({"purchased": F.lit(None).cast("boolean"), "order_value": F.lit(None).cast("double")})
    else:
        sessions = sessions.drop("purchased", "order_value").join(outcomes.select("session_id", "purchased", "order_value"), "session_id", "left")
    brand = F.col("brand_id") if "brand_id" in sessions.columns else F.lit(None).cast("string")
    kind = F.when(F.col("status").isin("scored", "pending"), F.col("status")).otherwise("excluded")
    facts = {
        "session_id": F.col("session_id"), "brand_id": brand, "session_start": F.col("session_start"), "kind": kind, "exclusion_reason": F.when(F.col("status") == "pending", "missing_duration").when(~ok, F.col("status")),
        "product_views": F.col("product_view_count"), "useful_clicks": F.col("useful_click_count"), "dead_clicks": F.col("dead_click_count"), "click_count": F.col("click_count"), "scrolls": F.col("scroll_count"),
        "page_views": F.col("page_view_count"), "minutes": r4(F.col("session_time_spent_ms") / 60000.0), "event_count": F.col("event_count"), "add_to_cart_count": F.col("add_to_cart_count"),
        "checkout_started_count": F.col("checkout_started_count"), "entry_page_type": F.col("entry_page_type"), "highest_page_type": F.element_at(F.array(*map(F.lit, scoring.RANKED)), F.col("page_rank")),
        "p90": r4(F.col("p90")), "production_score": r4(F.col("score")), "production_bucket": F.col("bucket"), "production_status": kind, "purchased": F.col("purchased"), "order_value": r4(F.col("order_value")), "stage": F.col("stage"),
    }
    across = sessions.select(*[c.alias(k) for k, c in facts.items()], F.array(*[outcome(known[n]) for n in names]).alias("vs"))
    slim = F.transform("vs", lambda v: F.struct(v["of"]["score"].alias("score"), *[v[c].alias(c) for c in ("version", "own", "zeros")]))
    cuts = thresholds(across.select("stage", F.explode(slim).alias("v")).select("stage", "v.*").filter("score is not null"), mode)
    rows = across.crossJoin(F.broadcast(_cuts_of_versions(cuts, names))).withColumn("v", F.explode("vs")).drop("vs").select("*", "v.*", "v.of.*", F.col("cuts")[F.col("v.version")].alias("cut")).drop("v", "of", "cuts")
    has = F.col("score").isNotNull()
    flags = F.struct("score", "floor", "high_from")
    floored, plain = _buckets(flags, F.col("stage"), F.col("cut.p35"), F.col("cut.p72"))
    sure = (F.col("entry_page_type") == "checkout") | (F.col("checkout_started_count") > 0) | (F.col("add_to_cart_count") > 0)
    made = {
        "bucket": F.when(has, floored), "bucket_without_floor": F.when(has, plain), "operational_bucket": F.when(has, F.when(sure, "high").otherwise(floored)), "threshold_method": F.when(has, F.col("cut.method")),
        "status": F.when(F.col("error_reason").isNotNull(), "error").otherwise(F.col("kind")), **{c: F.when(has, r4(F.col(f"cut.{c}"))) for c in ("p35", "p72")},
        **{c: r4(F.col(c)) for c in ("score", "raw_score", "struggle_penalty", "bounce_penalty", "page_modifier")},
    }
    rows = rows.withColumns(made)
    return rows.select(*RESULT)


def replays(scored: DataFrame) -> DataFrame:
    """The replay variants over the scored sessions, each day with its own thresholds and the constants below 500 of its population."""
    long = _exploded(_side_by_side(scored, scoring.REPLAYS))
    keys = ["version", "day"]
    out = long.join(F.broadcast(thresholds(long, "production", tuple(keys))), keys, "left")  # a row per version and day
    floored, plain = _buckets({c: F.col(c) for c in ("score", "floor", "high_from")}, F.col("stage"), F.col("p35"), F.col("p72"))
    return out.withColumns({"bucket": floored, "bucket_without_floor": plain})


def wide(across: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """One row per session, each version's score and bucket in columns."""
    of = F.map_from_entries(F.transform("vs", lambda v: F.struct(v["version"].alias("k"), v.alias("v"))))
    each = across.select("session_id", of.alias("of"))
    return each.select("session_id", *[F.col("of")[n][c].alias(f"{n}_{c}") for n in names for c in ("score", "bucket")])


def transitions(across: DataFrame, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Counts of all nine bucket moves between the versions of each pair (all pairs by default), zeros included, with cart and checkout counts of the movers.

    Sessions are counted by the buckets of all versions at once; pairs are taken from these few combinations.
    """
    pairs = pairs or list(combinations(scoring.VERSIONS, 2))
    of = F.transform("vs", lambda v: F.struct(v["version"].alias("version"), v["bucket"].alias("bucket")))
    kinds = across.select(of.alias("of"), "add_to_cart_count", "checkout_started_count").groupBy("of").agg(F.count("*").alias("sessions"), F.count_if(F.expr(CART)).alias("atc"), F.count_if(F.expr(CHECKOUT)).alias("checkout"))
    at = F.map_from_entries("of")
    moves = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), at[a].alias("src"), at[b].alias("dst")) for a, b in pairs]))
    counts = kinds.select(moves.alias("m"), "sessions", "atc", "checkout").groupBy("m.a", "m.b", "m.src", "m.dst").agg(*[F.sum(c).alias(c) for c in ("sessions", "atc", "checkout")])
    cells = across.sparkSession.createDataFrame([(a, b, x, y) for a, b in pairs for x in BUCKETS for y in BUCKETS], "a string, b string, src string, dst string")
    return cells.join(counts, ["a", "b", "src", "dst"], "left").fillna(0, ["sessions", "atc", "checkout"])


def _against(across: DataFrame, base: str) -> DataFrame:
    """One row per session and version with the base's score and bucket as ``s0`` and ``b0``."""
    own = F.get(F.filter("vs", lambda v: v["version"] == base), F.lit(0))
    return _exploded(across, own["score"].alias("s0"), own["bucket"].alias("b0"))


def _counted(prefix: str = "", of: Column | None = None) -> list[Column]:
    of = F.lit(True) if of is None else of
    cart, checkout = F.expr(CART), F.expr(CHECKOUT)
    return [F.count_if(of).alias(f"{prefix}n"), F.count_if(of & cart).alias(f"{prefix}atc"), F.count_if(of & checkout).alias(f"{prefix}checkout"), F.count_if(of & (cart | checkout)).alias(f"{prefix}either")]


def outcomes(groups: DataFrame, key: str | list[str]) -> DataFrame:
    """Per group: sessions; cart, checkout and either as counts, percent and lift over all groups of the same leading keys; a flag below 30 sessions."""
    keys = [key] if isinstance(key, str) else key
    sums = groups.groupBy(*keys).agg(*_counted())
    rest = Window.partitionBy(*keys[:-1])
    out = {f"{m}_rate": fn.percent(F.col(m), F.col("n")) for m in ("atc", "checkout", "either")}
    out |= {f"__all_{m}": fn.percent(F.sum(m).over(rest), F.sum("n").over(rest)) for m in ("atc", "checkout", "either")}
    rated = sums.withColumns(out)
    lifts = {f"{m}_lift": fn.rounded(F.col(f"{m}_rate") / F.nullif(F.col(f"__all_{m}"), F.lit(0.0)), 3) for m in ("atc", "checkout", "either")}
    return rated.withColumns(lifts | {"too_small": F.col("n") < 30}).drop(*[f"__all_{m}" for m in ("atc", "checkout", "either")])


def monotonic(long: DataFrame, keys: tuple[str, ...] = ("version",)) -> DataFrame:
    """Per version (or ``keys``): PASS for each outcome whose rate rises strictly from low to high with no bucket empty, and the rates."""
    at = {b: F.col("bucket") == b for b in BUCKETS}
    counts = long.groupBy(*keys).agg(*[c for b in BUCKETS for c in _counted(f"{b}_", at[b])])
    rates = {f"{b}_{m}_rate": fn.percent(F.col(f"{b}_{m}"), F.col(f"{b}_n")) for b in BUCKETS for m in ("atc", "checkout", "either")}
    out = counts.withColumns(rates)
    filled = reduce(Column.__and__, [F.col(f"{b}_n") > 0 for b in BUCKETS])
    verdict = {f"{m}_monotonic": F.when(filled & (F.col(f"low_{m}_rate") < F.col(f"medium_{m}_rate")) & (F.col(f"medium_{m}_rate") < F.col(f"high_{m}_rate")), "PASS").otherwise("FAIL") for m in ("atc", "checkout", "either")}
    return out.withColumns(verdict).select(*keys, *rates, *verdict)


def four_groups(long: DataFrame) -> DataFrame:
    """Zero scores, positive scores below P35, medium and high: each group's outcomes (a session may stand in none: a positive one floored to low)."""
    group = F.when(F.col("score") == 0, "zero_score").when(F.col("bucket") != "low", F.col("bucket")).when(F.col("score") < F.col("p35"), "positive_low")
    return outcomes(long.withColumn("group", group).filter("group is not null"), ["version", "group"])


def score_bands(long: DataFrame) -> DataFrame:
    """Equal-frequency bands of positive scores: edges are nearest-rank quintiles, a score's band counts the edges at or below it."""
    positive = long.filter("score > 0")
    edges = scoring.nearest_ranks(positive, "version", F.col("score"), {f"e{p}": (p / 100, None) for p in (20, 40, 60, 80)}).drop("n")
    band = reduce(Column.__add__, [(F.col(f"e{p}") <= F.col("score")).cast("int") for p in (20, 40, 60, 80)])
    placed = positive.join(F.broadcast(edges), "version").withColumn("band", band)  # a row per version
    return placed.groupBy("version", "band").agg(F.count("*").alias("n"), F.count_if(F.expr(CART)).alias("atc"), F.min("score").alias("lo"), F.max("score").alias("hi"))


def score_ties(long: DataFrame, k: int = 5) -> DataFrame:
    """Per version the ``k`` most common exact scores (of equal counts the smaller), their share, outcomes and buckets. A version has 10,001 scores at most."""
    counts = long.groupBy("version", "score").agg(*_counted(), *[F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS])
    rest, best = Window.partitionBy("version"), Window.partitionBy("version").orderBy(F.col("n").desc(), "score")
    ranked = counts.withColumns({"share": fn.percent(F.col("n"), F.sum("n").over(rest)), "distinct_scores": F.count("*").over(rest), "rank": F.row_number().over(best)})
    return ranked.filter(F.col("rank") <= k)


def landing_cohort(long: DataFrame) -> DataFrame:
    """Passive landings against the rest, per version: sizes, promotions above low, cart counts, and the 5 % flag."""
    landing = (F.col("page_view_count") == 1) & (F.col("product_view_count") <= 1) & (F.col("useful_click_count") == 0) & (F.col("scroll_count") == 0) & (F.col("event_count") <= 2)
    out = long.withColumn("landing", landing).groupBy("version", "landing").agg(F.count("*").alias("n"), F.count_if(F.col("bucket") != "low").alias("promoted"), F.count_if(F.expr(CART)).alias("atc"))
    return out.withColumn("failure", F.col("landing") & (F.col("promoted") * 20 > F.col("n")))


def stage_crosstab(long: DataFrame) -> DataFrame:
    return long.groupBy("version", "stage").pivot("bucket", list(BUCKETS)).count().fillna(0)


def stage_effects(long: DataFrame) -> DataFrame:
    """Per version: share of each stage, sessions the stage-0 floor put low, and the lift of stage 2 over stage 1."""
    at = {s: F.col("stage") == s for s in (0, 1, 2)}
    counts = long.groupBy("version").agg(F.count("*").alias("n"), F.count_if((F.col("bucket") == "low") & (F.col("bucket_without_floor") != "low")).alias("floored"), *[c for s in at for c in _counted(f"s{s}_", at[s])])
    rate = lambda s: fn.percent(F.col(f"s{s}_atc"), F.col(f"s{s}_n"))
    return counts.select("version", "n", "floored", *[fn.percent(F.col(f"s{s}_n"), F.col("n")).alias(f"stage{s}_share") for s in at], fn.rounded(rate(2) / F.nullif(rate(1), F.lit(0.0)), 3).alias("atc_lift_2_over_1"))


def engaged(long: DataFrame) -> DataFrame:
    """Outcomes by bucket with the passive sessions set aside: from stage 1 on and stage 2 only, with PASS or FAIL."""
    floors = F.explode(F.array(F.struct(F.lit("engaged").alias("group"), F.lit(1).alias("from_stage")), F.struct(F.lit("stage2").alias("group"), F.lit(2).alias("from_stage"))))
    rows = long.select("*", floors.alias("f")).select("*", "f.*").filter(F.col("stage") >= F.col("from_stage"))
    return monotonic(rows, ("version", "group"))


def bucket_stages(long: DataFrame) -> DataFrame:
    """Medium and high by evidence stage with their share of the bucket, and the sessions capped from high to medium as a group of its own."""
    capped = (F.col("bucket_without_floor") == "high") & (F.col("bucket") == "medium")
    kinds = F.explode(F.array_compact(F.array(F.when(F.col("bucket") != "low", F.struct(F.col("bucket").alias("group"), F.col("stage").alias("of_stage"))), F.when(capped, F.struct(F.lit("capped_from_high").alias("group"), F.lit(None).cast("int").alias("of_stage"))))))
    counts = long.select("version", "add_to_cart_count", "checkout_started_count", kinds.alias("k")).groupBy("version", "k.group", F.col("k.of_stage").alias("stage")).agg(*_counted())
    return counts.withColumn("share_of_bucket", fn.percent(F.col("n"), F.sum("n").over(Window.partitionBy("version", "group"))))


def zero_reduction(across: DataFrame, base: str = "V1") -> DataFrame:
    """How much of the base's zero scores each other version removes: recovered, new zeros, buckets of the recovered, ties, causes of what is left."""
    both = _against(across, base).filter(F.col("version") != base)
    was, now = F.col("s0") == 0, F.col("score") == 0
    recovered = was & ~now
    facts = both.groupBy("version").agg(
        F.count_if(was).alias("base_zeros"), F.count_if(now).alias("zeros"), F.count_if(recovered).alias("recovered"), F.count_if(~was & now).alias("new_zeros"),
        *[F.count_if(recovered & (F.col("bucket") == b)).alias(f"recovered_{b}") for b in BUCKETS], F.count_if(recovered & F.expr(CART)).alias("recovered_atc"),
        F.count_if(now & (F.col("raw_score") <= 0)).alias("raw_zero"), F.count_if(now & (F.col("raw_score") > 0)).alias("penalised_to_zero"), F.min(F.when(recovered, F.col("score"))).alias("recovered_min"), F.max(F.when(recovered, F.col("score"))).alias("recovered_max"),
    )
    ties = both.filter(was).groupBy("version", "score").agg(F.count("*").alias("n")).groupBy("version").agg(F.count("*").alias("distinct_scores"), F.max(F.struct("n", (-F.col("score")).alias("s"))).alias("top"))
    out = facts.join(ties.select("version", "distinct_scores", (-F.col("top.s")).alias("most_common"), F.col("top.n").alias("most_common_n")), "version", "left")
    return out.withColumns({"reduction_pct": fn.percent(F.col("base_zeros") - F.col("zeros"), F.col("base_zeros")), "recovered_pct": fn.percent(F.col("recovered"), F.col("base_zeros"))})


def agreement(across: DataFrame, base: str = "V1") -> DataFrame:
    """Per version: sessions whose bucket equals the base's, movers, greatest score difference."""
    return _against(across, base).groupBy("version").agg(F.count("*").alias("compared"), F.count_if(F.col("bucket") == F.col("b0")).alias("equal"), F.count_if(F.col("bucket") != F.col("b0")).alias("movers"), fn.rounded(F.max(F.abs(F.col("score") - F.col("s0"))), 2).alias("max_difference"))


def parity(computed: DataFrame, stored: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Computed scores and buckets against stored ones (``stored_score``, ``stored_bucket`` by session id): how many are there, equal, how far apart."""
    both = computed.join(stored, "session_id", "left")
    there, gap = F.col("stored_score").isNotNull(), F.abs(F.col("score") - F.col("stored_score"))
    return both.agg(F.count_if(there).alias("compared"), F.count_if(gap <= tolerance).alias("equal"), fn.rounded(F.max(gap), 4).alias("max_difference"), F.count_if(there & (F.col("bucket") == F.col("stored_bucket"))).alias("equal_buckets"), F.count_if(~there).alias("without_stored"))


def total_variation(long: DataFrame, base: str = "V1") -> DataFrame:
    """Half the summed differences of bucket shares between each version and the base."""
    share = lambda b, v: F.count_if((F.col("bucket") == b) & v) / F.nullif(F.count_if(v), F.lit(0))
    yes = F.lit(True)
    own = long.groupBy("version").agg(*[share(b, yes).alias(b) for b in BUCKETS])
    ref = own.filter(F.col("version") == base).select(*[F.col(b).alias(f"r_{b}") for b in BUCKETS])
    gap = sum((F.abs(F.col(b) - F.col(f"r_{b}")) for b in BUCKETS), F.lit(0.0))
    return own.crossJoin(F.broadcast(ref)).select("version", fn.rounded(0.5 * gap, 4).alias("distance"))  # one row


def zero_scores(long: DataFrame) -> DataFrame:
    """Per version: share of zero scores, carts and checkouts among them, bounce parts, raw scores above zero, and the warning above 5 % of blind checkouts."""
    zero = F.col("score") <= 0
    out = long.groupBy("version").agg(F.count("*").alias("n"), F.count_if(zero).alias("zeros"), F.count_if(zero & F.expr(CHECKOUT)).alias("blind_checkouts"), F.count_if(zero & F.expr(CART)).alias("blind_carts"), F.count_if(zero & (F.col("raw_score") > 0)).alias("raw_positive"), F.count_if(F.col("bounce") < 0).alias("bounced"), F.count_if(zero & (F.col("session_time_spent_ms") > 5000)).alias("zeros_over_5s"), F.count_if(F.expr(CHECKOUT)).alias("checkouts"))
    return out.withColumns({"zero_share": fn.percent(F.col("zeros"), F.col("n")), "blind_share_of_checkouts": fn.percent(F.col("blind_checkouts"), F.col("checkouts")), "warn": F.col("blind_checkouts") * 20 > F.col("zeros")})


def threshold_shift(long: DataFrame) -> DataFrame:
    """Per version: P35, P50, P72, P90 of all positive scores, of those with evidence and of each stage, and how far evidence moves them."""
    rows = long.filter("score > 0")
    groups = {"all": None, "eligible": F.col("stage") >= 1, "s0": F.col("stage") == 0, "s1": F.col("stage") == 1, "s2": F.col("stage") == 2}
    cuts = {f"{tag}_p{p}": (p / 100, of) for tag, of in groups.items() for p in (35, 50, 72, 90)}
    found = scoring.nearest_ranks(rows, "version", F.col("score"), cuts).drop("n")
    return found.withColumns({f"shift_p{p}": fn.rounded(F.col(f"eligible_p{p}") - F.col(f"all_p{p}"), 4) for p in (35, 50, 72, 90)})


def _band(ms: Column) -> Column:
    return F.when(ms < 1000, "under_1s").when(ms < 5000, "1_5s").when(ms < 10000, "5_10s").when(ms < 30000, "10_30s").otherwise("over_30s")


def duration_bands(long: DataFrame) -> DataFrame:
    """Duration bands over all scored sessions, those V1 scores 0, each stage and the landings; clustered: half of a group or more under a second."""
    ms = F.coalesce("session_time_spent_ms", F.lit(0))
    landing = (F.col("page_view_count") == 1) & (F.col("product_view_count") <= 1) & (F.col("useful_click_count") == 0) & (F.col("scroll_count") == 0)
    sets = {"all": F.lit(True), "v1_zero": F.col("score") == 0, "stage0": F.col("stage") == 0, "stage1": F.col("stage") == 1, "stage2": F.col("stage") == 2, "landing": landing}
    of = F.explode(F.array_compact(F.array(*[F.when(c, k) for k, c in sets.items()])))
    rows = long.filter("version = 'V1'").select("*", of.alias("group")).withColumn("band", _band(ms))
    counts = rows.groupBy("group", "band").agg(*_counted())
    rest = Window.partitionBy("group")
    return counts.withColumns({"share": fn.percent(F.col("n"), F.sum("n").over(rest)), "clustered": F.sum(F.when(F.col("band") == "under_1s", F.col("n")).otherwise(0)).over(rest) * 2 >= F.sum("n").over(rest)})


def duration_diagnostics(long: DataFrame, version: str = "V1") -> DataFrame:
    """Recorded durations of one version's sessions in seconds: extremes, nearest ranks, shares above 5 and 10 seconds, of 0 and under a second."""
    rows = long.filter(F.col("version") == version).withColumn("s", F.coalesce("session_time_spent_ms", F.lit(0)) / 1000.0)
    cuts = scoring.nearest_ranks(rows, "version", F.col("s"), {f"p{p}": (p / 100, None) for p in (25, 50, 75, 90)}, many=True).drop("n")
    part = {"over_5s": F.col("s") > 5, "over_10s": F.col("s") > 10, "exactly_0": F.col("s") == 0, "under_1s": F.col("s") < 1}
    facts = rows.groupBy("version").agg(F.count("*").alias("sessions"), F.min("s").alias("least"), F.max("s").alias("most"), *[fn.percent(F.count_if(c), F.count("*")).alias(k) for k, c in part.items()])
    return facts.join(cuts, "version")


def scroll_diagnostics(long: DataFrame, version: str = "V1") -> DataFrame:
    """Whether scrolls carry anything: sessions with any, their sum and greatest number, and the flag that there are none at all."""
    rows = long.filter(F.col("version") == version)
    return rows.agg(F.count("*").alias("sessions"), F.count_if(F.col("scroll_count") > 0).alias("with_scroll"), F.sum("scroll_count").alias("scrolls"), F.max("scroll_count").alias("most"), fn.percent(F.count_if(F.col("scroll_count") > 0), F.count("*")).alias("scroll_rate"), (F.sum("scroll_count") == 0).alias("inactive"))


def struggle_differences(long: DataFrame) -> DataFrame:
    """Per version: sessions the production struggle rule would hit, and whether the version applies it."""
    applies = F.create_map(*[F.lit(x) for n, v in scoring.VERSIONS.items() for x in (n, v.struggle < 0)])
    return long.groupBy("version").agg(F.count_if(scoring.stuck()).alias("would_fire")).withColumn("applies", F.element_at(applies, F.col("version")))


def purchases(long: DataFrame, provider: DataFrame | None) -> DataFrame:
    """Purchases by version and bucket over sessions whose outcome the provider (session_id, purchased, order_value) knows; no provider, no rows: nothing is claimed."""
    if provider is None:
        provider = long.sparkSession.createDataFrame([], "session_id string, purchased boolean, order_value double")
    known = long.join(provider, "session_id").filter("purchased is not null")
    out = known.groupBy("version", "bucket").agg(F.count("*").alias("sessions"), F.count_if("purchased").alias("purchases"), fn.rounded(F.coalesce(F.sum(F.when(F.col("purchased"), F.col("order_value"))), F.lit(0.0)), 2).alias("revenue"))
    return out.withColumns({"cvr": fn.percent(F.col("purchases"), F.col("sessions")), "avg_order_value": fn.rounded(F.col("revenue") / F.nullif(F.col("purchases"), F.lit(0)), 2)})


def composition(long: DataFrame) -> DataFrame:
    """The behaviour behind each bucket of each version: means, nearest-rank medians and outcome rates."""
    means = {"avg_score": F.col("score"), "avg_product_views": F.col("product_view_count"), "avg_useful_clicks": F.col("useful_click_count"), "avg_dead_clicks": F.col("dead_click_count"), "avg_scrolls": F.col("scroll_count"), "avg_page_views": F.col("page_view_count")}
    whole = lambda c: fn.rounded(F.sum(F.round(c * 100).cast("long")) / F.count("*") / 100.0, 4)  # noqa: E731 (scores have two decimals: whole sums)
    facts = long.groupBy("version", "bucket").agg(*_counted(), *[whole(c).alias(k) for k, c in means.items()], fn.rounded(F.sum("session_time_spent_ms") / F.count("*") / 1000.0, 3).alias("avg_duration_s"))
    key = long.withColumn("__key", F.struct("version", "bucket"))
    mids = [scoring.nearest_ranks(key, "__key", value, {name: (0.5, None)}, many).select("__key.*", name) for name, value, many in (("median_score", F.col("score"), False), ("median_duration_s", F.col("session_time_spent_ms") / 1000.0, True))]
    out = facts.join(mids[0], ["version", "bucket"]).join(mids[1], ["version", "bucket"])
    return out.select("version", "bucket", F.col("n").alias("sessions"), *means, "avg_duration_s", "median_score", "median_duration_s", *[fn.percent(F.col(m), F.col("n")).alias(f"{m}_rate") for m in ("atc", "checkout", "either")])


def percentile_summaries(long: DataFrame) -> DataFrame:
    """Three ways to sum up a version's scores: nearest ranks, the true median (the middle two's mean) and the rebuild's ranks ``int(n * p / 100)``."""
    near = scoring.nearest_ranks(long, "version", F.col("score"), {f"p{p}": (p / 100, None) for p in (25, 50, 75, 90)})
    counts = long.groupBy("version", "score").agg(F.count("*").alias("c"))  # 10,001 scores at most
    group = Window.partitionBy("version")
    ranked = counts.withColumns({"upto": F.sum("c").over(group.orderBy("score").rowsBetween(Window.unboundedPreceding, 0)), "n": F.sum("c").over(group)})
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col("score")))
    low, high = at(F.floor((F.col("n") - 1) / 2)), at(F.floor(F.col("n") / 2))
    rest = ranked.groupBy("version").agg(F.min("score").alias("least"), F.max("score").alias("most"), ((low + high) / 2).alias("median"), *[at(F.floor(F.col("n") * p / 100)).alias(f"rebuild_p{p}") for p in (50, 75, 90)])
    return near.join(rest, "version")


def distribution(replayed: DataFrame, everything: DataFrame) -> DataFrame:
    """Per variant: scored sessions by bucket with shares, zero scores, and what was excluded of all that were loaded."""
    out = replayed.groupBy("version").agg(F.count("*").alias("scored"), *[F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS], F.count_if(F.col("score") == 0).alias("zero_score"))
    lost = everything.agg(F.count("*").alias("total"), F.count_if(F.col("status") != "scored").alias("excluded"))
    shares = {f"{b}_pct": fn.percent(F.col(b), F.col("scored")) for b in (*BUCKETS, "zero_score")}
    return out.withColumns(shares).crossJoin(F.broadcast(lost)).withColumn("excluded_pct", fn.percent(F.col("excluded"), F.col("total")))  # one row


def threshold_summary(calibrated: DataFrame) -> DataFrame:
    """Thresholds of all days weighted by each day's population, and how many days used the constants. A day without a P90 has no part in its mean."""
    weight = F.col("population")

    def mean(c: str) -> Column:
        there = F.col(c).isNotNull()
        return fn.rounded(F.sum(F.when(there, F.round(F.col(c) * 1e8).cast("decimal(20,0)") * weight)).cast("double") / F.nullif(F.sum(F.when(there, weight)), F.lit(0)).cast("double") / 1e8, 4).alias(c)

    return calibrated.agg(*[mean(c) for c in ("p35", "p72", "p90")], F.sum(weight).alias("population"), F.count_if(F.col("basis") == "fixed_fallback").alias("fallback_days"), F.count("*").alias("days"))


def page_type_table(bucketed: DataFrame) -> DataFrame:
    """By best page type: sessions, mean score in hundredths, buckets, and sessions the struggle rule hits."""
    page = F.element_at(F.array(*map(F.lit, scoring.RANKED)), F.col("page_rank"))
    return bucketed.filter("status = 'scored'").groupBy(page.alias("page_type")).agg(F.count("*").alias("n"), fn.rounded(F.sum(F.round(F.col("score") * 100).cast("long")) / F.count("*") / 100.0, 4).alias("avg_score"), *[F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS], F.count_if(scoring.stuck()).alias("stuck"))


def other_paths(rows: DataFrame, top: int = 25) -> DataFrame:
    """The ``top`` paths of no known page type, by the sessions that viewed them; of equal numbers the first in order."""
    path = fn.page_path(F.col("url"))
    seen = rows.filter((F.col("event_name") == "page_viewed") & (F.col("url") != "")).select("session_id", path.alias("page_path"))
    pairs = seen.filter(fn.page_type(F.col("page_path")) == "other").distinct()
    return pairs.groupBy("page_path").agg(F.count("session_id").alias("sessions")).orderBy(F.col("sessions").desc(), "page_path").limit(top)


def struggle_report(sessions: DataFrame, least_clicks: int = 10) -> DataFrame:
    """Dead-click rates of all sessions with ``least_clicks`` or more, in one row: nearest ranks, extremes, how many lie above or at the 90th, and how many of
    the sessions were scored. Counts are 0 and ranks null if there is none.
    """
    busy = sessions.filter(F.col("click_count") >= least_clicks).select("status", (F.col("dead_click_count") / F.col("click_count")).alias("rate"), F.lit(1).alias("all"))
    ranks = scoring.nearest_ranks(busy, "all", F.col("rate"), {f"p{p}": (p / 100, None) for p in (50, 75, 80, 85, 90, 95, 99)}, many=True)
    cut = ranks.agg(*[F.max(c).alias(c) for c in ranks.columns if c not in ("all", "n")])  # one row, also of nothing
    rate, p90 = F.col("rate"), F.col("cut90")
    facts = busy.crossJoin(F.broadcast(cut.select(F.col("p90").alias("cut90")))).agg(
        F.count("*").alias("sessions"), fn.rounded(F.max(rate), 4).alias("most"), F.count_if(rate >= 1).alias("all_dead"), fn.percent(F.count_if(rate >= 1), F.count("*")).alias("all_dead_pct"),
        F.count_if(rate >= 0.9).alias("ninety_plus"), F.count_if(rate >= 0.5).alias("fifty_plus"), F.count_if(rate > p90).alias("above_p90"), F.count_if(rate >= p90).alias("from_p90"),
        F.count_if(F.col("status") == "scored").alias("scored"), F.count_if(F.col("status") != "scored").alias("excluded"),
    )
    return facts.crossJoin(F.broadcast(cut.select(*[fn.rounded(F.col(c), 4).alias(c) for c in cut.columns])))
