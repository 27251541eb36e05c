"""The registered queries: each builds its plan from the adapter's rows and the operators."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as fn
from ..operators import diagnostics as dq
from ..operators import evaluation as ev
from ..operators import incremental
from ..operators import rollups as ru
from ..operators import scoring as sc
from ..operators import sessions as ss
from ..operators import sinks
from ..sources import adapter, layout, scratch
from ..streaming import contract

DAY_S, MINIMUM = 86400, 20


class Plans:
    """The common inputs of a query over one set of tables. What several branches of a query read is computed once and written (``sources.scratch``)."""

    def __init__(self, spark: SparkSession, sf_dir: str, timeout_s: int = DAY_S, minimum: int = MINIMUM):
        self.spark, self.sf_dir, self.timeout_s, self.minimum = spark, sf_dir, timeout_s, minimum
        self.rows = adapter.events(spark, sf_dir)
        self._stored: dict[str, DataFrame] = {}

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._stored:
            self._stored[name] = scratch.written(build())
        return self._stored[name]

    def inside(self) -> DataFrame:
        """Events that count, with their sessions; for plans that read them once."""
        return ss.keep_first_cart_adds(ss.with_sessions(self.rows, self.timeout_s))

    def events_once(self) -> DataFrame:
        return ss.session_events(self.rows, self.timeout_s)

    def events(self) -> DataFrame:
        return self.stored("events", self.events_once)

    def _inside(self) -> DataFrame:
        return self._stored["events"].filter("session_no is not null") if "events" in self._stored else self.inside()

    def sessions_once(self) -> DataFrame:
        return ss.session_rows(self._inside())

    def facts(self) -> DataFrame:
        """Session rows with enrichment: one aggregation over the events of a session."""
        return self.stored("facts", lambda: ss.session_rows(sc.with_page_types(self._inside()), sc.enrichments(), names=False))

    def swept(self) -> DataFrame:
        return ss.swept(self.facts(), self.timeout_s)

    def scored(self) -> DataFrame:
        return sc.scored_sessions(self.facts())

    def calibration(self) -> DataFrame:
        return sc.calibration(self.scored(), self.minimum)

    def bucketed(self) -> DataFrame:
        return self.stored("bucketed", lambda: sc.with_buckets(self.scored(), self.calibration()))

    def across(self) -> DataFrame:
        return ev.versions_across(self.scored())

    def long(self) -> DataFrame:
        return self.stored("long", lambda: ev.versions_long(self.scored()))

    def checked(self) -> DataFrame:
        return self.stored("checked", lambda: contract.parsed(adapter.records(self.rows)))

    def messages(self) -> DataFrame:
        """Sound messages; the records' texts, which none of them needs again, are not stored."""
        return contract.messages(self.stored("parsed", lambda: contract.parsed(adapter.records(self.rows)).select("seq", "v", "reject_reason")))


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that engines agree on how they print."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            out[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out[f.name] = F.date_format(f.name, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(out) if out else df


COUNTS = ["event_count", "page_view_count", "product_view_count", "click_count", "useful_click_count", "dead_click_count", "add_to_cart_count", "checkout_started_count", "scroll_count"]


def _overlap(p: Plans) -> DataFrame:
    return ss.overlap(ss.with_gaps(p.rows, 1800), ss.with_gaps(p.rows, 7200))


def _integrity(p: Plans) -> DataFrame:
    p.events()
    return ss.integrity(p._inside(), p.facts())


def _repaired(p: Plans) -> DataFrame:
    old = ss.session_rows(ss.with_gaps(p.rows, p.timeout_s))
    return ss.repaired(scratch.written(old), p.facts(), p.timeout_s)


def _sequences(p: Plans) -> DataFrame:
    return p.sessions_once().select("session_id", fn.sequence_path(F.col("names")).alias("sequence")).withColumn("sequence_hash", F.sha1("sequence"))


def _stored_sequences(p: Plans) -> DataFrame:
    """Sequences kept as JSON objects by number, read back out of order."""
    steps = F.map_from_entries(F.reverse(F.transform(F.col("names"), lambda n, i: F.struct((i + 1).cast("string").alias("at"), F.create_map(n, F.create_map(F.lit("event_id"), n)).alias("step")))))
    kept = p.sessions_once().select("session_id", F.to_json(F.transform_values(steps, lambda k, v: F.transform_values(v, lambda a, b: F.to_json(b)))).alias("events_seq"))
    return kept.select("session_id", fn.stored_path(F.col("events_seq")).alias("sequence"), fn.journey(fn.stored_names(F.col("events_seq"))).alias("journey"))


def _target(p: Plans) -> DataFrame:
    e = lambda name: F.col("element")[name]
    target = fn.click_target(e("tag"), e("element_id"), e("element_name"), e("element_type"), e("href"), e("value"))
    return p.rows.filter("event_name = 'click'").select("event_id", target.alias("t")).select("event_id", "t.*")


def _upsert(p: Plans) -> DataFrame:
    s = p.facts()
    old = s.filter("session_no <= 3").groupBy("identity").agg(F.min("first_utm_source").alias("first_utm_source"))
    new = s.filter("session_no > 3").groupBy("identity").agg(F.max("first_utm_source").alias("first_utm_source"))
    return sinks.coalesce_upsert(old, new, ["identity"])


def _halves(p: Plans, c: str = "event_count") -> tuple[DataFrame, DataFrame]:
    """Two versions of a table by visitor: of the first three sessions, and of those from the second on."""
    s = p.facts()
    part = lambda where: s.filter(where).groupBy("identity").agg(F.sum(c).alias("n"), F.max("session_no").alias("version"))
    return part("session_no <= 3"), part("session_no >= 2")


def _insert_new(p: Plans) -> DataFrame:
    old, new = _halves(p)
    return old.unionByName(sinks.insert_new(new, old, "identity"))


def _overwrite(p: Plans) -> DataFrame:
    return sinks.upsert(*_halves(p), ["identity"])


def _update_join(p: Plans) -> DataFrame:
    old, new = _halves(p)
    return sinks.updated(old, new.filter("n > 5").select("identity", "n"), "identity")


def _sweep_delete(p: Plans) -> DataFrame:
    return sinks.deleted_if_unchanged(*_halves(p), "identity", "version")


def _stale(p: Plans) -> DataFrame:
    rows = p.events().withColumns({"day": F.to_date("occurred_at"), "page_path": fn.page_path(F.col("url"))})
    return sinks.stale_keys(rows.filter("event_name = 'click'"), rows.filter("event_name = 'page_viewed'"), "day", ["page_path"])


def _exact_pages(p: Plans) -> DataFrame:
    pages = ru.page_behavior(p.events(), exact_distinct=True).filter("page_views > 0")
    return pages.select(ru.DAY, "page_path", "page_views", "unique_actors", "unique_sessions", "clicks")


def _intent(p: Plans) -> DataFrame:
    p.events()
    return ru.product_intent(p.events(), p.bucketed())


def _heatmap(p: Plans) -> DataFrame:
    p.events()
    return ru.heatmap(p.events(), p.bucketed())


def _gaps_as_of(p: Plans) -> DataFrame:
    """Here alone some days have no thresholds of their own (every third), so that the as-of join has gaps to bridge."""
    scored = p.scored()
    return sc.thresholds_as_of(scored.select("day").distinct(), p.calibration().filter(F.day("day") % 3 != 1))


def _range(p: Plans) -> DataFrame:
    rows = adapter.events(p.spark, p.sf_dir, "2024-01-08 00:00:00", "2024-01-15 00:00:00")
    return rows.groupBy("event_name").agg(F.count("*").alias("events"), F.countDistinct("client_id").alias("clients"))


def _health(p: Plans) -> DataFrame:
    """Events are put in sessions once, and of each only what session rows and counts read is stored."""
    unread = ("element", "actor_id", "product_id", "product_title", "scroll_percent", "client_time", "received_at")
    p.stored("events", lambda: p.events_once().drop(*unread))
    return dq.health(p.bucketed(), p.events())


def _semi(p: Plans) -> DataFrame:
    buyers = p.rows.filter("event_name = 'checkout_started'").select("client_id").distinct()
    return p.rows.join(buyers, "client_id", "left_semi").groupBy("event_name").agg(F.count("*").alias("events"))


def _json_sessions(p: Plans) -> DataFrame:
    """Session rows through JSON lines and back under a stated schema."""
    path = f"{scratch.shared_dir(p.spark)}/sessions-{uuid.uuid4().hex}"
    rows = p.sessions_once()
    sinks.report(rows.select(adapter.present(rows, ["session_id", "identity", "not_there", "event_count", "session_start"])), path, "json")
    back = adapter.read_events(p.spark, path, "session_id string, identity string, event_count long, session_start timestamp_ntz", kind="json")
    return back.groupBy(F.to_date("session_start").alias("day")).agg(F.count("*").alias("sessions"), F.sum("event_count").alias("events"))


def _rebuild(p: Plans) -> DataFrame:
    return adapter.rebuild_window(p.rows, "2024-01-10", future_s=86_400, ahead_s=300).select("event_id", "event_name")


def _receipts(p: Plans) -> DataFrame:
    """Event times corrected by the time of writing, some minutes after the receipt and by a clock five and a half hours behind; one row in 61 has none."""
    lag = F.make_dt_interval(secs=(F.col("seq") % 400).cast("decimal(18,6)"))
    rows = p.rows.withColumn("ingested_at", F.when(F.col("seq") % 61 != 0, F.expr("received_at - INTERVAL '5:30' HOUR TO MINUTE") + lag))
    fixed = adapter.corrected_by_write_time(rows.drop("occurred_at"))
    return fixed.select("event_id", "occurred_at", "replaced", fn.clock_offset(F.col("ingested_at"), F.col("received_at")).alias("offset_s"))


def _send_order(p: Plans) -> DataFrame:
    return contract.numbered_in_send_order(adapter.records(p.rows)).select("place", "topic", "partition", "offset")


def _released(p: Plans) -> DataFrame:
    records = adapter.records(p.rows)
    partitions = records.select("topic", "partition").distinct().withColumn("caught_up", F.col("partition") != 1)
    return contract.released(records, partitions, "2024-01-20 00:00:00").select("topic", "partition", "offset")


def _quarantined(p: Plans) -> DataFrame:
    """Dead letters as records of the quarantine topic, their headers as texts; every fifth record had been tried before."""
    records = adapter.records(p.rows).withColumns({"key": F.concat(F.lit("k"), "seq"), "attempts": F.when(F.col("seq") % 5 == 0, 3)})
    checked = p.stored("checked_with_keys", lambda: contract.parsed(records))
    out = contract.quarantined(contract.dead_letters(checked), "intent.dlq", F.lit(1_700_000_000))
    return out.select("topic", F.col("key").cast("string").alias("key"), *[F.get("headers", F.lit(i))["value"].cast("string").alias(name) for i, name in enumerate(contract.HEADERS)])


def _events_of_messages(p: Plans) -> DataFrame:
    rows = contract.event_rows(p.messages())
    return rows.select("event_id", "event_name", "actor_id", "client_id", "product_id", "product_title", "quantity", "price", "scroll_percent", "occurred_at", *fn.UTM)


def _clicks_of_messages(p: Plans) -> DataFrame:
    rows = contract.click_rows(p.messages())
    return rows.select("event_id", "click_x", "click_y", "click_tag", "click_element_id", "click_element_name", "click_element_type", "click_href", "url_changed", "cart_changed", "ui_changed", "click_bucket", "occurred_at")


def _message_sessions(p: Plans) -> DataFrame:
    """Sound messages with the session each one got. What sessions need of a message is stored, as it is read several times."""
    needed = ("brand_id", "event_id", "event_name", "actor_id", "client_id", "product_id", "occurred_at", "received_at", "seq")
    rows = p.stored("messages", lambda: p.messages().select(*needed))
    return ss.keep_first_cart_adds(ss.with_sessions(rows, p.timeout_s)).select("event_id", "identity", "session_id")


def _odd_sessions(p: Plans) -> DataFrame:
    """Classification over session rows of which some lack a duration, a start or an id, or run backwards."""
    n = F.col("session_no")
    s = p.facts().withColumns({"session_time_spent_ms": F.when(n % 5 == 0, None).when(n % 7 == 0, -F.lit(1)).otherwise(F.col("session_time_spent_ms")), "session_id": F.when(n % 11 == 0, "").otherwise(F.col("session_id"))})
    return sc.classified(s).groupBy("status", "reason").agg(F.count("*").alias("sessions"))


def _thresholds(p: Plans) -> DataFrame:
    long = p.long().drop("p35", "p72", "method", "population", "bucket", "bucket_without_floor")
    both = [ev.thresholds(long, mode, enough=200).withColumn("mode", F.lit(mode)) for mode in ("common", "production")]
    return both[0].unionByName(both[1])


def _purchases(p: Plans) -> DataFrame:
    """Outcomes are known of sessions with a checkout: bought if they also have a cart, at their events' number."""
    known = p.facts().filter("checkout_started_count > 0").select("session_id", (F.col("add_to_cart_count") > 0).alias("purchased"), F.col("event_count").cast("double").alias("order_value"))
    return ev.purchases(p.long(), known)


def _parity(p: Plans) -> DataFrame:
    """Production scores against stored ones that lack every fifth session and are off by a cent in every seventh."""
    own = p.bucketed().filter("status = 'scored'").select("session_id", "session_no", "score", "bucket")
    n = F.col("session_no")
    stored = own.filter(n % 5 != 0).select("session_id", (F.col("score") + F.when(n % 7 == 0, 0.5).otherwise(0.0)).alias("stored_score"), F.when(n % 3 == 0, "low").otherwise(F.col("bucket")).alias("stored_bucket"))
    return ev.parity(own.drop("session_no"), stored)


def _extras(p: Plans) -> DataFrame:
    p.events()
    return sc.with_extras(p.facts().select("session_id", "event_count"), [sc.deepest(p._inside())])


def _results(p: Plans) -> DataFrame:
    out = ev.result_rows(p.scored(), p.scored(), ("V1", "V5", "V9"))
    return out.select("session_id", "version", "status", "reason", "score", "raw_score", "bounce", "bucket", "bucket_without_floor", "method", "population", "p35", "p72", "event_count")


def _result_table(p: Plans) -> DataFrame:
    """Four versions, of which one reads the deepest scroll and so fails where a session has none; outcomes are known of sessions with a checkout."""
    p.events()
    sessions = sc.with_extras(p.bucketed(), [sc.deepest(p._inside())]).withColumn("brand_id", F.lit("b"))
    known = sc.VERSIONS | {"VS": sc.Version("VS", (*sc.TERMS, ("deepest_scroll", 100, 0.1)))}
    paid = p.facts().filter("checkout_started_count > 0").select("session_id", (F.col("add_to_cart_count") > 0).alias("purchased"), F.col("event_count").cast("double").alias("order_value"))
    return ev.result_table(sessions, ("V1", "V1C", "V5", "VS"), paid, known)


def _touched(p: Plans) -> DataFrame:
    s = p.scored()
    return sc.touched_actors([s.filter("status = 'scored'"), s.filter("status <> 'scored'")])


def _scoring_window(p: Plans) -> DataFrame:
    s = p.facts().withColumn("status", F.when(F.col("session_no") % 4 == 0, "pending").otherwise("scored"))
    return sc.scoring_window(s, "2024-01-20 12:00:00", "2024-01-21 00:00:00").select("session_id", "status")


def _sql(text: str) -> Callable[[Plans], DataFrame]:
    """A query in SQL over the rows (``{rows}``), with the domain's functions under their SQL names."""

    def plan(p: Plans) -> DataFrame:
        fn.register(p.spark)
        return p.spark.sql(text, rows=p.rows)

    return plan


def _zones(p: Plans) -> DataFrame:
    labels = F.array(F.lit("(GMT+05:30) Asia/Kolkata"), F.lit("Europe/Berlin"), F.lit("(GMT) "), F.lit(None), F.lit(" (UTC-3) America/Argentina/Buenos_Aires "))
    return p.rows.groupBy(fn.zone_name(F.get(labels, (F.col("seq") % 5).cast("int"))).alias("zone")).agg(F.count("*").alias("n"))


def _premature(p: Plans) -> DataFrame:
    n = F.col("session_no") % 3
    late = F.when(n == 0, F.expr("session_end + INTERVAL 1900 SECONDS")).when(n == 1, F.expr("session_end + INTERVAL 1800 SECONDS")).otherwise(F.expr("session_end + INTERVAL 60 SECONDS"))
    return dq.premature_closes(p.swept().withColumn("written_at", late))


def _two_streams(p: Plans) -> DataFrame:
    """Behavioural events and clicks as two streams, each delivered again later under another name: the first delivery of an id wins."""
    again = {"event_name": F.lit("delivered again"), "received_at": F.expr("received_at + INTERVAL 1 HOUR"), "url": F.lit(None).cast("string")}
    streams = [p.rows.filter(where) for where in ("event_name = 'click'", "event_name <> 'click'")]
    late = [s.withColumns(again) for s in streams]
    return ss.first_deliveries(late[0].unionByName(streams[1]).unionByName(streams[0]).unionByName(late[1])).select("event_id", "event_name")


def _incremental(p: Plans) -> DataFrame:
    """Page rollups by two runs: one over what was received until a day, and one, from its watermark on, over the days that later receipts touch."""
    base, mark, events = f"{scratch.shared_dir(p.spark)}/rollups-{uuid.uuid4().hex}", datetime.datetime(2024, 1, 15, 12), p.events()
    newest = events.agg(F.greatest(F.max("received_at"), F.max("occurred_at"))).first()[0] or mark
    stages, far = {"pages": ru.page_behavior}, {"first_run_s": 90 * DAY_S, "most_days": 92}
    incremental.run(events.filter(F.col("received_at") < F.lit(mark)), base, mark, stages, **far)
    incremental.run(events, base, max(newest, mark), stages, **far)
    return p.spark.read.schema(ru.page_behavior(events).schema).parquet(f"{base}/pages")


def _stored_heatmap(p: Plans) -> DataFrame:
    """The heatmap of one week from stored tables: other days are not read, and events meet sessions bucket by bucket."""
    p.events()
    events = layout.store(p.events(), F.to_date("occurred_at"))
    sessions = layout.store(p.bucketed().drop("day"), F.to_date("session_start"))
    return ru.heatmap(layout.days(events, "2024-01-08", "2024-01-14"), sessions.drop("day"))


def _score_updates(p: Plans) -> DataFrame:
    """Session rows, of which a keyed write sets scores and buckets and leaves the rest."""
    table = incremental.KeyedTable(f"{scratch.shared_dir(p.spark)}/scores-{uuid.uuid4().hex}", "session_id", parts=16)
    scored = p.bucketed()
    table.upsert(scored.select("session_id", "event_count", F.lit(None).cast("double").alias("score"), F.lit("pending").alias("bucket")))
    table.update(scored.filter("status = 'scored'").select("session_id", "score", "bucket"), ["score", "bucket"])
    return table.read(p.spark).drop("part")


#: name: (timeout in seconds, percentile minimum, plan)
PLANS: dict[str, tuple[int, int, Callable[[Plans], DataFrame]]] = {
    "sess_gap_lag": (1800, 500, lambda p: ss.with_gaps(p.rows, 1800).select("event_id", "identity", "session_no", "session_id")),
    "sess_window_builtin": (1800, 500, lambda p: ss.builtin_sessions(p.rows, 1800)),
    "sess_closed_rows": (1800, 500, lambda p: p.sessions_once().select("identity", "session_no", "session_id", "session_start", "session_end", *COUNTS, "client_id", "session_time_spent_ms")),
    "sess_idle_sweep": (1800, 500, lambda p: p.swept().select("identity", "session_no", "session_id", "closed")),
    "sess_fragments_lag": (600, 500, lambda p: ss.fragments(p.sessions_once(), 1800)),
    "sess_first_utm": (DAY_S, MINIMUM, lambda p: p.sessions_once().select("session_id", "first_utm_source")),
    "sess_overlap": (1800, 500, _overlap),
    "sess_integrity": (1800, 500, _integrity),
    "evt_atc_keep_first": (DAY_S, MINIMUM, lambda p: p.inside().filter("event_name = 'product_added_to_cart'").select("event_id", "session_id", "product_id")),
    "evt_dedup": (1800, 500, _two_streams),
    "evt_future_clock": (1800, 500, lambda p: ss.future_clock(p.rows)),
    "evt_topic_route": (1800, 500, lambda p: p.rows.groupBy("event_name", fn.topic(F.col("event_name")).alias("topic")).agg(F.count("*").alias("events"))),
    "fn_page_path": (1800, 500, lambda p: p.rows.select("event_id", fn.page_path(F.col("url")).alias("page_path"))),
    "fn_page_type": (1800, 500, lambda p: p.rows.groupBy(fn.page_type(fn.page_path(F.col("url"))).alias("page_type")).agg(F.count("*").alias("n"))),
    "fn_utm": (1800, 500, lambda p: p.rows.select("event_id", fn.utm(F.col("url"), "utm_source").alias("utm_source"))),
    "fn_device": (1800, 500, lambda p: p.rows.groupBy(fn.device(F.col("user_agent")).alias("device_type")).agg(F.count("*").alias("n"))),
    "fn_click_target": (1800, 500, _target),
    "fn_cart_explode": (DAY_S, MINIMUM, lambda p: p.events_once().select("event_id", F.explode(fn.cart_products(F.col("product_id"))).alias("product_id"))),
    "fn_sequence_path": (DAY_S, MINIMUM, _sequences),
    "ru_daily_summary": (DAY_S, MINIMUM, lambda p: ru.daily_summary(p.swept())),
    "ru_page_behavior": (DAY_S, MINIMUM, lambda p: ru.page_behavior(p.events())),
    "ru_page_behavior_exact": (DAY_S, MINIMUM, _exact_pages),
    "ru_click_behavior": (DAY_S, MINIMUM, lambda p: ru.click_behavior(p.events_once())),
    "ru_product_behavior": (DAY_S, MINIMUM, lambda p: ru.product_behavior(p.events())),
    "ru_product_intent": (DAY_S, MINIMUM, _intent),
    "ru_path_daily": (DAY_S, MINIMUM, lambda p: ru.path_daily(p.sessions_once())),
    "ru_heatmap": (DAY_S, MINIMUM, _heatmap),
    "ru_affected_dates": (1800, 500, lambda p: ru.affected_dates(p.rows)),
    "sc_enrichment": (DAY_S, MINIMUM, lambda p: sc.enrichment(p.events_once())),
    "sc_exclusions": (DAY_S, MINIMUM, lambda p: p.scored().groupBy("status", "stage").agg(F.count("*").alias("sessions"))),
    "sc_scores": (DAY_S, MINIMUM, lambda p: p.scored().select("session_id", "status", "stage", "score")),
    "sc_dead_click_p90": (DAY_S, MINIMUM, lambda p: sc.dead_click_p90(p.facts())),
    "sc_calibration": (DAY_S, MINIMUM, lambda p: p.calibration()),
    "sc_calibration_fallback": (1800, 500, lambda p: p.calibration()),
    "sc_asof_thresholds": (DAY_S, MINIMUM, _gaps_as_of),
    "sc_buckets": (DAY_S, MINIMUM, lambda p: p.bucketed().select("session_id", "score", "bucket", "operational_bucket")),
    "sc_actor_best": (DAY_S, MINIMUM, lambda p: sc.actors(p.bucketed())),
    "ev_versions_long": (DAY_S, MINIMUM, lambda p: ev.versions_long(p.scored()).select("session_id", "version", "score", "stage", "bucket")),
    "ev_wide_pivot": (DAY_S, MINIMUM, lambda p: ev.wide(p.across(), tuple(sc.VERSIONS))),
    "ev_transitions": (DAY_S, MINIMUM, lambda p: ev.transitions(p.across())),
    "ev_outcome_lift": (DAY_S, MINIMUM, lambda p: ev.outcomes(p.long(), ["version", "bucket"])),
    "ev_monotonic": (DAY_S, MINIMUM, lambda p: ev.monotonic(p.long())),
    "ev_score_bands": (DAY_S, MINIMUM, lambda p: ev.score_bands(p.long())),
    "ev_landing_cohort": (DAY_S, MINIMUM, lambda p: ev.landing_cohort(p.long())),
    "ev_stage_crosstab": (DAY_S, MINIMUM, lambda p: ev.stage_crosstab(p.long())),
    "ev_parity": (DAY_S, MINIMUM, lambda p: ev.agreement(p.across())),
    "ev_tv_distance": (DAY_S, MINIMUM, lambda p: ev.total_variation(p.long())),
    "ev_zero_scores": (DAY_S, MINIMUM, lambda p: ev.zero_scores(p.long())),
    "ev_threshold_shift": (DAY_S, MINIMUM, lambda p: ev.threshold_shift(p.long())),
    "ev_duration_bands": (DAY_S, MINIMUM, lambda p: ev.duration_bands(p.long())),
    "dq_reconciliation": (DAY_S, MINIMUM, lambda p: dq.reconciliation(p.bucketed())),
    "dq_levels": (DAY_S, MINIMUM, lambda p: dq.level_split(p.bucketed())),
    "dq_histogram": (DAY_S, MINIMUM, lambda p: dq.histogram(p.bucketed())),
    "dq_score_frequency": (DAY_S, MINIMUM, lambda p: dq.score_frequency(p.bucketed())),
    "dq_feature_rollup": (DAY_S, MINIMUM, lambda p: dq.feature_rollup(p.bucketed())),
    "dq_engagement_cohorts": (DAY_S, MINIMUM, lambda p: dq.engagement_cohorts(p.bucketed())),
    "dq_bounce_top": (DAY_S, MINIMUM, lambda p: dq.bounce_top(p.bucketed())),
    "dq_page_types": (DAY_S, MINIMUM, lambda p: dq.page_types(p.bucketed())),
    "dq_view_duplication": (DAY_S, MINIMUM, lambda p: dq.view_duplication(p.events_once())),
    "dq_event_census": (DAY_S, MINIMUM, lambda p: dq.event_census(p.events_once())),
    "dq_backlog": (DAY_S, MINIMUM, lambda p: dq.backlog(p.swept())),
    "dq_anti_sessions": (DAY_S, MINIMUM, lambda p: dq.sessions_without_events(p.facts(), p.events())),
    "dq_dead_clicks": (DAY_S, MINIMUM, lambda p: dq.dead_clicks(p.bucketed())),
    "dq_health": (DAY_S, MINIMUM, _health),
    "src_range_scan": (1800, 500, _range),
    "src_rebuild_window": (1800, 500, _rebuild),
    "src_json_sessions": (DAY_S, MINIMUM, _json_sessions),
    "jn_semi_buyers": (1800, 500, _semi),
    "sess_reconstruct": (1800, 500, lambda p: ss.with_sessions(p.rows, 1800).select("event_id", "identity", "session_no", "counts")),
    "sess_reconstruct_days": (DAY_S, MINIMUM, lambda p: ss.with_sessions(p.rows, DAY_S).select("event_id", "identity", "session_no", "counts")),
    "sess_adjacent_overlap": (600, 500, lambda p: ss.overlaps(p.sessions_once(), -3600)),
    "sess_repaired": (DAY_S, MINIMUM, _repaired),
    "sess_patterns": (DAY_S, MINIMUM, lambda p: ss.patterns(p.sessions_once())),
    "sess_step_entries": (DAY_S, MINIMUM, lambda p: ss.step_entries(p.inside())),
    "evt_contract": (1800, 500, lambda p: p.checked().groupBy("reject_reason").agg(F.count("*").alias("n"))),
    "evt_dead_letters": (1800, 500, lambda p: contract.dead_letters(p.checked()).select("topic", "partition", "offset", "reject_reason")),
    "evt_quarantined": (1800, 500, _quarantined),
    "evt_event_rows": (1800, 500, _events_of_messages),
    "evt_click_rows": (1800, 500, _clicks_of_messages),
    "evt_message_sessions": (DAY_S, MINIMUM, _message_sessions),
    "evt_receipt_proxy": (1800, 500, _receipts),
    "evt_send_order": (1800, 500, _send_order),
    "evt_released": (1800, 500, _released),
    "fn_utm_all": (1800, 500, lambda p: p.rows.select("event_id", *[fn.utm(F.concat(F.col("url"), F.lit("&UTM_Medium=%20Mail+a&utm_term=&utm_term=x#q?utm_campaign=%C3%A9")), n).alias(n) for n in fn.UTM])),
    "fn_cart_items": (DAY_S, MINIMUM, lambda p: p.events_once().select("event_id", F.inline(fn.cart_items(F.col("product_id"), F.col("product_title"))))),
    "fn_stored_path": (DAY_S, MINIMUM, _stored_sequences),
    "fn_sql_functions": (1800, 500, _sql("SELECT tm_page_type(tm_raw_path(url)) AS page_type, tm_product_id(product_id) AS product_id, count(*) AS n FROM {rows} GROUP BY ALL")),
    "fn_sql_pages": (1800, 500, _sql("SELECT event_id, tm_page_path(url) AS page_path, tm_device(user_agent) AS device_type, tm_topic(event_name) AS topic, tm_is_bot(user_agent) AS bot FROM {rows}")),
    "fn_sql_carts": (DAY_S, MINIMUM, _sql("SELECT r.event_id, i.product_id, i.product_title FROM {rows} r, LATERAL tm_cart_items(r.product_id, r.product_title) i")),
    "fn_sql_utm": (1800, 500, _sql("SELECT r.event_id, u.name, u.value FROM {rows} r, LATERAL tm_utm_values(r.url) u")),
    "fn_zones": (1800, 500, _zones),
    "ru_affected_dates_since": (1800, 500, lambda p: ru.affected_dates(p.rows, since="2024-01-20 00:00:00")),
    "ru_affected_dates_first": (1800, 500, lambda p: ru.affected_dates(p.rows, since="first")),
    "sc_components": (DAY_S, MINIMUM, lambda p: p.scored().filter("status = 'scored'").select("session_id", sc.VERSIONS["V1"].components().alias("c")).select("session_id", "c.*")),
    "sc_classification": (DAY_S, MINIMUM, _odd_sessions),
    "sc_extras": (DAY_S, MINIMUM, _extras),
    "sc_touched_actors": (DAY_S, MINIMUM, _touched),
    "sc_scoring_window": (DAY_S, MINIMUM, _scoring_window),
    "ev_thresholds": (DAY_S, MINIMUM, _thresholds),
    "ev_results": (DAY_S, MINIMUM, _results),
    "ev_result_table": (DAY_S, MINIMUM, _result_table),
    "ev_replays": (DAY_S, MINIMUM, lambda p: ev.replays(p.scored()).select("session_id", "version", "score", "bucket", "method")),
    "ev_distribution": (DAY_S, MINIMUM, lambda p: ev.distribution(ev.replays(p.scored()), p.scored())),
    "ev_threshold_summary": (DAY_S, MINIMUM, lambda p: ev.threshold_summary(p.calibration())),
    "ev_four_groups": (DAY_S, MINIMUM, lambda p: ev.four_groups(p.long())),
    "ev_score_ties": (DAY_S, MINIMUM, lambda p: ev.score_ties(p.long())),
    "ev_engaged": (DAY_S, MINIMUM, lambda p: ev.engaged(p.long())),
    "ev_bucket_stages": (DAY_S, MINIMUM, lambda p: ev.bucket_stages(p.long())),
    "ev_stage_effects": (DAY_S, MINIMUM, lambda p: ev.stage_effects(p.long())),
    "ev_zero_reduction": (DAY_S, MINIMUM, lambda p: ev.zero_reduction(p.across())),
    "ev_duration_diagnostics": (DAY_S, MINIMUM, lambda p: ev.duration_diagnostics(p.long())),
    "ev_scroll_diagnostics": (DAY_S, MINIMUM, lambda p: ev.scroll_diagnostics(p.long())),
    "ev_struggle_differences": (DAY_S, MINIMUM, lambda p: ev.struggle_differences(p.long())),
    "ev_purchases": (DAY_S, MINIMUM, _purchases),
    "ev_composition": (DAY_S, MINIMUM, lambda p: ev.composition(p.long())),
    "ev_percentile_rules": (DAY_S, MINIMUM, lambda p: ev.percentile_summaries(p.long())),
    "ev_stored_parity": (DAY_S, MINIMUM, _parity),
    "ev_page_types": (DAY_S, MINIMUM, lambda p: ev.page_type_table(p.bucketed())),
    "ev_other_paths": (DAY_S, MINIMUM, lambda p: ev.other_paths(p.events_once())),
    "ev_struggle": (DAY_S, MINIMUM, lambda p: ev.struggle_report(p.bucketed())),
    "dq_why_low": (DAY_S, MINIMUM, lambda p: dq.why_low(p.bucketed())),
    "dq_score_percentiles": (DAY_S, MINIMUM, lambda p: dq.score_percentiles(p.bucketed())),
    "dq_buckets": (DAY_S, MINIMUM, lambda p: dq.buckets(p.bucketed(), sc.actors(p.bucketed()))),
    "dq_cohorts": (DAY_S, MINIMUM, lambda p: dq.cohorts(p.bucketed())),
    "dq_features_by_bucket": (DAY_S, MINIMUM, lambda p: dq.features_by_bucket(p.bucketed())),
    "dq_bounce_rule": (DAY_S, MINIMUM, lambda p: dq.bounce_rule(p.bucketed())),
    "dq_clicks": (DAY_S, MINIMUM, lambda p: dq.clicks(p.events_once())),
    "dq_freshness": (DAY_S, MINIMUM, lambda p: dq.freshness(p.rows, p.facts(), p.calibration())),
    "dq_against_external": (DAY_S, MINIMUM, lambda p: dq.against_external(p.bucketed(), {"low": 50, "medium": 30, "high": 20})),
    "dq_bounce_impact": (DAY_S, MINIMUM, lambda p: dq.bounce_impact(p.bucketed())),
    "dq_override_impact": (DAY_S, MINIMUM, lambda p: dq.override_impact(p.bucketed())),
    "dq_premature_closes": (DAY_S, MINIMUM, _premature),
    "dq_open_cursors": (DAY_S, MINIMUM, lambda p: dq.open_cursors(p.swept())),
    "ru_incremental_pages": (DAY_S, MINIMUM, _incremental),
    "ru_heatmap_stored_days": (DAY_S, MINIMUM, _stored_heatmap),
    "snk_score_update": (DAY_S, MINIMUM, _score_updates),
    "snk_insert_new": (DAY_S, MINIMUM, _insert_new),
    "snk_upsert": (DAY_S, MINIMUM, _overwrite),
    "snk_update_join": (DAY_S, MINIMUM, _update_join),
    "snk_delete_unchanged": (DAY_S, MINIMUM, _sweep_delete),
    "snk_coalesce_upsert": (DAY_S, MINIMUM, _upsert),
    "snk_stale_keys": (DAY_S, MINIMUM, _stale),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(timeout_s: int, minimum: int, plan):
        return lambda spark, sf_dir: plain(plan(Plans(spark, sf_dir, timeout_s, minimum)))

    return {name: bound(*entry) for name, entry in PLANS.items()}
