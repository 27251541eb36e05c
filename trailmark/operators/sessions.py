"""Batch sessionization: the session fold with add-to-cart claims, session facts, fragments, idle sweep, old against rebuilt sessions."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import scalars as fn
from . import ordered

TIMEOUT_S = 1800
COUNTED = {
    "page_view_count": "page_viewed",
    "product_view_count": "product_viewed",
    "click_count": "click",
    "add_to_cart_count": "product_added_to_cart",
    "checkout_started_count": "checkout_started",
    "scroll_count": "scroll_depth",
}


def identified(rows: DataFrame) -> DataFrame:
    """Rows with an ``identity``: the actor, else the client. Rows without either have no session."""
    return rows.withColumn("identity", F.coalesce("actor_id", "client_id"))


def first_deliveries(rows: DataFrame) -> DataFrame:
    """The first delivery of each event id (redelivery is a no-op)."""
    first = Window.partitionBy("event_id").orderBy("received_at", "seq")
    return rows.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")


#: Order of a visitor's events: time, receipt, behavioural rows before clicks, arrival.
ORDER = ("occurred_at", "received_at", "__click", "seq")


#: A visitor with more rows is dealt over tasks by time; of at most so many such visitors (all others have less than a thousandth of the rows).
HOT_ROWS, MOST_HOT = 1_000_000, 1000


def visitor(rows: DataFrame) -> list[str]:
    """The columns that name a visitor: the identity, within its brand where rows have one."""
    return [*(["brand_id"] if "brand_id" in rows.columns else []), "identity"]


def named(rows: DataFrame, first: str = "__first") -> DataFrame:
    """Adds ``session_id``, made from the visitor and the session's first event: rows of other days, or found later, change it for no other session."""
    return rows.withColumn("session_id", fn.session_uuid(F.concat_ws("|", *visitor(rows), first)))


def _known(rows: DataFrame) -> DataFrame:
    return identified(rows).filter("identity is not null").withColumn("__click", F.col("event_name") == "click")


def _apart(known: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of most visitors, and those of visitors with more than ``hot_rows``, if there are any."""
    own = visitor(known)
    many = known.groupBy(*own).agg(F.count("*").alias("__n")).filter(F.col("__n") > hot_rows)
    names = [r[:-1] for r in many.orderBy(F.col("__n").desc()).limit(MOST_HOT).collect()]
    if not names:
        return known, None
    hot = F.broadcast(known.sparkSession.createDataFrame(names, known.select(*own).schema))  # MOST_HOT rows
    return known.join(hot, own, "left_anti"), known.join(hot, own, "left_semi")


def _longer(before: Column, after: Column, timeout_s: int) -> Column:
    return F.timestamp_diff("MICROSECOND", before, after) > timeout_s * 1_000_000


def _gaps(known: DataFrame, timeout_s: int) -> DataFrame:
    """Adds ``session_no`` by gaps and ``__first``, the event that opens the session."""
    order = Window.partitionBy(*visitor(known)).orderBy(*ORDER)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    before = known.withColumn("__before", F.lag("occurred_at").over(order))
    opened = before.withColumn("__new", F.coalesce(_longer(F.col("__before"), F.col("occurred_at"), timeout_s), F.lit(True)).cast("int"))
    return opened.withColumns({"session_no": F.sum("__new").over(upto), "__first": F.last(F.when(F.col("__new") == 1, F.col("event_id")), ignorenulls=True).over(upto)}).drop("__before")


def _by_hour(rows: DataFrame) -> DataFrame:
    return rows.withColumn("__hour", F.coalesce(F.expr("timestampdiff(HOUR, timestamp_ntz'1970-01-01 00:00:00', occurred_at)"), F.lit(0)))


def _gaps_by_hour(known: DataFrame, timeout_s: int) -> DataFrame:
    """As ``_gaps``, for visitors of any number of rows: windows inside each hour, and what one hour hands to the next from one row an hour."""
    own = visitor(known)
    order = Window.partitionBy(*own, "__hour").orderBy(*ORDER)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = _by_hour(known).withColumn("__before", F.lag("occurred_at").over(order))
    rows = rows.withColumn("__new", F.coalesce(_longer(F.col("__before"), F.col("occurred_at"), timeout_s), F.lit(False)).cast("int"))
    rows = rows.withColumns({"__count": F.sum("__new").over(upto), "__own": F.last(F.when(F.col("__new") == 1, F.col("event_id")), ignorenulls=True).over(upto)})
    place = F.struct(*ORDER)
    hours = rows.groupBy(*own, "__hour").agg(
        F.min("occurred_at").alias("begin"), F.max("occurred_at").alias("end"), F.sum("__new").alias("inner"), F.min_by("event_id", place).alias("first_event"), F.max_by("event_id", F.when(F.col("__new") == 1, place)).alias("last_opener")
    )
    along = Window.partitionBy(*own).orderBy("__hour")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.withColumn("opens", F.coalesce(_longer(F.lag("end").over(along), F.col("begin"), timeout_s), F.lit(True)).cast("int"))
    hours = hours.withColumn("opener", F.coalesce("last_opener", F.when(F.col("opens") == 1, F.col("first_event"))))
    handed = hours.select(
        *own, "__hour", "opens", F.coalesce(F.sum(F.col("inner") + F.col("opens")).over(earlier), F.lit(0)).alias("__so_far"),
        F.coalesce(F.when(F.col("opens") == 1, F.col("first_event")), F.last("opener", ignorenulls=True).over(earlier)).alias("__open"),
    )
    met = rows.join(handed, [*own, "__hour"])
    number, new = F.col("__so_far") + F.col("opens") + F.col("__count"), F.greatest("__new", F.when(F.col("__before").isNull(), F.col("opens")).otherwise(0))
    return met.withColumns({"session_no": number, "__first": F.coalesce("__own", "__open"), "__new": new}).drop("__before", "__count", "__own", "__so_far", "__open", "opens")


def with_gaps(rows: DataFrame, timeout_s: int = TIMEOUT_S, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``session_no`` and ``session_id`` by gaps alone: one above ``timeout_s`` opens a session, exactly ``timeout_s`` does not. Cart claims play no part.

    Visitors are windows of one shuffle; those with more than ``hot_rows`` rows are cut by hours.
    """
    most, hot = _apart(_known(rows), hot_rows)
    out = _gaps(most, timeout_s)
    if hot is not None:
        out = out.unionByName(_gaps_by_hour(hot, timeout_s).drop("__hour"))
    return named(out).drop("__first", "__new", "__click")


def _fold(timeout_us: int, group: list[str]):
    """Numbers sessions along rows sorted by ``group`` and time; only the last time, the claims and the first event of the open session are held."""

    def fold(parts: Iterator) -> Iterator:
        import pyarrow as pa

        current, number, last, claimed, opener = None, 0, 0, set(), None
        for part in parts:
            numbers, counts, openers, fresh_ones = [], [], [], []
            names = zip(*(part.column(k).to_pylist() for k in group), strict=True)
            for own, micros, product, event in zip(names, *(part.column(k).to_pylist() for k in ("__micros", "__claim", "event_id")), strict=True):
                if own != current:
                    current, number, last, claimed = own, 0, None, set()
                fresh = last is None or micros - last > timeout_us
                repeated = product is not None and not fresh and product in claimed
                if not repeated:
                    if fresh:
                        number, claimed, opener = number + 1, set(), event
                    if product is not None:
                        claimed.add(product)
                    last = micros
                numbers.append(number)
                counts.append(not repeated)
                openers.append(opener)
                fresh_ones.append(int(fresh and not repeated))
            made = [pa.array(numbers, pa.int64()), pa.array(counts, pa.bool_()), pa.array(openers, pa.string()), pa.array(fresh_ones, pa.int32())]
            yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, "session_no", "counts", "__first", "__new"])

    return fold


def _folded(rows: DataFrame, group: list[str], timeout_s: int) -> DataFrame:
    rows = rows.withColumn("__micros", F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', occurred_at)"))
    dealt = rows.repartition(*group).sortWithinPartitions(*group, *ORDER)
    schema = T.StructType([*dealt.schema.fields]).add("session_no", "long").add("counts", "boolean").add("__first", "string").add("__new", "integer")
    return dealt.mapInArrow(_fold(timeout_s * 1_000_000, group), schema).drop("__micros")


def _most_sessions(known: DataFrame, timeout_s: int) -> DataFrame:
    """Sessions of visitors that fit into windows; only visitors who add a product again before a gap are folded, as for all others gaps decide."""
    own = visitor(known)
    whole, same = Window.partitionBy(*own), Window.partitionBy(*own, "session_no", "__claim")
    rows = _gaps(known, timeout_s)
    again = F.count("__claim").over(same) > 1  # a number: lists of a session's adds would be copied into each of its rows
    rows = rows.withColumn("__again", again).withColumn("__again", F.max("__again").over(whole))
    plain = rows.filter("not __again").drop("__again").withColumn("counts", F.lit(True))
    return plain.unionByName(_folded(rows.filter("__again").drop("__again", "session_no", "__first", "__new"), own, timeout_s))


def _hot_sessions(known: DataFrame, timeout_s: int) -> DataFrame:
    """Sessions of visitors of any number of rows. A gap above the timeout opens a session whatever was claimed, so what lies between two gaps stands
    alone: such segments are dealt over tasks, those with a repeated add are folded, and fresh sessions are counted along the hours."""
    own = visitor(known)
    rows = _gaps_by_hour(known, timeout_s).withColumnRenamed("session_no", "__segment")
    claims = rows.filter("__claim is not null").groupBy(*own, "__segment", "__claim").agg(F.count("*").alias("n")).filter("n > 1").select(*own, "__segment").distinct()
    marked = rows.join(claims.withColumn("__again", F.lit(True)), [*own, "__segment"], "left")
    plain = marked.filter("__again is null").drop("__again").withColumn("counts", F.lit(True))
    folded = _folded(marked.filter("__again").drop("__again", "__first", "__new"), [*own, "__segment"], timeout_s).drop("session_no")
    both = plain.unionByName(folded)
    order = Window.partitionBy(*own, "__hour").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*own).orderBy("__hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = both.groupBy(*own, "__hour").agg(F.sum("__new").alias("n")).select(*own, "__hour", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__so_far"))
    counted = both.withColumn("__count", F.sum("__new").over(order)).join(hours, [*own, "__hour"])
    return counted.withColumn("session_no", F.col("__so_far") + F.col("__count")).drop("__so_far", "__count", "__hour", "__segment")


def with_sessions(rows: DataFrame, timeout_s: int = TIMEOUT_S, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds ``session_no``, ``session_id`` and ``counts``.

    A gap above ``timeout_s`` since the visitor's last event that counts opens a session. Of a session's ``product_added_to_cart`` events for one
    product (ids in any case) only the first counts: a repeated one leaves the session untouched, so it never bridges a gap. What counts
    depends on the sessions and these on what counts, but only where a product is added again before a gap: these visitors' rows are folded in
    order through Arrow batches whose state is one session's. All others are numbered by windows. Visitors with more than ``hot_rows`` rows are
    cut by hours and segments, so that no task holds one of them.
    """
    claim = F.when(F.col("event_name") == "product_added_to_cart", F.lower("product_id"))
    most, hot = _apart(_known(rows).withColumn("__claim", claim), hot_rows)
    out = _most_sessions(most, timeout_s)
    if hot is not None:
        out = out.unionByName(_hot_sessions(hot, timeout_s))
    return named(out).drop("__first", "__new", "__click", "__claim")


def keep_first_cart_adds(rows: DataFrame) -> DataFrame:
    """Without the repeated adds to the cart that ``with_sessions`` marked."""
    return rows.filter("counts").drop("counts")


def session_rows(rows: DataFrame, more: list[Column] | None = None, names: bool = True) -> DataFrame:
    """One row per session with counters, duration, first utm source and (``names``) its ordered event names, and the aggregates ``more`` beside them.

    Without names a row is small whatever the number of a session's events.
    """
    named = {k: F.count_if(F.col("event_name") == v).alias(k) for k, v in COUNTED.items()}
    step = F.struct("occurred_at", "seq", "event_name")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("occurred_at", "seq"))).alias(c)
    tagged = rows.withColumn("__utm", fn.utm(F.col("url"), "utm_source"))
    return (
        tagged.groupBy(*visitor(rows), "session_no", "session_id")
        .agg(
            F.min("occurred_at").alias("session_start"),
            F.max("occurred_at").alias("session_end"),
            F.count("*").alias("event_count"),
            *named.values(),
            F.count_if(F.col("click_bucket") == "useful_click").alias("useful_click_count"),
            F.count_if(F.col("click_bucket") == "dead_click").alias("dead_click_count"),
            last("client_id"),
            F.min_by("__utm", F.when(F.col("__utm").isNotNull(), F.struct("occurred_at", "seq"))).alias("first_utm_source"),
            *([F.transform(F.array_sort(F.collect_list(step)), lambda s: s["event_name"]).alias("names")] if names else []),
            *(more or []),
        )
        .withColumn("session_time_spent_ms", F.expr("timestampdiff(MILLISECOND, session_start, session_end)"))
    )


def sessions(rows: DataFrame, timeout_s: int = TIMEOUT_S) -> DataFrame:
    return session_rows(keep_first_cart_adds(with_sessions(rows, timeout_s)))


def alone(rows: DataFrame) -> DataFrame:
    """Rows without identity: each is a session of its own that has no session row."""
    return identified(rows).filter("identity is null").withColumns({"session_no": F.lit(None).cast("long"), "session_id": F.sha1("event_id")})


def session_events(rows: DataFrame, timeout_s: int = TIMEOUT_S) -> DataFrame:
    """Events that count, with their session; events without identity are sessions of their own."""
    return keep_first_cart_adds(with_sessions(rows, timeout_s)).unionByName(alone(rows))


def step_entries(events: DataFrame) -> DataFrame:
    """What a session keeps of each event, in order: name, id, click bucket, client, visitor, first utm source."""
    place = F.row_number().over(Window.partitionBy("session_id").orderBy("occurred_at", "seq"))
    return events.select("session_id", place.alias("step"), "event_name", "event_id", "click_bucket", "client_id", F.lit(None).cast("string").alias("visitor_id"), fn.utm(F.col("url"), "utm_source").alias("utm_source"))


def builtin_sessions(rows: DataFrame, timeout_s: int = TIMEOUT_S) -> DataFrame:
    """The same sessions by ``session_window`` (whose gap merges an event exactly at its end), as a cross-check and for streams without cart claims."""
    known = identified(rows).filter("identity is not null")
    grouped = known.groupBy("identity", F.session_window("occurred_at", f"{timeout_s} seconds").alias("w"))
    return grouped.agg(F.min("occurred_at").alias("session_start"), F.max("occurred_at").alias("session_end"), F.count("*").alias("event_count")).drop("w")


def fragments(sessions_: DataFrame, timeout_s: int = TIMEOUT_S) -> DataFrame:
    """Sessions that start within ``timeout_s`` of their visitor's last one ending: one visit torn apart."""
    order = Window.partitionBy("identity").orderBy("session_start", "session_no")
    gap = sessions_.withColumn("gap_s", F.expr("timestampdiff(SECOND, lag(session_end) over (partition by identity order by session_start, session_no), session_start)"))
    return gap.withColumn("place", F.row_number().over(order)).filter(F.col("gap_s").between(0, timeout_s)).select("identity", "session_id", "gap_s")


def overlaps(sessions_: DataFrame, slack_s: int = 30) -> DataFrame:
    """Neighbouring sessions of a visitor of which the later starts more than ``slack_s`` before the earlier ends."""
    order = Window.partitionBy("identity").orderBy("session_start", "session_no")
    gap = F.timestamp_diff("SECOND", F.lag("session_end").over(order), F.col("session_start"))
    return sessions_.withColumn("gap_s", gap).filter(F.col("gap_s") < -slack_s).select("identity", "session_id", "gap_s")


def swept(sessions_: DataFrame, timeout_s: int = TIMEOUT_S, grace_s: int = 60, now: Column | None = None) -> DataFrame:
    """Adds ``closed``: all but the visitor's last session are closed, and that one if it idled past timeout and grace.

    Idle time counts up to the newest event or ``now`` (the store's clock), whichever is earlier: one event with a bogus future time does not make live
    sessions look idle.
    """
    now = F.localtimestamp() if now is None else now
    newest = sessions_.agg(F.least(F.max("session_end"), now).alias("newest"))
    last = Window.partitionBy("identity")
    marked = sessions_.withColumn("__last", F.max("session_no").over(last)).crossJoin(F.broadcast(newest))  # one row
    idle = F.col("session_end") < F.expr(f"newest - INTERVAL {timeout_s + grace_s} SECONDS")
    return marked.withColumn("closed", (F.col("session_no") < F.col("__last")) | idle).drop("__last", "newest")


def future_clock(rows: DataFrame) -> DataFrame:
    """Events per day whose client clock ran ahead and was replaced by the receipt."""
    return rows.groupBy(F.to_date("client_time").alias("day")).agg(F.count("*").alias("events"), F.count_if(F.col("occurred_at") != F.col("client_time")).alias("corrected"))


def overlap(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old sessions against rebuilt ones through their events: unchanged, merged, split, and events that moved."""
    pairs = old.select("event_id", F.col("session_id").alias("old")).join(new.select("event_id", F.col("session_id").alias("new")), "event_id").groupBy("old", "new").agg(F.count("*").alias("n"))
    by_new = pairs.groupBy("new").agg(F.countDistinct("old").alias("olds"), (F.sum("n") - F.max("n")).alias("moved"))
    by_old = pairs.groupBy("old").agg(F.countDistinct("new").alias("news"))
    a = by_new.agg(F.count("*").alias("new_sessions"), F.count_if(F.col("olds") > 1).alias("merged"), F.sum("moved").alias("events_moved"))
    b = by_old.agg(F.count("*").alias("old_sessions"), F.count_if(F.col("news") > 1).alias("split"))
    return a.crossJoin(b)  # one row each


def no_browsing(cart: Column, pages: Column, products: Column) -> Column:
    return cart & (pages == 0) & (products == 0)


def repaired(old: DataFrame, new: DataFrame, timeout_s: int = TIMEOUT_S) -> DataFrame:
    """What a rebuild mends, in one row: fragments before and after, carts without browsing before and after, durations of both (rank ``int(n * p / 100)``)."""

    def side(sessions_: DataFrame, tag: str) -> DataFrame:
        cart = (F.col("add_to_cart_count") > 0) | (F.col("checkout_started_count") > 0)
        facts = sessions_.agg(F.count_if(no_browsing(cart, F.col("page_view_count"), F.col("product_view_count"))).alias(f"{tag}_without_browsing"), F.sum("event_count").alias(f"{tag}_events"))
        torn = fragments(sessions_, timeout_s).agg(F.count("*").alias(f"{tag}_fragments"))
        counts = sessions_.groupBy("session_time_spent_ms").agg(F.count("*").alias("n"))
        ranked = ordered.running(counts, [], ["session_time_spent_ms"], {"upto": F.col("n")})
        cuts = ranked.agg(F.sum("n").alias(f"{tag}_sessions"), *[F.min(F.when(F.col("upto") > F.floor(F.col("upto_all") * p / 100), F.col("session_time_spent_ms"))).alias(f"{tag}_p{p}") for p in (50, 75, 90)])
        return facts.crossJoin(torn).crossJoin(cuts)  # one row each

    return side(old, "old").crossJoin(side(new, "new"))


def patterns(sessions_: DataFrame, k: int = 10) -> DataFrame:
    """The most common journeys; of equal counts the first in order."""
    return sessions_.groupBy(fn.journey(F.col("names")).alias("pattern")).agg(F.count("*").alias("sessions")).orderBy(F.col("sessions").desc(), "pattern").limit(k)


def integrity(rows: DataFrame, sessions_: DataFrame) -> DataFrame:
    """Conservation: identified events, events in sessions, sessions whose counters do not add up."""
    adds_up = sum((F.col(c) for c in COUNTED), F.lit(0)) == F.col("event_count")
    a = sessions_.agg(F.count("*").alias("sessions"), F.sum("event_count").alias("session_events"), F.count_if(~adds_up).alias("odd_counters"), F.count_if(F.col("session_end") < F.col("session_start")).alias("reversed"))
    return a.crossJoin(rows.agg(F.count_if(F.col("identity").isNotNull()).alias("identified_events")))
