"""The session stream end to end: records, contract, keyed state, rows of events with their sessions, closed sessions, dead letters and counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from ..functions import scalars as fn
from ..operators import sessions as ss
from . import contract

COUNTERS = ("event_count", "page_view_count", "product_view_count", "click_count", "useful_click_count", "dead_click_count", "add_to_cart_count", "checkout_started_count", "scroll_count")
COUNTED = {v: k for k, v in ss.COUNTED.items()} | {"useful_click": "useful_click_count", "dead_click": "dead_click_count"}
#: How many of a session's newest event ids the state holds to know redeliveries by; older ones are known to the sink's table of keys.
RECENT = 1000

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

FACTS = "session_id string, session_start timestamp_ntz, session_end timestamp_ntz, session_time_spent_ms long, " + ", ".join(f"{c} long" for c in COUNTERS) + ", client_id string, visitor_id string, first_utm_source string"
#: ``kind`` is ``event`` (one row per record: its session, and ``outcome``) or ``session`` (one row per session that closed).
OUT = f"kind string, brand_id string, identity string, event_id string, value string, outcome string, late boolean, backward boolean, replaced boolean, {FACTS}"
CURSOR = "session_id string, start long, last long, sent long, timer long, " + ", ".join(f"{c} long" for c in COUNTERS) + ", client_id string, visitor_id string, first_utm_source string, recent array<string>"
NAMES = [f.split()[0] for f in OUT.split(", ")]
FIELDS = [f.split()[0] for f in CURSOR.split(", ")]


def session_id(brand: str, identity: str, event_id: str) -> str:
    """As ``scalars.session_uuid`` makes it."""
    import uuid

    return str(uuid.uuid5(uuid.UUID(fn.SESSION_SPACE), f"{brand}|{identity}|{event_id}"))


class Sessions(StatefulProcessor):
    """The open session of one visitor of one brand: a cursor, the products it has claimed, and a timer that closes it when nothing comes.

    A gap above ``timeout_s``, or more than ``slack_s`` back, opens a session and closes the one before; a smaller step back stays in it and does not
    move its end. A repeated add of a product, or a redelivered event, changes nothing.
    """

    def __init__(self, timeout_s: int, slack_s: int, grace_s: int):
        self.timeout, self.slack, self.idle_ms = timeout_s * 1_000_000, slack_s * 1_000_000, (timeout_s + grace_s) * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cursor = handle.getValueState("cursor", CURSOR)
        self.claims = handle.getMapState("claims", "product string", "at long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803 (names of the interface)
        """Open sessions of a batch (``open_cursors``) go on in the stream."""
        held = initialState.iloc[0].to_dict()
        state = {f: held.get(f) for f in FIELDS}
        state = {f: None if v is None or (isinstance(v, float) and pd.isna(v)) else v for f, v in state.items()}
        state |= {f: int(state[f] or 0) for f in ("start", "last", "sent", *COUNTERS)} | {"recent": list(state["recent"]) if state["recent"] is not None else [], "timer": None}
        for product in held.get("claims") if held.get("claims") is not None else []:
            self.claims.updateValue((product,), (state["last"],))
        self._keep(state, timerValues)

    def _keep(self, state: dict, timers) -> None:
        if state["timer"] is not None:
            self.handle.deleteTimer(state["timer"])
        state["timer"] = timers.getCurrentProcessingTimeInMs() + self.idle_ms
        self.handle.registerTimer(state["timer"])
        self.cursor.update(tuple(state[f] for f in FIELDS))

    def _state(self) -> dict | None:
        held = self.cursor.get() if self.cursor.exists() else None
        return dict(zip(FIELDS, held, strict=True)) | {"recent": list(held[-1] or [])} if held else None

    @staticmethod
    def _closed(key: tuple, state: dict) -> dict:
        at = lambda c: pd.Timestamp(state[c], unit="us")
        facts = {c: state[c] for c in (*COUNTERS, "client_id", "visitor_id", "first_utm_source", "session_id")}
        return {"kind": "session", "brand_id": key[0], "identity": key[1], "session_start": at("start"), "session_end": at("last"), "session_time_spent_ms": (state["last"] - state["start"]) // 1000} | facts

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        out, state = [], self._state()
        arrived = pd.concat(list(rows)).sort_values(["sent", "topic", "partition", "offset"], kind="stable")
        arrived = arrived.astype(object).where(arrived.notna(), None)
        recent = set(state["recent"]) if state else set()
        for r in arrived.to_dict("records"):
            row = {"kind": "event", "brand_id": key[0], "identity": key[1], "event_id": r["event_id"], "value": r["value"], "late": bool(state and r["sent"] < state["sent"]), "replaced": bool(r["replaced"])}
            gap = r["micros"] - state["last"] if state else 0
            fresh = state is None or gap > self.timeout or gap < -self.slack
            row["backward"] = not fresh and gap < 0
            product = r["product"]
            if r["event_id"] in recent:
                row |= {"outcome": "duplicate", "session_id": state["session_id"]}
            elif product is not None and not fresh and self.claims.containsKey((product,)):
                row |= {"outcome": "repeated", "session_id": state["session_id"]}
            else:
                if fresh:
                    if state:
                        out.append(self._closed(key, state))
                        self.claims.clear()
                    state = {f: 0 for f in COUNTERS} | {
                        "session_id": session_id(*key, r["event_id"]), "start": r["micros"], "last": r["micros"], "sent": state["sent"] if state else r["sent"], "timer": state["timer"] if state else None,
                        "client_id": None, "visitor_id": None, "first_utm_source": None, "recent": state["recent"] if state else [],
                    }
                if product is not None:
                    self.claims.updateValue((product,), (r["micros"],))
                state["last"] = max(state["last"], r["micros"])
                for name in ("event_count", COUNTED.get(r["event_name"]), COUNTED.get(r["click_bucket"])):
                    if name:
                        state[name] += 1
                state["client_id"], state["visitor_id"] = r["client_id"] or state["client_id"], r["visitor_id"] or state["visitor_id"]
                state["first_utm_source"] = state["first_utm_source"] or r["utm_source"]
                state["recent"].append(r["event_id"])
                recent.add(r["event_id"])
                row |= {"outcome": "applied", "session_id": state["session_id"]}
            if state:
                state["sent"] = max(state["sent"], r["sent"])
            out.append(row)
        state["recent"] = state["recent"][-RECENT:]
        self._keep(state, timerValues)
        yield self._frame(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        state = self._state()
        self.cursor.clear()
        self.claims.clear()
        yield self._frame([self._closed(key, state)] if state else [])

    @staticmethod
    def _frame(rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame([[r.get(c) for c in NAMES] for r in rows], columns=NAMES).astype({"session_start": "datetime64[ns]", "session_end": "datetime64[ns]"})

    def close(self) -> None:
        pass


def keyed(messages: DataFrame) -> DataFrame:
    """What the state needs of each sound message with an identity: narrow, and with the record's value for the rows that are written."""
    micros = lambda c: F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {c})")
    product = F.when(F.col("event_name") == "product_added_to_cart", F.lower("product_id"))
    return ss.identified(messages).filter("identity is not null").select(
        "brand_id", "identity", "event_id", "event_name", "click_bucket", "client_id", "visitor_id", F.col("value").cast("string").alias("value"), fn.utm(F.col("url"), "utm_source").alias("utm_source"), product.alias("product"),
        micros("occurred_at").alias("micros"), (F.col("occurred_at") != F.col("client_time")).alias("replaced"), micros("cast(timestamp as timestamp_ntz)").alias("sent"), "topic", "partition", "offset",
    )


def assigned(messages: DataFrame, timeout_s: int = 1800, slack_s: int = 30, grace_s: int = 60, open_sessions: DataFrame | None = None) -> DataFrame:
    """Events with their sessions, and sessions as they close, of a stream of sound messages (``contract.messages``); rows as ``OUT`` says.

    Records of a batch are applied in order of sending (time, topic, partition, offset), batches in order of arrival, so a stream in order of sending gives the
    same rows however it is cut into batches. A record sent before one that was already applied is late: it is applied and marked, never dropped. State is
    kept by brand and identity in Spark's checkpointed store: one row a visitor and one a claimed product; a session that idles out leaves none.
    Messages without an identity are sessions of their own and stand in no state. ``open_sessions`` (``open_cursors`` of a batch) is where the stream goes on.
    """
    start = {"initialState": open_sessions.groupBy("brand_id", "identity")} if open_sessions is not None else {}
    found = keyed(messages).groupBy("brand_id", "identity").transformWithStateInPandas(statefulProcessor=Sessions(timeout_s, slack_s, grace_s), outputStructType=OUT, outputMode="Append", timeMode="ProcessingTime", **start)
    alone = ss.identified(messages).filter("identity is null").select(
        F.lit("event").alias("kind"), "brand_id", "identity", "event_id", F.col("value").cast("string").alias("value"), F.lit("applied").alias("outcome"), F.lit(False).alias("late"), F.lit(False).alias("backward"),
        (F.col("occurred_at") != F.col("client_time")).alias("replaced"), fn.session_uuid(F.concat_ws("|", "brand_id", "event_id")).alias("session_id"),
    )
    return found.unionByName(alone, allowMissingColumns=True)


def open_cursors(events: DataFrame) -> DataFrame:
    """The last session of each visitor of a batch (``with_sessions``, rows that count) as the state that a stream goes on from."""
    micros = lambda c: F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {c})")
    own = ss.visitor(events)
    claims = F.collect_set(F.when(F.col("event_name") == "product_added_to_cart", F.lower("product_id"))).alias("claims")
    rows = ss.session_rows(events, more=[claims], names=False)
    last = F.max_by(F.struct(*[c for c in rows.columns if c not in own]), "session_no").alias("s")
    named = rows.groupBy(*own).agg(last).select(*own, "s.*")
    brand = F.col("brand_id") if "brand_id" in own else F.lit("")
    return named.select(
        brand.alias("brand_id"), "identity", "session_id", micros("session_start").alias("start"), micros("session_end").alias("last"), micros("session_end").alias("sent"), F.lit(None).cast("long").alias("timer"), *COUNTERS,
        "client_id", F.lit(None).cast("string").alias("visitor_id"), "first_utm_source", F.array().cast("array<string>").alias("recent"), "claims",
    )


class KeyTable:
    """Ids that are stored, in a table partitioned by a hash of the id: a batch reads the partitions of its own ids and no others."""

    def __init__(self, path: str, key: str, parts: int = 64):
        self.path, self.key, self.parts = path, key, parts

    def fresh(self, batch: DataFrame, number: int) -> DataFrame:
        """Rows of ``batch`` whose id no other batch has stored, one of each id; redelivered batches get their own rows again."""
        part = F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")
        rows = batch.dropDuplicates([self.key]).withColumn("__part", part)
        touched = [r[0] for r in rows.select("__part").distinct().collect()]  # at most ``parts`` numbers
        known = self.stored(batch)
        if known is None:
            return rows.drop("__part")
        known = known.filter(F.col("part").isin(touched) & (F.col("batch") != number))
        return rows.join(known.select(F.col("key").alias(self.key)), self.key, "left_anti").drop("__part")

    def stored(self, like: DataFrame) -> DataFrame | None:
        spark = like.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        return spark.read.schema(f"key {like.schema[self.key].dataType.simpleString()}, part int, batch long").parquet(self.path)

    def store(self, rows: DataFrame, number: int) -> None:
        keys = rows.select(F.col(self.key).alias("key"), F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int").alias("part"), F.lit(number).cast("long").alias("batch"))
        keys.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part", "batch").parquet(self.path)


#: Counts of each batch, taken as it passes.
COUNTS = {"events": "kind = 'event'", "applied": "outcome = 'applied'", "repeated_adds": "outcome = 'repeated'", "duplicates": "outcome = 'duplicate'", "late": "late", "backward": "backward", "clock_replaced": "replaced", "sessions_closed": "kind = 'session'"}


class Counted(StreamingQueryListener):
    """Adds up what ``observed`` counts, by query name."""

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = event.progress.observedMetrics.get("counts")
        if row is not None:
            own = self.totals.setdefault(event.progress.name, {})
            for k, v in row.asDict().items():
                own[k] = own.get(k, 0) + (v or 0)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def observed(rows: DataFrame) -> DataFrame:
    return rows.observe("counts", *[F.count_if(F.expr(f"coalesce({where}, false)")).alias(name) for name, where in COUNTS.items()])


def write(base: str, parts: int = 64):
    """A ``foreachBatch`` sink: events with their sessions, clicks, closed sessions. Each batch replaces its own folders, ids that other batches stored are left out, and
    ids are stored last, so that a batch that failed midway is written whole when it comes again."""
    keys = KeyTable(f"{base}/event_ids", "event_id", parts)

    def save(rows: DataFrame, name: str, number: int) -> None:
        kept = rows.withColumn("batch", F.lit(number).cast("long"))
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{base}/{name}")

    def sink(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            applied = held.filter("kind = 'event' and outcome = 'applied'").select("event_id", "identity", "session_id", "value")
            fresh = keys.fresh(applied, number).persist()
            typed = contract.messages(contract.parsed(fresh)).join(fresh.select("event_id", "session_id"), "event_id")
            save(contract.event_rows(typed, "session_id"), "events", number)
            save(contract.click_rows(typed, "session_id"), "clicks", number)
            save(held.filter("kind = 'session'").select("brand_id", "identity", *[f.split()[0] for f in FACTS.split(", ")]), "sessions", number)
            keys.store(fresh, number)
            fresh.unpersist()
        finally:
            held.unpersist()

    return sink


def run(records: DataFrame, base: str, name: str = "sessions", timeout_s: int = 1800, trigger: dict | None = None, open_sessions: DataFrame | None = None) -> list[StreamingQuery]:
    """Starts the two queries of a stream of broker records: refused ones to ``dead_letters``, all others through the state to tables under ``base``."""
    how = trigger or {"availableNow": True}
    records.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)  # the one that timers and map states need
    checked = contract.parsed(records)
    dead = contract.dead_letters(checked).writeStream.format("parquet").option("path", f"{base}/dead_letters").option("checkpointLocation", f"{base}/checkpoints/dead").queryName(f"{name}_dead").trigger(**how).start()
    rows = observed(assigned(contract.messages(checked), timeout_s, open_sessions=open_sessions))
    live = rows.writeStream.foreachBatch(write(base)).option("checkpointLocation", f"{base}/checkpoints/{name}").queryName(name).outputMode("append").trigger(**how).start()
    return [dead, live]
