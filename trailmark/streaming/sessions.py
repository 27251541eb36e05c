"""Streaming sessionization: keyed session state with an idle sweep, a sink that drops redelivered rows, and the dead-letter branch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from . import contract

CLOSED = "identity string, session_no long, session_start timestamp_ntz, session_end timestamp_ntz, session_time_spent_ms long, event_count long"
STATE = "number long, start long, last long, count long, claims array<string>"


def _state_machine(timeout_s: int, slack_s: int, grace_s: int):
    def close(key: str, number: int, start: int, last: int, count: int) -> tuple:
        return key, number, pd.Timestamp(start, unit="us"), pd.Timestamp(last, unit="us"), (last - start) // 1000, count

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out = []
        number, start, last, count, claims = state.get if state.exists else (0, 0, 0, 0, [])
        if state.hasTimedOut:
            out.append(close(key[0], number, start, last, count))
            state.remove()  # the next event of this visitor is a first one again
        else:
            rows = pd.concat(list(batches)).sort_values(["micros", "seq"], kind="stable")
            claimed = set(claims)
            for micros, name, product in zip(rows["micros"].tolist(), rows["event_name"].tolist(), rows["product_id"].tolist(), strict=True):
                gap = micros - last
                fresh = count == 0 or gap > timeout_s * 1_000_000 or gap < -slack_s * 1_000_000
                once = product.lower() if name == "product_added_to_cart" and product is not None else None
                if once is not None and not fresh and once in claimed:
                    continue  # a repeated add leaves the session untouched
                if fresh:
                    if count:
                        out.append(close(key[0], number, start, last, count))
                    number, start, last, count, claimed = number + 1, micros, micros, 0, set()
                if once is not None:
                    claimed.add(once)
                last, count = max(last, micros), count + 1
            state.update((number, start, last, count, sorted(claimed)))
            state.setTimeoutDuration((timeout_s + grace_s) * 1000)
        columns = ["identity", "session_no", "session_start", "session_end", "session_time_spent_ms", "event_count"]
        yield pd.DataFrame(out, columns=columns)

    return step


def closed_sessions(rows: DataFrame, timeout_s: int = 1800, slack_s: int = 30, grace_s: int = 60) -> DataFrame:
    """Sessions of a stream as they close: by the visitor's next event, or by the idle sweep (a processing-time timer).

    The sweep runs in batches without data, so a run that is to end with its input (``availableNow``) turns those off
    (``spark.sql.streaming.noDataMicroBatches.enabled``) and leaves the last sessions open in its state. Sessions are numbered from 1 again once a visitor has idled out, as nothing is kept of visitors who are gone. A gap above ``timeout_s``, or more than ``slack_s`` back, opens a session; a smaller step back stays in it and does not move its end. Late
    rows are applied in order of arrival, never dropped. State is one row a visitor, in Spark's checkpointed store, and its cart claims
    go with each session. Rows without identity have no session.
    """
    known = rows.withColumn("identity", F.coalesce("actor_id", "client_id")).filter("identity is not null")
    thin = known.select("identity", F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', occurred_at)").alias("micros"), "seq", "event_name", "product_id")
    return thin.groupBy("identity").applyInPandasWithState(_state_machine(timeout_s, slack_s, grace_s), CLOSED, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def append_new(path: str, key: str, within: str | None = None):
    """A ``foreachBatch`` sink whose redelivered batches are no-ops: each batch replaces its own folder, and keys stored by others are left out.

    ``within`` names a date column by which the table is partitioned: only the days of the batch are then read for keys, not the whole table.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, fresh = batch.sparkSession, batch.dropDuplicates([key])
        try:
            stored = spark.read.schema(batch.schema.add("batch", "long")).parquet(path).filter(F.col("batch") != number)
            if within:
                span = batch.agg(F.min(within).alias("lo"), F.max(within).alias("hi")).first()
                stored = stored.filter(F.col(within).between(F.lit(span.lo), F.lit(span.hi)))
            fresh = fresh.join(stored.select(key), key, "left_anti")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
        by = ["batch", within] if within else ["batch"]
        fresh.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    return write


def split_records(good: str, dead: str):
    """A ``foreachBatch`` sink for raw records: refused ones are written, with their reasons, before sound ones, so that none is lost when the second write fails."""

    def write(batch: DataFrame, number: int) -> None:
        checked = contract.parsed(batch).persist()
        letters = contract.dead_letters(checked).withColumn("batch", F.lit(number).cast("long"))
        letters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(dead)
        sound = contract.messages(checked).drop("v").withColumn("batch", F.lit(number).cast("long"))
        sound.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(good)
        checked.unpersist()

    return write
