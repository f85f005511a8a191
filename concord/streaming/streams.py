"""Structured Streaming forms: login throttling with state, and routing of change notices."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from concord.config import Config
from concord.operators import notices
from concord.operators.notices import allowed, route
from concord.operators.throttle import throttle_in_state


def throttle_stream(events: DataFrame, key: str, ts: str, seconds: int, watermark: str | None = None, groups: int = 1024) -> DataFrame:
    """(key, ts) of the emitted events of a stream. State is one number a user: the last emitted time.

    Agrees with the batch form when a user's events arrive in the order of time; an event earlier than the last emitted one is
    within the interval and so is not emitted. watermark says how late events may come: later ones are dropped, and a user is forgotten once the
    watermark is past the interval after the last emission, when whatever still comes is emitted anyway. Without one state stays for ever.

    Spark makes frames of its own of each group that it hands to Python, which takes milliseconds. So users are dealt over so many groups by the hash of
    their key, and a group's state is the last times of its users; users without a key are a group. Streams that differ in groups share no checkpoint."""
    gap = seconds * 1_000_000
    kind = events.schema[key].dataType.simpleString()
    timed = events.select(F.col(key), F.col(ts).cast("timestamp").alias("at")).where("at IS NOT NULL")
    dealt = F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(F.col(key)), F.lit(groups))).otherwise(-1)
    rows = (timed.withWatermark("at", watermark) if watermark else timed).withColumn("us", F.unix_micros("at")).withColumn("dealt", dealt)

    def same(users: list) -> list:
        """Numbers that are none are one user, as they are to Spark."""
        return [user if user == user else math.nan for user in users]

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = dict(zip(same(state.get[0]), state.get[1], strict=True)) if state.exists else {}
        times: dict[object, list[int]] = {}
        for b in batches:
            users = [None] * len(b) if group[0] < 0 else same(b[key].tolist())
            for user, t in zip(users, b["us"].tolist(), strict=True):
                times.setdefault(user, []).append(t)
        users, out = [], []
        for user, new in times.items():
            last[user], emitted = throttle_in_state(last.get(user), new, gap)
            users += [user] * len(emitted)
            out += emitted
        until = {user: (t + gap) // 1000 + 1 for user, t in last.items()}
        if watermark:
            past = state.getCurrentWatermarkMs()
            last = {user: t for user, t in last.items() if until[user] > past}
        if last:
            state.update((list(last), list(last.values())))
            if watermark:
                state.setTimeoutTimestamp(max(until.values()))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame({key: users, "us": out})

    timeout = GroupStateTimeout.EventTimeTimeout if watermark else GroupStateTimeout.NoTimeout
    emitted = rows.groupBy("dealt").applyInPandasWithState(step, f"{key} {kind}, us long", f"users array<{kind}>, last array<long>", "append", timeout)
    return emitted.select(key, F.timestamp_micros("us").alias(ts))


def route_stream(items: DataFrame, table: DataFrame) -> DataFrame:
    """A stream of notice items with their route, without those that are not configured; stateless."""
    return allowed(items, table).withColumn("route", route(F.col("entity_type"), F.col("event")))


def notice_stream(bodies: DataFrame, config: Config) -> DataFrame:
    """A stream of request bodies (text column `value`) as routed items: idp, provider, auth_method, entity_type, id, event, kc_id and route.

    Stateless: senders, types, events and keys are checked as in a batch, and items of a broken request go; users are looked up where the route is worked off."""
    named = notices.with_sender(bodies.select(F.col("value").alias("raw")), bodies.sparkSession, config)
    items = notices.expand_judged(named, config).where("allowed AND NOT broken")
    return items.select("idp", "provider", "auth_method", "entity_type", "id", "event", "kc_id", notices.route(F.col("entity_type"), F.col("event")).alias("route"))


def write_routes(routed: DataFrame, path: str, checkpoint: str):
    """Starts a query that appends each micro-batch below path, in a folder for each route; a batch that is repeated replaces itself."""

    def put(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").partitionBy("route").parquet(f"{path}/batch={n}")

    return routed.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs a stream over all that is there now, appending to a Parquet table."""
    query = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
