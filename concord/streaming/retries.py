"""Updates of entities as a keyed stream: in order within an entity, retried with a linear backoff, given up after so many attempts.

One task at a time has an entity's state, which is what a lock for each entity would give; an item that waits for its retry holds back those behind it."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RESULT = "item long, position long, status string, attempts int, waited_ms long"


def backoff_ms(attempt: int, initial_ms: int, step_ms: int) -> int:
    """The wait after a failed attempt, of which 0 is the first."""
    return initial_ms + attempt * step_ms


class Retries(StatefulProcessor):
    """Works off the items of an entity in their order. work(item, payload, attempt) says whether an attempt succeeded; it may run again for the same
    item and attempt when a batch is repeated, so it must bear that."""

    def __init__(self, work: Callable[[int, str | None, int], bool], attempts: int, initial_ms: int, step_ms: int, ttl_ms: int | None):
        self.work, self.attempts, self.initial_ms, self.step_ms, self.ttl_ms = work, attempts, initial_ms, step_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # The item that waits for its retry, and those behind it in any order.
        self.waiting = handle.getValueState("waiting", "attempt int, waited_ms long, sort long, item long, payload string")
        self.pending = handle.getListState("pending", "sort long, item long, payload string")
        # How many items of the entity are done; forgotten with an entity of which nothing is heard.
        self.done = handle.getValueState("done", "n long", self.ttl_ms)

    # A call of the state goes to the JVM and back, which costs more than working off an item, and so does each item of a list that is read or written. So
    # each state is read once at most and is written where it changes, and what is behind an item that waits is read once that is settled.

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = [(int(sort), int(item), None if pd.isna(payload) else payload) for part in rows for sort, item, payload in zip(part["sort"], part["item"], part["payload"], strict=True)]
        if self.waiting.get() is None:
            yield from self._work_off(sorted(new), None, timerValues)
        else:
            # What came first stays first: an item that waits for its retry isn't overtaken.
            self.pending.appendList(new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        waits = self.waiting.get()
        if waits is not None:
            attempt, waited, *head = waits
            settled = self._attempt(tuple(head), attempt, waited, timerValues)
            if settled is not None:
                yield from self._work_off(sorted(tuple(i) for i in self.pending.get()), settled, timerValues)

    def close(self) -> None:
        pass

    def _attempt(self, entry: tuple, attempt: int, waited: int, timers) -> tuple | None:
        """What is settled of an item (sort, item, payload); None if it waits for another attempt."""
        _, item, payload = entry
        ok = self.work(item, payload, attempt)
        attempt += 1
        if not ok and attempt < self.attempts:
            wait = backoff_ms(attempt - 1, self.initial_ms, self.step_ms)
            self.waiting.update((attempt, waited + wait, *entry))
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + wait)
            return None
        return item, "done" if ok else "timeout", attempt, waited

    def _work_off(self, items: list[tuple], retried: tuple | None, timers) -> Iterator[pd.DataFrame]:
        """items in their order; retried: what is settled of the one before them, if that had waited."""
        out, at, waits = [] if retried is None else [retried], 0, False
        while at < len(items) and not waits:
            settled = self._attempt(items[at], 0, 0, timers)
            at, waits = at + 1, settled is None
            if not waits:
                out.append(settled)
        if retried is not None and not waits:
            self.waiting.clear()
        if at < len(items):
            self.pending.put(items[at:])
        elif retried is not None and items:
            self.pending.clear()
        if out:
            before = self.done.get()
            first = before[0] if before is not None else 0
            self.done.update((first + len(out),))
            yield pd.DataFrame([(item, position, *how) for position, (item, *how) in enumerate(out, first)], columns=["item", "position", "status", "attempts", "waited_ms"])


def retry_stream(items: DataFrame, key: str, work: Callable[[int, str | None, int], bool], attempts: int = 10, initial_ms: int = 1000, step_ms: int = 1000, ttl_ms: int | None = None) -> DataFrame:
    """item, position (its number among those of its entity, from 0), status (done or timeout), attempts and waited_ms of each item once it is settled.

    items: a stream of key, sort (the order within an entity), item and payload (text for work). State is kept in RocksDB; see with_rocksdb."""
    rows = items.select(key, "sort", "item", "payload")
    return rows.groupBy(key).transformWithStateInPandas(Retries(work, attempts, initial_ms, step_ms, ttl_ms), RESULT, "append", "ProcessingTime")


@contextlib.contextmanager
def with_rocksdb(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB, which states with timers and lists need, and deal it over so many partitions.

    Every batch, also one that only has timers to look after, starts a task for each partition, so there should be about as many as cores."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.shuffle.partitions": str(partitions or spark.sparkContext.defaultParallelism)}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def run_until(stream: DataFrame, path: str, checkpoint: str, settled: Callable[[], bool], seconds: float = 3600, poll: float = 1.0, partitions: int | None = None) -> None:
    """Runs a stream with timers into a Parquet table until settled() says that all is there; an availableNow run would end before the last timers are due."""
    with with_rocksdb(stream.sparkSession, partitions):
        query = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
        try:
            left = seconds
            while not settled():
                if left <= 0:
                    raise TimeoutError(f"the stream did not settle in {seconds} seconds")
                query.awaitTermination(poll)
                if query.exception() is not None:
                    raise query.exception()
                left -= poll
        finally:
            query.stop()
