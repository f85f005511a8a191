"""Login throttling: of a user's events, those that come more than an interval after the last emitted one.

What is emitted depends on the emission before. Most users' events are run through in order, many users to a task. A busy user's time is cut into
cells: for the few events that can be a cell's first emission, the last emission of the cell is found in parallel; these steps from cell to
cell are composed by doubling, which tells the first emission of every cell; then all cells emit in parallel."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concord.session import cut_lineage

#: Stands for the first emission of a cell that has none.
NONE = -(1 << 63)


def throttle(events: DataFrame, key: str, ts: str, seconds: int, busy_rows: int = 1_000_000) -> DataFrame:
    """(key, ts) of the emitted events. Equal times count once; null times are left out; events with a null key are one user's.

    A user of more than busy_rows events is dealt over cells of about so many; a cell is at least an interval wide."""
    gap = seconds * 1_000_000
    rows = events.select(F.col(key).alias("user"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us")).where("us IS NOT NULL")
    counts = rows.groupBy("user").agg(F.count("*").alias("n"), F.min("us").alias("low"), F.max("us").alias("high"))
    width = F.greatest(F.lit(gap), F.ceil((F.col("high") - F.col("low") + 1) / F.ceil(F.col("n") / busy_rows)).cast("long"))
    busy = cut_lineage(counts.where(F.col("n") > busy_rows).select(F.col("user").alias("busy_user"), "low", width.alias("width"), F.monotonically_increasing_id().alias("b")))
    met = F.col("user").eqNullSafe(F.col("busy_user"))
    if busy.isEmpty():
        emitted = _in_order(rows, gap)
    else:
        hot = rows.join(busy, met).select("b", "us", "low", "width", F.floor((F.col("us") - F.col("low")) / F.col("width")).cast("long").alias("cell"))
        of_busy = _in_cells(hot, gap).join(busy, "b").select(F.col("busy_user").alias("user"), "us")
        emitted = _in_order(rows.join(busy, met, "left_anti"), gap).unionByName(of_busy)
    return emitted.select(F.col("user").alias(key), F.timestamp_micros("us").alias(ts))


def _in_order(rows: DataFrame, gap: int) -> DataFrame:
    """(user, us) of the emitted ones of rows (user, us): dealt by user, sorted by Spark (which spills) and run through in one pass that holds a batch and the last emission."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user, last, begun = None, 0, False
        for b in batches:
            times, codes = b.column(1).to_numpy(), b.column(0).dictionary_encode().indices.fill_null(-1).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else []
            picked = []
            for at, end in zip(starts, [*starts[1:], len(codes)], strict=True):
                here = b.column(0)[at].as_py()
                if not begun or here != user:
                    user, last, begun = here, int(times[at]) - gap - 1, True
                while (at := at + int(np.searchsorted(times[at:end], last + gap, side="right"))) < end:  # a step for each emission
                    picked.append(at)
                    last = int(times[at])
            yield b.take(pa.array(picked, type=pa.int64()))

    return rows.repartition("user").sortWithinPartitions("user", "us").mapInArrow(run, rows.schema)


def _in_cells(hot: DataFrame, gap: int) -> DataFrame:
    """(b, us) of the emitted ones of hot (b, us, low, width, cell), where b is a user."""
    # A user has one row for each cell here, so the window over a user is small.
    number = F.row_number().over(Window.partitionBy("b").orderBy("cell")) - 1
    cells = cut_lineage(hot.select("b", "cell").distinct().withColumn("i", number.cast("long")))

    def entries(rows: pd.DataFrame) -> pd.DataFrame:
        """Each event that can be the first emission of this cell, with the last emission of the cell that follows from it."""
        times = np.unique(rows["us"].to_numpy(np.int64))
        start = int(rows["low"].iloc[0] + rows["cell"].iloc[0] * rows["width"].iloc[0])
        # The emission before is earlier than the cell, so the first event of all that are an interval into it is the last that can be first.
        n = min(int(np.searchsorted(times, start + gap, side="right")) + 1, len(times))
        after = np.searchsorted(times, times + gap, side="right")
        last = np.arange(n)
        while (more := after[last] < len(times)).any():
            last = np.where(more, np.minimum(after[last], len(times) - 1), last)
        return pd.DataFrame({"b": rows["b"].iloc[0], "cell": rows["cell"].iloc[0], "first": times[:n], "last": times[last]})

    nodes = cut_lineage(hot.groupBy("b", "cell").applyInPandas(entries, "b long, cell long, first long, last long").join(cells, ["b", "cell"]).select("b", "i", "first", "last"))
    nothing = cells.select("b", "i", F.lit(NONE).alias("first"), F.lit(NONE).alias("last"))  # a cell without emission: the next starts with its first event
    reached = nodes.unionByName(nothing).select("b", (F.col("i") + 1).alias("i"), "first", F.when(F.col("last") == NONE, F.col("last")).otherwise(F.col("last") + gap).alias("after"))
    asked = nodes.select("b", "i", "first", F.lit(None).cast("long").alias("after")).unionByName(reached)

    def follow(rows: pd.DataFrame) -> pd.DataFrame:
        """For each way into this cell (first of the cell before, and the time after which it emits again) its first emission here."""
        ways = rows[rows["after"].notna()]
        times = np.sort(rows["first"][rows["after"].isna()].to_numpy(np.int64))
        at = np.searchsorted(times, ways["after"].to_numpy(np.int64), side="right")
        then = np.append(times, NONE)[at]
        return pd.DataFrame({"b": ways["b"], "i": ways["i"] - 1, "first": ways["first"], "then": then})[: len(ways) if len(times) else 0]

    step = cut_lineage(asked.groupBy("b", "i").applyInPandas(follow, "b long, i long, first long, then long"))
    count = cells.agg(F.max("i")).first()[0] + 1
    # steps[r] leads from the cells whose number 2 ** r divides to that many further.
    steps, width = [step], 1
    while 2 * width < count:
        here = steps[-1].where(F.col("i") % (2 * width) == 0)
        further = steps[-1].select("b", (F.col("i") - width).alias("i"), F.col("first").alias("then"), F.col("then").alias("further"))
        steps.append(cut_lineage(here.join(further, ["b", "i", "then"]).select("b", "i", "first", F.col("further").alias("then"))))
        width *= 2
    first = cut_lineage(nodes.where("i = 0").groupBy("b", "i").agg(F.min("first").alias("first")))
    for step in reversed(steps):
        reached = first.join(step, ["b", "i", "first"]).select("b", (F.col("i") + width).alias("i"), F.col("then").alias("first"))
        first, width = cut_lineage(first.unionByName(reached)), width // 2
    begins = first.where(F.col("first") != NONE).join(cells, ["b", "i"]).select(F.col("b").alias("of"), F.col("cell").alias("in"), "first")

    def emit(rows: pd.DataFrame, begin: pd.DataFrame) -> pd.DataFrame:
        times, out = np.unique(rows["us"].to_numpy(np.int64)), []
        at = int(np.searchsorted(times, begin["first"].iloc[0])) if len(begin) else len(times)
        while at < len(times):
            out.append(int(times[at]))
            at = int(np.searchsorted(times, times[at] + gap, side="right"))
        return pd.DataFrame({"b": rows["b"].iloc[0] if len(rows) else 0, "us": out}, dtype="int64")

    return hot.select("b", "cell", "us").groupBy("b", "cell").cogroup(begins.groupBy("of", "in")).applyInPandas(emit, "b long, us long")


def throttle_in_state(last: int | None, times: list[int], gap: int) -> tuple[int | None, list[int]]:
    """The same rule for one user's new times, given the last emitted one."""
    out = []
    for t in sorted(times):
        if last is None or t - last > gap:
            out.append(t)
            last = t
    return last, out
