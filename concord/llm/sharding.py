"""Contiguous minimax sharding of documents (operator 1).

Documents are grouped by text; groups fall into an ordered list of atomic bins by the hash of
their text, so equal texts always share a bin. The bins' byte sizes, at most `n_bins` numbers
whatever the corpus holds, go to the driver. There the smallest capacity for which a greedy
sweep needs no more than `n_shards` shards is found by binary search, and the list is cut so
that no shard exceeds it. A bin larger than an even share (a hot text) would set the capacity
for all; each such bin takes a shard of its own first and the rest are balanced among
the shards left, which changes no maximum.

Slots number the rows of a shard without gaps. They come from row numbers in small hash chunks
of a shard plus the chunk's offset, so no task ever holds a whole shard.

Cases: a very long text is a size like any other. Bins of equal size keep their order. A null text has 0 bytes, checksum 0 and the empty text's group. Repeated rows each get
their own slot, in any order among themselves. An empty table gives an empty result. Columns of the input other than the id
and the text are ignored, whatever their names. A null id is a value like any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concord.session import cut_lineage

ROW_OVERHEAD = 16


def _reach(prefix: np.ndarray, start: int, capacity: int) -> int:
    return int(np.searchsorted(prefix, prefix[start] + capacity, side="right")) - 1


def _feasible(prefix: np.ndarray, shards: int, capacity: int) -> bool:
    at, end = 0, len(prefix) - 1
    for _ in range(shards):
        at = _reach(prefix, at, capacity)
        if at >= end:
            return True
    return at >= end


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """The least capacity with which a greedy sweep over the ordered sizes needs at most `shards` shards."""
    if not len(sizes):
        return 0
    prefix = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    low, high = max(int(sizes.max()), -(-int(prefix[-1]) // shards)), int(prefix[-1])
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if _feasible(prefix, shards, mid) else (mid + 1, high)
    return low


def cut_points(sizes: np.ndarray, shards: int) -> list[int]:
    """Ends of the shards in the ordered sizes: none above the smallest capacity, each as near an even share as that allows."""
    n = len(sizes)
    capacity = smallest_capacity(sizes, shards)
    prefix = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    earliest = [n]  # earliest[k]: the first start from which k shards hold all that follows
    for _ in range(shards):
        earliest.append(int(np.searchsorted(prefix, prefix[earliest[-1]] - capacity, side="left")))
    ends, at = [], 0
    for left in range(shards, 0, -1):
        share = prefix[at] + (prefix[n] - prefix[at]) / left
        i = int(np.searchsorted(prefix, share))
        if i > at and i <= n and share - prefix[i - 1] < prefix[min(i, n)] - share:
            i -= 1
        at = min(max(i, earliest[left - 1], at), _reach(prefix, at, capacity), n)
        ends.append(at)
    return ends


def assign_bins(sizes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each bin. Bins above an even share of what is left go first, alone."""
    out = np.zeros(len(sizes), dtype=np.int32)
    order = np.argsort(-sizes, kind="stable")
    rest, taken = int(sizes.sum()), 0
    while taken < min(shards - 1, len(order)) and int(sizes[order[taken]]) * (shards - taken) > rest:
        out[order[taken]] = taken
        rest -= int(sizes[order[taken]])
        taken += 1
    keep = np.sort(order[taken:])
    start = 0
    for k, end in enumerate(cut_points(sizes[keep], shards - taken)):
        out[keep[start:end]] = taken + k
        start = end
    return out


def shard_documents(
    docs: DataFrame, n_shards: int = 40, n_bins: int = 1 << 17, rows_per_chunk: int = 50_000, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, size, text_crc32, shard and slot of every row of docs; n_bins bounds what reaches the driver and is broadcast."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = cut_lineage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.pmod(F.xxhash64(text), F.lit(n_bins)).cast("int").alias("bin"),
        )
    )
    bins = rows.groupBy("bin").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).orderBy("bin").toPandas()
    shard_of = pd.DataFrame({"bin": bins["bin"].astype("int32"), "shard": assign_bins(bins["bytes"].to_numpy("int64"), n_shards)})
    placed = spark.createDataFrame(shard_of, "bin int, shard int")
    chunks = max(256, int(bins["n"].sum()) // (n_shards * rows_per_chunk) + 1)
    rows = rows.join(F.broadcast(placed), "bin").withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(chunks)).cast("int"))
    counts = rows.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    within = Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("position", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["shard", "chunk"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first_slot") + F.col("position")).cast("long").alias("slot")
    )


def op1_minimax_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
