"""Target-distribution importance resampling with a streaming CRC ring (operator 13).

Features of a text are its runs of 1 to n consecutive words, hashed into buckets: CRC-32 of the words joined by a space, modulo the
number of buckets. One scan of a document keeps the zlib states of the last n starts; each word extends every state by a space and
itself, starts a new one, and each state gives a bucket. No run of words is ever put together, and a scan holds n numbers.

Bucket counts of raw and target texts are summed within each task and then by Spark, one row a bucket. They give each bucket a gain, the
logarithm of how much more frequent it is in the target; a document's weight is the mean gain of its features. Scores add noise of a
Gumbel distribution that follows from the document's id, so that the highest scores are a draw without replacement in proportion to
exp(weight). Documents are numbered in the order of scores by sorted ranges and the counts of the ranges before, so no task holds more
than a range. Only the gains, one number a bucket, are sent to all tasks.

Cases: null or wordless texts have no features and weight 0. Very long texts are scanned word by word. Repeated rows are drawn each for itself. Of equal
scores the smaller id comes first, then the row with fewer features and the smaller weight. A document without id counts in the corpus but has no score and is not drawn. Empty
tables count as no features; an empty corpus gives an empty result. Columns other than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.session import cut_lineage

BUCKETS = 10_000
#: A-Z become a-z; ASCII characters other than letters and digits become blanks, all others stay.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def ring(words: list[bytes], longest: int) -> Iterator[int]:
    """The CRC-32 of every run of 1 to `longest` words joined by a space, by the word that the run ends with."""
    if longest == 1:  # a ring of one state, which every word starts anew
        yield from map(crc32, words)
        return
    states: list[int] = []
    for word in words:
        states = [crc32(word), *[crc32(word, crc32(b" ", s)) for s in states[: longest - 1]]]
        yield from states


def buckets_of(text: str | None, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of each feature."""
    words = words_of(text)
    return len(words), np.fromiter(ring(words, longest), dtype=np.int64) % buckets


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS, text_col: str = "text") -> DataFrame:
    """(bucket, n) of all features of all texts, for buckets that occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for t in b.column(0):
                found += np.bincount(buckets_of(t.as_py(), longest, buckets)[1], minlength=buckets)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["bucket", "n"])

    counted = texts.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket in thousandths, from (bucket, n) of raw and target texts; a feature more in every bucket stands for those that were not seen.

    What reaches the driver is one row a bucket at most."""
    held = []
    for counts in (raw, target):
        found = counts.toPandas()
        n = np.zeros(buckets)
        n[found["bucket"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.float64)
        held.append(n)
    s, t = held
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, longest: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and weight (floored mean gain of the features, in thousandths) of each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(n, len(f), int(gain[f].sum()) // len(f) if len(f) else 0) for n, f in (buckets_of(t.as_py(), longest, len(gain)) for t in b.column(1))]
            columns = [pa.array([r[k] for r in rows], type=pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", "n_words", "n_features", "weight"])

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows with their number, from 1, in a total order. Rows are sorted by range; a range's numbers start where the counts of those before it end."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    dealt = cut_lineage(dealt.withColumn("__at", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))))  # the number within the range
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = dealt.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", before.alias("__before"))  # a row for each range
    return dealt.join(F.broadcast(starts), "__part").withColumn(name, F.col("__before") + F.col("__at") + 1).drop("__part", "__at", "__before")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = BUCKETS, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of each row of docs; rank is null for those that are not drawn.

    `percent` of the documents with at least `least_words` words are drawn, rounded down. target has a text column of the same name."""
    gain = gains(bucket_counts(docs, longest, buckets, text_col), bucket_counts(target, longest, buckets, text_col), buckets)
    scored = cut_lineage(weighted(docs, gain, longest, id_col, text_col).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    eligible = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    order = [F.col("score").desc(), F.col("doc_id"), F.col("n_features"), F.col("weight")]
    ranked = numbered(scored.where(eligible), order, "rank")
    drawn = scored.where(eligible).count() * percent // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.where(~eligible).withColumn("rank", F.lit(None).cast("long")))


def op13_crc_ring_resampling(spark, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
