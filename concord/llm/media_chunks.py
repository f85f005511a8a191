"""Media columns over content-defined chunks (operator 6).

A text's bytes, padded, become the samples of an 8-bit mono WAV file: a header of 44 bytes and the payload. The file is
cut where a rolling gear hash of the last 16 bytes has its top bits clear, so equal passages in different files fall into equal
chunks wherever they stand. A chunk is known by its SHA-256; a file is an ordered list of chunk digests.

Storing. One pass lists all chunks (digests only). Spark counts them, and those that occur more than once are marked in a bitmap of
fixed size that is broadcast: a set bit says "maybe shared", a clear bit says "surely in one file only". A second
pass stores, for each row, its chunk list and the chunks that are surely its own, in place; chunks that may be shared go to a
store of their own, one copy for each digest. A file that has none of them is read back where it lies; one that has is shuffled once, with the bytes of its own, to meet the shared ones. When
a huge corpus fills the bitmap, more chunks take the shuffled way; the result is the same.

Reading back. Rows that own all their chunks are rebuilt where they lie. For the others, one row for each distinct file
asks the store for its chunks by a join on the digest, and the chunks are put in order. Every file is verified against its
SHA-256 before its payload and features are computed; equal files then share the result by a join on that digest.

Cases: a null or empty text has 0 bytes and a payload of one unit. Repeated rows each get the same values. An empty table gives an
empty result. Input columns other than the id and the text are ignored. A very long text is cut and rebuilt within one
task, like any row.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.session import shared_path

UNIT = 576
FILL = b"\xff"
TAIL = 32
SAMPLE_RATE = 8000
HEADER = 44
#: Chunks: at least LEAST bytes, cut where CUT_BITS bits of the gear hash are clear, at most MOST bytes.
LEAST, CUT_BITS, MOST = 512, 11, 16384
FILTER_BITS = 1 << 24
GEAR_SEED = 20240229


def gear_table() -> np.ndarray:
    """A 16-bit number for each byte value, drawn once from a fixed seed."""
    return np.random.default_rng(GEAR_SEED).integers(0, 1 << 16, size=256, dtype=np.uint16)


_GEAR = gear_table()


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte: the sum of gear[b] << age over the last 16 bytes, in 16 bits.

    A shift by 16 clears a 16-bit number, so the window follows from the width. Sums over windows of 1, 2, 4 and 8 bytes
    are doubled, which takes four passes instead of sixteen."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8):
        older = np.zeros_like(h)
        older[width:] = h[:-width] << np.uint16(width)
        h = h + older
    return h


def chunk_ends(data: bytes) -> list[int]:
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    # The high bits depend on all 16 bytes of the window.
    cuts = np.flatnonzero(gear_hashes(np.frombuffer(data, dtype=np.uint8)) >> np.uint16(16 - CUT_BITS) == 0) + 1
    ends, at = [], 0
    while n - at > LEAST:
        k = int(np.searchsorted(cuts, at + LEAST))
        at = min(int(cuts[k]) if k < len(cuts) else n, at + MOST, n)
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def payload_of(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(1, -(-len(raw) // UNIT)) * UNIT
    return raw.ljust(size, FILL), len(raw)


def to_media(payload: bytes) -> bytes:
    """A WAV file: 8-bit unsigned samples, one channel."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, SAMPLE_RATE, SAMPLE_RATE, 1, 8, b"data", len(payload))
    return head + payload


def from_media(media: bytes) -> bytes:
    kind, _, wave, _, _, code, channels, _, _, _, bits, _, size = struct.unpack("<4sI4s4sIHHIIHH4sI", media[:HEADER])
    if (kind, wave, code, channels, bits) != (b"RIFF", b"WAVE", 1, 1, 8) or HEADER + size != len(media):
        raise ValueError("not an 8-bit mono WAV file of the stated size")
    return media[HEADER:]


def features(payload: bytes) -> str:
    """Of the signal around its middle value: duration, mean, root mean square and zero crossings."""
    x = np.frombuffer(payload, dtype=np.uint8).astype(np.int64) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return f"ms={1000 * len(x) // SAMPLE_RATE};mean={int(x.sum()) * 1000 // len(x)};rms={int(1000 * np.sqrt((x * x).sum() / len(x)))};zero={crossings}"


RESULT = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, feature string"


def read_media(media: bytes, digest: bytes) -> tuple:
    """The RESULT of a file that was read back; fails where it isn't the file that was stored."""
    if hashlib.sha256(media).digest() != digest:
        raise ValueError(f"media {digest.hex()} differs from what was stored")
    payload = from_media(media)
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-TAIL:]), len(media), features(payload)


def _places(halves: np.ndarray, bits: int) -> np.ndarray:
    """Places in the bitmap: one for each half of a 16-byte digest part."""
    return halves % np.uint64(bits)


def cut(media: bytes) -> list[bytes]:
    return [media[a:b] for a, b in itertools.pairwise([0, *chunk_ends(media)])]


def list_chunks(texts: DataFrame) -> DataFrame:
    """digest_part: the first 16 bytes of the digest of every chunk of every file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = [hashlib.sha256(c).digest()[:16] for t in b.column(1) for c in cut(to_media(payload_of(t.as_py())[0]))]
            yield pa.RecordBatch.from_arrays([pa.array(seen, type=pa.binary())], names=["digest_part"])

    return texts.mapInArrow(run, "digest_part binary")


def shared_bitmap(chunks: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of the chunks that occur more than once, in bytes: at most bits / 32 rows reach the driver."""
    shared = chunks.groupBy("digest_part").agg(F.count("*").alias("n")).where("n > 1")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = _places(np.frombuffer(b"".join(b.column(0).to_pylist()), dtype="<u8"), bits)
            yield pa.RecordBatch.from_arrays([pa.array((found // 32).astype(np.int64)), pa.array(np.int64(1) << (found % 32).astype(np.int64))], names=["word", "bit"])

    words = shared.select("digest_part").mapInArrow(places, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bitmap = np.zeros(bits // 32, dtype="<u4")
    bitmap[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return bitmap.view(np.uint8)


def maybe_shared(bitmap: np.ndarray, digests: list[bytes]) -> np.ndarray:
    places = _places(np.frombuffer(b"".join(d[:16] for d in digests), dtype="<u8"), 8 * len(bitmap)).reshape(-1, 2)
    return ((bitmap[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


ROWS = "n_bytes long, media_sha256 binary, chunk_digests array<binary>, lengths array<int>, own array<boolean>, body binary"


def store_rows(texts: DataFrame, marked: Broadcast) -> DataFrame:
    """One row for each text: its chunk list, and the chunks that are surely its own in `body`."""
    names = ["doc_id", *(part.split()[0] for part in ROWS.split(", "))]
    types = [pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.binary()]

    def row(text: str | None) -> tuple:
        payload, n = payload_of(text)
        media = to_media(payload)
        chunks = cut(media)
        digests = [hashlib.sha256(c).digest() for c in chunks]
        own = (~maybe_shared(marked.value, digests)).tolist()
        body = b"".join(c for c, mine in zip(chunks, own, strict=True) if mine)
        return n, hashlib.sha256(media).digest(), digests, [len(c) for c in chunks], own, body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [row(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)]], names=names)

    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, {ROWS}")


def store_shared(texts: DataFrame, marked: Broadcast) -> DataFrame:
    """digest and bytes of the chunks that may be shared, one copy for each digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = marked.value
        for b in batches:
            found: dict[bytes, bytes] = {}
            for t in b.column(1):
                chunks = cut(to_media(payload_of(t.as_py())[0]))
                digests = [hashlib.sha256(c).digest() for c in chunks]
                found.update((d, c) for d, c, m in zip(digests, chunks, maybe_shared(bitmap, digests), strict=True) if m)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), type=pa.binary()), pa.array(list(found.values()), type=pa.binary())], names=["digest", "bytes"])

    return texts.mapInArrow(run, "digest binary, bytes binary").dropDuplicates(["digest"])


def store(docs: DataFrame, id_col: str, text_col: str, filter_bits: int) -> tuple[str, str]:
    """Paths of the rows and of the shared chunks, as Parquet tables in the shared folder."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marked = spark.sparkContext.broadcast(shared_bitmap(list_chunks(texts), filter_bits))
    rows_path, chunks_path = shared_path(spark, "media-rows"), shared_path(spark, "media-chunks")
    store_rows(texts, marked).write.option("compression", "zstd").parquet(rows_path)
    store_shared(texts, marked).write.option("compression", "zstd").parquet(chunks_path)
    return rows_path, chunks_path


def rebuild_own(rows: DataFrame) -> DataFrame:
    """media_sha256 and RESULT of rows that own all their chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests = b.column(0).to_pylist()
            yield _results(digests, (read_media(body.as_py(), d) for d, body in zip(digests, b.column(1), strict=True)))

    return rows.select("media_sha256", "body").mapInArrow(run, f"media_sha256 binary, {RESULT}")


def _results(digests: list[bytes], results) -> pa.RecordBatch:
    rows = list(results)
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    columns = [pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)]
    return pa.RecordBatch.from_arrays([pa.array(digests, type=pa.binary()), *columns], names=["media_sha256", *(p.split()[0] for p in RESULT.split(", "))])


def rebuild_shared(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    """media_sha256 and RESULT of the distinct files that need chunks of the shared store."""
    files = rows.dropDuplicates(["media_sha256"])
    listed = files.select(F.col("media_sha256").alias("file"), F.posexplode(F.arrays_zip("chunk_digests", "own")).alias("seq", "c"))
    wanted = listed.where("NOT c.own").select("file", "seq", F.col("c.chunk_digests").alias("digest"))
    sent = wanted.join(chunks, "digest").select("file", "seq", "bytes")

    def put_together(key: tuple, own: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        found, file, at = dict(zip(sent["seq"], sent["bytes"], strict=True)), own.iloc[0], 0
        parts = []
        for seq, (mine, length) in enumerate(zip(file["own"], file["lengths"], strict=True)):
            parts.append(file["body"][at : at + length] if mine else found[seq])
            at += length if mine else 0
        result = read_media(b"".join(parts), key[0])
        return pd.DataFrame([(key[0], *result)], columns=["media_sha256", *(p.split()[0] for p in RESULT.split(", "))])

    return files.groupBy("media_sha256").cogroup(sent.groupBy("file")).applyInPandas(put_together, f"media_sha256 binary, {RESULT}")


def media_features(docs: DataFrame, filter_bits: int = FILTER_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media_sha256 (binary) and RESULT of every row, from files that were stored and read back."""
    spark = docs.sparkSession
    rows_path, chunks_path = store(docs, id_col, text_col, filter_bits)
    rows, chunks = spark.read.parquet(rows_path), spark.read.parquet(chunks_path)
    alone = F.forall("own", lambda o: o)
    results = rebuild_own(rows.where(alone)).unionByName(rebuild_shared(rows.where(~alone), chunks))  # a file is in one of the two, once
    return rows.select("doc_id", "n_bytes", "media_sha256").join(results, "media_sha256")


def op6_gear_chunks(spark, sf_dir: str) -> DataFrame:
    found = media_features(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", F.lower(F.hex("media_sha256")).alias("media_sha256"), "feature")
