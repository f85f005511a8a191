from __future__ import annotations

import hashlib
import io
import random
import wave
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from concord.llm import media_chunks as m


def slow_hash(data):
    out = []
    for i in range(len(data)):
        out.append(sum(int(m._GEAR[data[i - age]]) << age for age in range(16) if i - age >= 0) & 0xFFFF)
    return out


def test_gear_hash_rolls():
    data = random.Random(1).randbytes(300)
    assert m.gear_hashes(np.frombuffer(data, dtype=np.uint8)).tolist() == slow_hash(data)


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000, 200_000])
def test_chunks_cover_the_data(n):
    data = random.Random(n).randbytes(n)
    chunks = m.cut(data)
    assert b"".join(chunks) == data
    assert all(m.LEAST <= len(c) <= m.MOST for c in chunks[:-1])


def test_chunks_follow_the_content():
    rng = random.Random(2)
    passage = rng.randbytes(60_000)
    a, b = (set(m.cut(rng.randbytes(rng.randrange(9000)) + passage + rng.randbytes(3000))) for _ in range(2))
    assert sum(map(len, a & b)) > 50_000


def test_without_cuts_chunks_have_the_largest_size():
    assert {len(c) for c in m.cut(b"\x00" * (3 * m.MOST))} <= {m.MOST, m.LEAST} or max(map(len, m.cut(b"\x00" * (3 * m.MOST)))) <= m.MOST


def test_media_is_a_wav_file():
    payload, n = m.payload_of("grüße")
    media = m.to_media(payload)
    with wave.open(io.BytesIO(media)) as w:
        assert (w.getnchannels(), w.getsampwidth(), w.readframes(w.getnframes())) == (1, 1, payload)
    assert n == 7 and len(payload) == 576 and m.from_media(media) == payload
    with pytest.raises(ValueError, match="not an 8-bit"):
        m.from_media(media + b"x")
    with pytest.raises(ValueError, match="differs"):
        m.read_media(media, b"\0" * 32)


def expected(text):
    raw = (text or "").encode()
    payload = raw.ljust(max(1, -(-len(raw) // 576)) * 576, b"\xff")
    return len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(payload) + 44


def test_documents(spark, sf_dir, documents):
    rows = {r["doc_id"]: tuple(r)[1:6] for r in m.op6_gear_chunks(spark, sf_dir).collect()}
    assert rows == {r["doc_id"]: expected(r["text"]) for r in documents.collect()}


@pytest.mark.parametrize("bits", [1 << 10, 1 << 24])
def test_shared_chunks(spark, bits):
    """Files that share passages, whole copies and a bitmap that is all but full."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(3000))
    texts = [" ".join(word() for _ in range(rng.randrange(900))) + (passage if k % 3 == 0 else "") for k in range(30)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100 + k, texts[k % 5]) for k in range(15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_bytes"]) for r in m.media_features(docs, bits).collect()}
    assert found == {i: expected(t) for i, t in rows}
    rows_path, chunks_path = m.store(docs, "doc_id", "text", bits)
    stored = spark.read.parquet(chunks_path)
    assert stored.count() == stored.select("digest").distinct().count()
    if bits == 1 << 24:
        kept = spark.read.parquet(rows_path).agg(F.sum(F.length("body"))).first()[0] + stored.agg(F.sum(F.length("bytes"))).first()[0]
        assert kept < 0.6 * sum(expected(t)[4] for _, t in rows)


def test_odd_documents(odd_documents, no_documents):
    texts = {r["doc_id"]: r["text"] for r in odd_documents.collect()}
    rows = m.media_features(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_bytes"]) == expected(texts[r["doc_id"]])
    assert m.media_features(no_documents).collect() == []
