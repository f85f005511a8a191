from __future__ import annotations

import base64
import gzip
import hashlib
import re

import duckdb
import pytest

from concord.llm import warc_revisit as w
from concord.session import shared_path

ROWS = [
    (3, "http://a/", "<p>same</p>"), (1, "http://b/", "<p>same</p>"), (2, "http://c/", "<p>same</p>"), (4, "http://d/", "WARC/1.1\r\n\r\ntrap\r\n\r\n"), (5, None, "grüße 😀"), (6, "http://e/\r\nX: y", ""), (7, "http://f/", None),
    (1, "http://b/", "another"), (2, "http://b/2", "another"), (2, "http://b/2", "another"), (8, "http://g/", "x" * 300_000), (9, "http://h/", "repeat"), (9, "http://h/", "repeat"), (None, "http://i/", "nobody"), (10, "http://j/", "nobody"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", "y") for r in ROWS], "page_id long, url string, html string, digest string, id string")


def expected(rows, least=0):
    out = []
    key = lambda i: (i is not None, i or 0)
    for i, _, html in rows:
        raw = (html or "").encode()
        first = min((r[0] for r in rows if (r[2] or "").encode() == raw), key=key)
        revisit = len(raw) >= least and i != first
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 8])
def test_round_trip(pages, least):
    assert sorted(map(tuple, w.archive_and_resolve(pages, least).collect()), key=repr) == expected(ROWS, least)


def test_pages(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    rows += [(1000 + k, r[1], r[2]) for k, r in enumerate(rows[:7])]
    found = w.archive_and_resolve(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)
    assert w.op10_warc_revisits(spark, sf_dir).count() == len(rows) - 7


def test_archives_are_warc_files(spark, pages):
    path = shared_path(spark, "warc-test")
    w.write_archives(w.plan_records(pages), path, records_per_file=3)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()
    assert len(files) >= len(ROWS) // 3
    for f in files:
        data = gzip.decompress(f["content"])
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")
        assert 1 <= len(list(w.parse_archive(data))) <= 3
    whole = b"".join(gzip.decompress(f["content"]) for f in files).decode()
    ids = re.findall(r"WARC-Record-ID: (\S+)", whole)
    assert len(ids) == len(set(ids)) == len(ROWS)
    assert set(re.findall(r"WARC-Refers-To: (\S+)", whole)) < set(ids)
    assert whole.count("WARC-Profile") == whole.count("WARC-Refers-To-Target-URI: http://") == whole.count("WARC-Refers-To-Date: 2") == sum(r[3] == "revisit" for r in expected(ROWS))
    assert len(set(re.findall(r"WARC-Date: (\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ)\r", whole))) == 1


def test_sql(spark, tmp_path):
    """Against DuckDB, over repeated ids with the same and with other payloads."""
    rows = [r for r in ROWS if r[0] is not None]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(con.execute(w.ORACLE).fetchall(), key=repr) == sorted(map(tuple, w.op10_warc_revisits(spark, str(tmp_path)).collect()), key=repr)


def test_broken_archives_are_told():
    with pytest.raises(ValueError, match="no record at byte 0"):
        list(w.parse_archive(b"HTTP/1.1\r\n\r\n"))
    with pytest.raises(ValueError, match="does not end"):
        list(w.parse_archive(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: x\r\nWARC-Payload-Digest: sha1:x\r\nContent-Length: 6\r\n\r\na\r\n\r\nb"))


def test_no_pages(pages):
    assert w.archive_and_resolve(pages.limit(0)).collect() == []


def test_text_ids_come_back_as_they_were(spark):
    """Blanks, line ends, the empty id and null; a header of its own can't be made of an id."""
    rows = [("", "http://a/", "one"), (None, "http://b/", "two"), ("a b+c%20", "http://c/", "three"), ("x\r\nWARC-Type: revisit", "http://d/", "four"), ("é\n", "http://e/", "one"), ("z", "http://f/", "two")]
    found = w.archive_and_resolve(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in found), key=repr) == sorted(
        [("", "response", None), (None, "response", None), ("a b+c%20", "response", None), ("x\r\nWARC-Type: revisit", "response", None), ("é\n", "revisit", ""), ("z", "revisit", None)], key=repr
    )


def test_plain_archives(spark, pages):
    """What the operator writes by default: files that begin with a record, and of which each record can be read where it begins."""
    path = shared_path(spark, "warc-plain")
    w.archive_and_resolve(pages, path=path).collect()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    assert files and sum(len(list(w.parse_archive(f["content"]))) for f in files) == len(ROWS)
    data = next(f["content"] for f in files if f["content"].count(b"WARC-Type") > 1)
    second = data.index(b"\r\n\r\nWARC/1.1") + 4
    assert len(list(w.parse_archive(data[second:]))) == len(list(w.parse_archive(data))) - 1


def test_only_html_that_may_be_asked_for_is_shuffled(spark):
    """Pages of their own stay where they were read; of copies, one hands on its html."""
    rows = [(k, "http://a/", f"page {k} " + "x" * 500) for k in range(300)] + [(1000 + k, "http://b/", f"copy {k % 20} " + "y" * 500) for k in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    planned = w.plan_records(pages)
    handed = [r for r in planned.collect() if r["original"] is not None]
    assert len(handed) == 180 and all(r["html"] is None for r in handed)
    alone, met = planned._jdf.queryExecution().optimizedPlan().toString(), planned.where("page_id < 300").count()
    assert met == 300 and "Union" in alone
    assert sorted(map(tuple, w.archive_and_resolve(pages).collect()), key=repr) == expected(rows)
