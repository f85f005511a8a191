"""Secret scanning with multipart credential linking (operator 9).

Three kinds of secret stand for themselves wherever they occur: assignments, access identifiers and long hex runs. Two
kinds of part are weak: a bare key (a mixed run of letters and digits, 20 or more characters) and an endpoint (an address with its
scheme) are everyday things when alone. Weak parts are reported only where complementary parts meet: a bare key with an access
identifier within `scope` code points, and an endpoint with both an access identifier and a secret (a bare key,
an assignment's value or a hex run) within `scope` of it. Distances are between starts.

Candidates are found text by text with regular expressions over the whole text. Linking is an interval join on Spark: each candidate
falls into the cell of its start, cells are `scope` wide, and a candidate is compared with those of its own and the two neighbour
cells of its text, by equality on text and cell, with the distance as a further condition. Only a part's existence is
asked, so the joins are semi joins and hand on at most one row for each candidate.

Cases: a null text is empty and has no spans. A very long text is scanned whole, and its parts fall into many cells. Ties are all kept. Repeated rows are scanned and returned one by one. An empty table gives an
empty result. Input columns other than the id and the text are ignored; `redact` keeps them. Offsets are code points,
ends are exclusive. Spans of equal start are in the order of KINDS. A bare key inside a base span is not reported again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.session import cut_lineage

#: The kinds that stand for themselves, and how a match of the first begins.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS_PREFIX = "AKIA"
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Weak kinds.
KEY = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = re.compile(r"""[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+""")
KINDS = ["assign", "access", "hex", "key", "endpoint"]
SCOPE = 400
MASK = "[REDACTED]"
SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
SPANS = "array<struct<start:long,kind:int,end:long>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the spans that stand for themselves, in order."""
    found = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if ACCESS_PREFIX in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return sorted(found)


def _mixed(run: str) -> bool:
    return any(c.isdigit() for c in run) and any(c.islower() for c in run) and any(c.isupper() for c in run)


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of bare keys and endpoints. Matches and base spans are both in order, so one pass tells which keys meet a base span."""
    found, at, reach = [], 0, 0  # reach: where the base spans that start before a match ends come to an end
    for m in KEY.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        if reach <= m.start() and _mixed(m[0]):
            found.append((m.start(), 3, m.end()))
    if "://" in text:
        found += [(m.start(), 4, m.end()) for m in ENDPOINT.finditer(text)]
    return found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (a number for each row), doc_id, base and weak spans; kept in the shared folder, since every join starts from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, weak = [], []
            for t in b.column(1):
                text = t.as_py() or ""
                base.append(base_spans(text))
                weak.append(weak_spans(text, base[-1]))
            columns = [pa.array([[dict(zip(("start", "kind", "end"), s, strict=True)) for s in spans] for spans in own], type=pa.list_(SPAN)) for own in (base, weak)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", "base", "weak"])

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, base {SPANS}, weak {SPANS}")
    return cut_lineage(found).withColumn("row", F.monotonically_increasing_id())


def _near(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """The rows of left that have a row of right in the same text, at most `scope` away."""
    spread = right.select(
        F.col("row").alias("__row"), F.col("start").alias("__start"), F.explode(F.array(*[F.floor(F.col("start") / scope) + k for k in (-1, 0, 1)])).alias("__cell")
    )
    here = left.withColumn("cell", F.floor(F.col("start") / scope))
    meets = (F.col("row") == F.col("__row")) & (F.col("cell") == F.col("__cell")) & (F.abs(F.col("start") - F.col("__start")) <= scope)
    return here.join(spread, meets, "left_semi").drop("cell")


def link(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """row, start, kind and end of the weak parts that complementary parts make secrets."""
    parts = scanned.select("row", F.explode(F.concat("base", "weak")).alias("s")).select("row", "s.start", "s.kind", "s.end")
    access, keys, endpoints = (parts.where(F.col("kind") == KINDS.index(k)) for k in ("access", "key", "endpoint"))
    secrets = parts.where(F.col("kind").isin([KINDS.index(k) for k in ("assign", "hex", "key")]))
    return _near(keys, access, scope).unionByName(_near(_near(endpoints, access, scope), secrets, scope))


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_links(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """scanned with `spans`: the base ones and those that linking adds."""
    linked = link(scanned, scope).groupBy("row").agg(F.collect_set(F.struct("start", "kind", "end")).alias("linked"))
    return scanned.join(linked, "row", "left").withColumn("spans", F.when(F.col("linked").isNull(), F.col("base")).otherwise(F.concat("base", "linked")))


def find_secrets(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts, digest of the base spans and all spans of every row."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    found = with_links(scan(docs, id_col, text_col), scope)
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"), _text_of(F.col("spans")).alias("spans"))


def mask_text(text: str, spans: list) -> str:
    """text with each span, or run of overlapping spans, replaced by MASK."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: s["start"]):
        if s["start"] >= at:
            out += [text[at : s["start"]], MASK]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, scope: int = SCOPE, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """docs with every secret span masked; chars_col, where there is one, follows the text. Rows without secrets are as they were.

    Linking adds spans only where an access identifier is, so texts without its prefix are masked in one pass over the rows. The others are few: equal
    texts have equal spans, which are found once for each text, known by two 64-bit hashes, and sent back to the rows."""
    at = docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names of our own: none of docs can clash
    text = F.col(f"c{at}")
    may_link = F.coalesce(text.contains(ACCESS_PREFIX), F.lit(False))
    key = F.struct(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")).alias("key")
    linkable = plain.where(may_link).select("*", key)
    marked = with_links(scan(linkable.select("key", text.alias("text")), "key", "text"), scope).where(F.size("spans") > 0)
    spans = marked.groupBy("doc_id").agg(F.first("spans").alias("spans")).select(F.col("doc_id").alias("key"), "spans")
    joined = linkable.join(cut_lineage(spans), "key", "left").select(*plain.columns, "spans")

    def masked(b: pa.RecordBatch, spans_of) -> pa.RecordBatch:
        texts = b.column(at).to_pylist()
        out = [mask_text(t, s) if s else t for t, s in ((t, spans_of(k, t) if t is not None else None) for k, t in enumerate(texts))]
        return b.set_column(at, b.schema.field(at), pa.array(out, type=b.schema.field(at).type))

    def mask_base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield masked(b, lambda _, t: [dict(zip(("start", "kind", "end"), s, strict=True)) for s in base_spans(t)])

    def mask_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = b.column(b.num_columns - 1).to_pylist()
            yield masked(b.select(range(b.num_columns - 1)), lambda k, _, found=found: found[k])

    out = plain.where(~may_link).mapInArrow(mask_base, plain.schema).unionByName(joined.mapInArrow(mask_joined, plain.schema))
    if chars_col in docs.columns:
        n = f"c{docs.columns.index(chars_col)}"
        out = out.withColumn(n, F.when(text.isNull(), F.col(n)).otherwise(F.length(text)).cast(plain.schema[n].dataType))
    return out.toDF(*docs.columns)


def op9_credential_linking(spark, sf_dir: str) -> DataFrame:
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
