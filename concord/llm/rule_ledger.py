"""Quality rules as a bitmask ledger (operator 8), in DataFrame functions only.

Every rule is evaluated once for each document. The ledger keeps what was measured and one long whose bit r is
set where rule r fails. A policy is a named, versioned set of rules: applying one is a bitwise AND with its mask, so policies
can be compared, replayed and ablated without reading a text again. Ablations come from the histogram of failure bits,
at most 2 ** rules rows, built by a partial aggregation. `stored_ledger` writes the ledger once, in a folder of the rule set's own version, and what follows reads that.

Repeated windows: words are hashed (64 bits), five hashes in a row are hashed again, and two windows of one document
count as equal when those hashes agree. Only where a document has equal windows are its windows sorted to
find their positions. All of it happens within a row, in arrays: no window is shuffled.

Cases: a null or empty text has no words and fails `few_words`. A very long text is measured whole, in the arrays of its row. A measurement
that ties with a rule's bound does not fail it. Repeated rows give repeated rows. An empty table gives an
empty ledger. Columns of the input other than the id and the text are not carried by the ledger; `keep_by_policy` keeps
them all, whatever their names. A null id is kept as it is.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.session import shared_path

BLANKS = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5

#: Bit, name and test of each rule, over the measurements.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 25 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    ("capitals", "100 * n_capitals > 50 * word_chars"),
]
BIT = {name: 1 << r for r, (name, _) in enumerate(RULES)}
#: Versions of the policy; a later one never changes an earlier one.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": ("few_words", "repeated_windows"),
    "v2": ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    "v3": ("few_words", "repeated_windows", "symbols", "repeated_lines", "word_length", "capitals"),
}
CURRENT = "v3"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def policy_mask(version: str) -> int:
    return sum(BIT[name] for name in POLICIES[version])


def _tail(values: Column, start: int, length: Column) -> Column:
    return F.slice(values, F.lit(start), F.greatest(length, F.lit(0)))


def measure(df: DataFrame, text: Column) -> DataFrame:
    """df with the MEASURES of the text. Each step that is read more than once is a column, so Spark evaluates it once."""
    p = "__m_"
    c = lambda name: F.col(p + name)
    out = df.withColumn(p + "text", F.coalesce(text, F.lit("")))
    words = F.array_remove(F.split(F.regexp_replace(c("text"), r"[\x09-\x0D]", " "), " "), "")
    lines = F.filter(F.split(c("text"), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumns({p + "hash": F.transform(words, lambda w: F.xxhash64(w)), p + "lines": lines})
    out = out.withColumn("n_words", F.size(c("hash")).cast("long")).withColumn(p + "n", F.size(c("hash")))
    n = c("n")
    out = out.withColumn(p + "two", F.zip_with(_tail(c("hash"), 1, n - 1), _tail(c("hash"), 2, n - 1), lambda a, b: F.xxhash64(a, b)))
    out = out.withColumn(p + "four", F.zip_with(_tail(c("two"), 1, n - 3), _tail(c("two"), 3, n - 3), lambda a, b: F.xxhash64(a, b)))
    out = out.withColumn(p + "five", F.zip_with(_tail(c("four"), 1, n - 4), _tail(c("hash"), 5, n - 4), lambda a, b: F.xxhash64(a, b)))
    out = out.withColumn(p + "equal", F.size(F.array_distinct(c("five"))) < F.size(c("five")))
    placed = F.transform(c("five"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    out = out.withColumn(p + "sorted", F.when(c("equal"), F.sort_array(placed)))
    m = F.size(c("sorted"))
    both = F.zip_with(_tail(c("sorted"), 1, m - 1), _tail(c("sorted"), 2, m - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull()))))
    out = out.withColumn(p + "starts", F.when(c("equal"), starts))
    k = F.size(c("starts"))
    gaps = F.zip_with(_tail(c("starts"), 1, k - 1), _tail(c("starts"), 2, k - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)  # the last window counts in full
    out = out.withColumns(
        {
            "n_repeat_words": F.coalesce(F.when(c("equal"), covered), F.lit(0)).cast("long"),
            "word_chars": (F.length(c("text")) - F.regexp_count(c("text"), F.lit(BLANKS))).cast("long"),
            "n_symbols": F.regexp_count(c("text"), F.lit(SYMBOLS)).cast("long"),
            "n_capitals": F.regexp_count(c("text"), F.lit("[A-Z]")).cast("long"),
            "n_lines": F.size(c("lines")).cast("long"),
            "n_dup_lines": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
        }
    )
    return out


def failure_bits() -> Column:
    bits = F.lit(0).cast("long")
    for r, (_, test) in enumerate(RULES):
        bits = bits + F.when(F.expr(test), F.lit(1 << r)).otherwise(F.lit(0)).cast("long")
    return bits


def build_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measurements and failure_bits of every row."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return measure(picked, F.col("text")).withColumn("failure_bits", failure_bits()).select("doc_id", *MEASURES, "failure_bits")


def rule_set() -> str:
    """The version of the rules as such: it changes with their names, order, tests and measurements."""
    return sha256(repr((RULES, MEASURES, WINDOW, BLANKS, SYMBOLS)).encode()).hexdigest()[:12]


def stored_ledger(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger of docs, written below path (the shared folder by default) and read again; read_ledger finds it later."""
    path = path or shared_path(docs.sparkSession, "rule-ledger")
    build_ledger(docs, id_col, text_col).write.parquet(f"{path}/rule_set={rule_set()}")
    return read_ledger(docs.sparkSession, path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A stored ledger; one that was made by other rules than these is not there."""
    return spark.read.parquet(f"{path}/rule_set={rule_set()}")


def passes(version: str, bits: Column | None = None) -> Column:
    return (F.col("failure_bits") if bits is None else bits).bitwiseAND(F.lit(policy_mask(version)).cast("long")) == 0


def ablations(ledger: DataFrame, *versions: str) -> DataFrame:
    """For each rule of the named policies (the current one by default): documents that fail it, that fail only it (kept once it is dropped), and
    those the policy drops. The ledger is read once, whatever the number of policies."""
    seen = ledger.groupBy("failure_bits").agg(F.count("*").alias("n"))
    long = lambda n: F.lit(n).cast("long")
    rules = [F.struct(F.lit(v).alias("policy"), F.lit(name).alias("rule"), long(BIT[name]).alias("bit"), long(policy_mask(v)).alias("mask")) for v in versions or (CURRENT,) for name in POLICIES[v]]
    by_rule = seen.select("failure_bits", "n", F.explode(F.array(*rules)).alias("r")).withColumn("bits", F.col("failure_bits").bitwiseAND(F.col("r.mask")))
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("long")
    return by_rule.groupBy(F.col("r.policy").alias("policy"), F.col("r.rule").alias("rule")).agg(
        count(F.col("bits").bitwiseAND(F.col("r.bit")) != 0).alias("n_failed"),
        count(F.col("bits") == F.col("r.bit")).alias("n_failed_alone"),
        count(F.col("bits") != 0).alias("n_dropped"),
    )


def keep_by_policy(docs: DataFrame, version: str = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, that pass the policy."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = measure(docs.select(row), F.col(f"row.`{text_col}`")).select("row", _settled(failure_bits()).alias("bits"))
    return judged.where(passes(version, F.col("bits"))).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _settled(value: Column) -> Column:
    """value as a column that filters are not moved below: there they would repeat all its steps for each use of each column."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def op8_rule_ledger(spark, sf_dir: str) -> DataFrame:
    ledger = stored_ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.col("failure_bits").bitwiseAND(F.lit(policy_mask("v1")).cast("long")) != 0
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & passes(CURRENT)).alias("kept"), "failure_bits"
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id
), f AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 25 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_capitals > 50 * word_chars THEN 32 ELSE 0 END)::BIGINT AS failure_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failure_bits & 3 <> 0 AS base_failed, failure_bits = 0 AS kept, failure_bits FROM f
"""


def rule_ablations(spark, sf_dir: str) -> DataFrame:
    """What each rule of each version of the policy is worth, over all documents."""
    return ablations(stored_ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")), *POLICIES)


ABLATIONS_ORACLE = f"""
WITH l AS ({ORACLE}), p(policy, rule, bit, mask) AS (VALUES {", ".join(f"('{v}', '{name}', {BIT[name]}, {policy_mask(v)})" for v, names in POLICIES.items() for name in names)})
SELECT policy, rule, count(*) FILTER (failure_bits & bit <> 0) AS n_failed, count(*) FILTER (failure_bits & mask = bit) AS n_failed_alone, count(*) FILTER (failure_bits & mask <> 0) AS n_dropped
FROM l, p GROUP BY policy, rule
"""
