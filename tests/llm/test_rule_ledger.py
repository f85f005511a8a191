from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from concord.llm import rule_ledger as r


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered), "n_lines": len(lines), "n_capitals": sum("A" <= c <= "Z" for c in text),
    }


TEXTS = [
    "", None, " ", "a", "a b c d", "a b c d e", "a b c d e a b c d e", "a a a a a a a", "x " * 50, "a b c d e f a b c d e g a b c d e", "l\nl\nl\nm", "\n\n \n", "#*$%&|<> A\x0bB\x0cC\rD", "𝒳 é \xa0 \x1c w",
    "one two three four five six\none two three four five six\nseven", "q w e r t y u i o p " * 3 + "end",
]


def test_measures(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for row in r.build_ledger(df).collect():
        assert {k: row[k] for k in r.MEASURES} == brute(TEXTS[row["doc_id"]]), TEXTS[row["doc_id"]]


def test_documents_match_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    found = r.op8_rule_ledger(spark, sf_dir)
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(f"SELECT {', '.join(found.columns)} FROM ({r.ORACLE})").fetchall())


def test_no_python_in_the_plan(spark, sf_dir):
    plan = r.op8_rule_ledger(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange" not in plan


def test_policies_and_ablations(spark):
    ledger = spark.createDataFrame([(1, 0), (2, 1), (3, 3), (4, 4), (5, 4), (6, 5), (7, 32)], "doc_id long, failure_bits long")
    kept = lambda v: [x["doc_id"] for x in ledger.where(r.passes(v)).orderBy("doc_id").collect()]
    assert kept("v1") == [1, 4, 5, 7] and kept("v2") == [1, 7] and kept("v3") == [1]
    table = {x["rule"]: tuple(x)[2:] for x in r.ablations(ledger, "v2").collect()}
    assert table == {"few_words": (3, 1, 5), "repeated_windows": (1, 0, 5), "symbols": (3, 2, 5), "repeated_lines": (0, 0, 5)}
    assert set(r.POLICIES["v1"]) <= set(r.POLICIES["v2"]) <= set(r.POLICIES["v3"])


def test_ablations_match_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    found = r.rule_ablations(spark, sf_dir)
    wanted = con.execute(f"SELECT {', '.join(found.columns)} FROM ({r.ABLATIONS_ORACLE})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(wanted) and len(wanted) == 12 and any(n for *_, n, _, _ in wanted)


@pytest.mark.parametrize("version", ["v1", "v3"])
def test_odd_documents(odd_documents, no_documents, version):
    kept = r.keep_by_policy(odd_documents, version)
    assert kept.schema.names == odd_documents.columns and kept.dtypes == odd_documents.dtypes
    assert sorted((x["doc_id"] for x in kept.collect()), key=repr) == sorted([1, 2, 2, None, 8], key=repr)
    assert r.build_ledger(odd_documents).count() == odd_documents.count()
    assert r.keep_by_policy(no_documents, version).collect() == [] and r.build_ledger(no_documents).collect() == []
    assert r.ablations(r.build_ledger(no_documents)).collect() == []


def test_null_text_fails(spark):
    df = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert r.build_ledger(df).select(F.col("failure_bits").bitwiseAND(F.lit(1))).first()[0] == 1


def test_stored_ledger_serves_policies_without_the_texts(spark, tmp_path, monkeypatch):
    """What was written is read for policies and ablations; under other rules it isn't there."""
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    made, path = r.build_ledger(df), str(tmp_path / "ledger")
    stored = r.stored_ledger(df, path)
    assert sorted(map(str, stored.collect())) == sorted(map(str, made.collect()))
    assert "split" not in stored.where(r.passes("v2"))._jdf.queryExecution().toString().lower()
    assert sorted(map(str, r.ablations(r.read_ledger(spark, path), *r.POLICIES).collect())) == sorted(map(str, r.ablations(made, *r.POLICIES).collect()))
    version = r.rule_set()
    monkeypatch.setattr(r, "RULES", [*r.RULES, ("shouting", "n_capitals > 9")])
    assert r.rule_set() != version
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        r.read_ledger(spark, path)
