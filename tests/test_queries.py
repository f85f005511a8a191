"""Every query of the reconciliation part against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from concord.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, str | bool):
        return value
    return float(value)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_its_sql(spark, sf_dir, oracle, name):
    found = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(found.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in found.collect()), key=repr)
    wanted = oracle.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLE_SQL[name]})").fetchall()
    assert got == sorted((tuple(map(plain, r)) for r in wanted), key=repr)
    assert wanted  # equality of nothing with nothing tells nothing


@pytest.mark.parametrize("name, levels", [("identity_cascade_levels", {1, 2, 3, 4, 5, 6, 7, 8}), ("identity_cascade_notices", {3, 4, 5, 6, 7})])
def test_every_level_of_the_cascade_occurs(spark, name, levels):
    """On sf0.01, with keys of one user, of several and of none."""
    larger = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("customer", "supplier", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{larger}/{t}.parquet'")
    got = sorted((r["probe_id"], r["user_id"], r["level"]) for r in registry.QUERIES[name](spark, larger).collect())
    assert got == sorted(con.execute(f"SELECT probe_id, user_id, level FROM ({registry.ORACLE_SQL[name]})").fetchall())
    assert {level for *_, level in got} == levels and len(got) < con.execute("SELECT count(*) FROM events").fetchone()[0]
    cascade = registry.ORACLE_SQL[name].rpartition("SELECT probe_id, user_id, level")[0]
    assert con.execute(cascade + "SELECT count(DISTINCT level) FROM counted WHERE n > 1").fetchone()[0] >= 3


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
