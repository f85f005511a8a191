"""Keyed state: unique values that change hands, repeated rows of one key, written tables, busy users."""

from __future__ import annotations

import random

import pytest

from concord.operators import apply, overlay, throttle
from concord.plans import pipelines
from concord.sources import tables
from concord.sources.schemas import USERS
from test_flows import CONFIG


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def replay(held, asked, order):
    """Users one by one; a value that several had at the start stays taken."""
    taken, state = list(held.values()), dict(held)
    crowded = {v for v in taken if taken.count(v) > 1}
    out = {}
    for user in sorted(asked, key=lambda u: (order[u], u)):
        new, old = asked[user], held[user]
        wants = bool(new) and new != old
        if wants and new not in crowded and new not in state.values():
            state[user] = new
        out[user] = (state[user], wants and state[user] == old)
    return sorted((u, v, c) for u, (v, c) in out.items())


class TestUniqueGuard:
    @pytest.mark.parametrize("seed", range(4))
    def test_is_what_one_by_one_gives(self, spark, seed):
        rng = random.Random(seed)
        n = 120
        held = {u: f"v{u if rng.random() < 0.95 else rng.randrange(n)}" for u in range(n)}
        asked = {u: rng.choice([f"v{u - 1}", f"v{u + 1}", f"v{rng.randrange(n)}", f"new{rng.randrange(20)}", "", None, f"v{u}"]) for u in range(n) if rng.random() < 0.9}
        order = {u: u if seed % 2 == 0 else rng.randrange(40) for u in range(n)}
        users = spark.createDataFrame(list(held.items()), "user_id long, username string")
        wanted = spark.createDataFrame([(u, v, order[u]) for u, v in asked.items()], "user_id long, new_username string, turn long")
        got = overlay.collision_guard(users, wanted, "username", "turn").select("user_id", "username", "username_collides")
        assert rows(got) == sorted(replay(held, asked, order), key=repr)

    @pytest.mark.parametrize("length", [1, 2, 50])
    def test_chains(self, spark, length):
        """Each asks for the value of the one before: all get it if the first does, and none if that one can't."""
        users = spark.createDataFrame([(u, f"v{u}") for u in range(length + 1)], "user_id long, email string")
        for first, moved in (("free", True), (f"v{length}", False)):
            asked = spark.createDataFrame([(u, f"v{u - 1}" if u else first) for u in range(length)], "user_id long, new_email string")
            assert {r["email_collides"] for r in overlay.collision_guard(users, asked, "email").collect()} == {not moved}

    def test_two_fields_are_settled_apart(self, spark):
        users = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "user_id long, username string, email string")
        asked = spark.createDataFrame([(1, "b", "z"), (2, "c", "x")], "user_id long, new_username string, new_email string")
        got = overlay.unique_guard(users, asked, ["username", "email"]).select("user_id", "username", "email", "username_collides", "email_collides")
        assert rows(got) == [(1, "a", "z", True, False), (2, "c", "x", False, False)]
        assert overlay.unique_guard(users, asked.limit(0), ["username", "email"]).count() == 0


class TestOneRowAKey:
    def test_changes_that_are_repeated(self, spark):
        target = spark.createDataFrame([(1, "a", {"k": "v"}), (2, "b", None)], "k long, v string, m map<string,string>")
        changes = spark.createDataFrame([(2, "B", None, 1), (2, "C", {"x": "y"}, 2), (2, "C", {"x": "y"}, 2), (3, "n", None, None), (3, "m", None, None)], "k long, v string, m map<string,string>, at long")
        once = apply.upsert(target, changes, ["k"], order="at")
        assert rows(once) == [(1, "a", {"k": "v"}), (2, "C", {"x": "y"}), (3, "n", None)]
        assert rows(apply.upsert(once, changes, ["k"], order="at")) == rows(once)
        assert rows(apply.upsert(target, changes.limit(0), ["k"], order="at")) == rows(target)

    def test_profiles_that_are_repeated(self, spark):
        """The one that was read counts; users and outcomes stay one row each."""
        users = spark.createDataFrame([(1, "old", "old@x", True, {}, {}), (2, "bob", "bob@x", True, {}, {})], USERS)
        roles, asked = spark.createDataFrame([], "user_id long, role string"), spark.createDataFrame([(1,), (1,), (2,), (7,)], "user_id long")
        profile = "struct<username:string,email:string,name:string,first_name:string,last_name:string,institutional_affiliation:string,orcid:string,groups:array<struct<id:string,role:string>>,is_superadmin:boolean>"
        of = lambda name: (name, f"{name}@x", name, None, None, None, None, [("1", "member")], False)
        profiles = spark.createDataFrame([(1, None, "timeout"), (1, of("ann"), "ok"), (1, of("zoe"), "ok"), (1, of("ann"), "ok"), (2, None, "timeout"), (2, None, "parse_error")], f"user_id long, profile {profile}, status string")
        out = pipelines.sync_users(users, roles, asked, profiles, CONFIG)
        assert rows(out.users.select("user_id", "username")) == [(1, "ann"), (2, "bob")]
        assert rows(out.outcomes) == [(1, "success"), (2, "invalid_response"), (7, "not_found_local")]
        assert [r[0] for r in rows(out.user_roles)] == [1]


class TestBusyUsers:
    @pytest.mark.parametrize("seed, gap", [(0, 50), (1, 400), (2, 5000), (3, 0)])
    def test_cells_give_what_one_pass_gives(self, spark, seed, gap):
        """Sparse, dense and bursty users, one without a name, with cells of some ten events each."""
        rng, data = random.Random(seed), []
        for user, n, span in (("busy", 400, 20_000), ("dense", 300, 900), (None, 200, 8000), ("calm", 9, 3000), ("bursts", 300, 0)):
            times = [rng.randrange(20) * 1500 + rng.randrange(60) for _ in range(n)] if not span else [rng.randrange(span) for _ in range(n)]
            data += [(user, t) for t in times]
        df = spark.createDataFrame(data, "u string, s long").selectExpr("u", "timestamp_seconds(s) AS ts").repartition(3)
        wanted = []
        for user in {u for u, _ in data}:
            wanted += [(user, t) for t in throttle.throttle_in_state(None, [t for u, t in data if u == user], gap)[1]]
        got = throttle.throttle(df, "u", "ts", gap, busy_rows=10).selectExpr("u", "unix_seconds(ts) AS s")
        assert rows(got) == sorted(wanted, key=repr)

    def test_a_busy_user_is_dealt_over_cells(self, spark):
        hot = spark.range(4000).selectExpr("0L AS b", "id * 1000000 AS us", "0L AS low", "100000000L AS width", "id div 100 AS cell")
        assert throttle._in_cells(hot, 7_000_000).count() == 500


class TestKeyedTable:
    def test_only_folders_of_changed_keys_are_rewritten(self, spark, tmp_path):
        t = tables.KeyedTable(spark, str(tmp_path / "t"), ["k"], parts=16)
        t.create(spark.createDataFrame([(i, "a", None) for i in range(200)] + [(5, "b", {"x": "y"})], "k long, v string, m map<string,string>"))
        before = dict(map(tuple, t.files().collect()))
        touched = t.upsert(spark.createDataFrame([(3, "new", None, 2), (3, "old", None, 1), (900, "added", None, 1)], "k long, v string, m map<string,string>, at long"), order="at")
        after = dict(map(tuple, t.files().collect()))
        assert touched in (1, 2) and sum(before.get(p) != f for p, f in after.items()) == touched
        found = {r["k"]: r["v"] for r in t.read().collect()}
        assert t.read().count() == len(found) == 201 and (found[3], found[5], found[900]) == ("new", "b", "added")
        assert t.upsert(t.read().limit(0)) == 0

    def test_keys_of_two_columns_and_null_keys(self, spark, tmp_path):
        t = tables.KeyedTable(spark, str(tmp_path / "t"), ["a", "b"], parts=4)
        t.create(spark.createDataFrame([("x", 1, "u"), ("x", 2, "v"), (None, 1, "n")], "a string, b long, v string"))
        t.upsert(spark.createDataFrame([("x", 2, "V"), ("y", 2, "w")], "a string, b long, v string"))
        assert rows(t.read()) == sorted([("x", 1, "u"), ("x", 2, "V"), (None, 1, "n"), ("y", 2, "w")], key=repr)

    def test_a_second_writer_is_refused(self, spark, tmp_path):
        t = tables.KeyedTable(spark, str(tmp_path / "t"), ["k"], parts=4)
        t.create(spark.createDataFrame([(1, "a")], "k long, v string"))
        tables.claim(spark, f"{t.path}/_writer")
        with pytest.raises(tables.WriteConflict):
            t.upsert(spark.createDataFrame([(1, "b")], "k long, v string"))
        assert rows(t.read()) == [(1, "a")]

    def test_versions_have_one_writer_each(self, spark, tmp_path):
        t = tables.VersionedTable(spark, str(tmp_path / "v"))
        one = spark.createDataFrame([(1,)], "k long")
        t.replace(one)
        tables.claim(spark, f"{t.path}/pointers/000000001.json", '{"n": 1, "version": "other"}\n')
        assert t.current() == "other"
        tables.claim(spark, f"{t.path}/pointers/{2:09d}.json")  # somebody who is about to write
        with pytest.raises(tables.WriteConflict):
            t.replace(one)
