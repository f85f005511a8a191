from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from concord.config import Config
from concord.operators import apply, delta, groups, notices, overlay, report, resolve, throttle


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def roles(spark, pairs):
    return spark.createDataFrame(pairs, "user_id long, role string")


class TestMembershipDelta:
    def test_published_case(self, spark):
        local = roles(spark, [(1, "admin"), (1, "p---1000570|admin"), (1, "p---1000577|member")])
        remote = roles(spark, [(1, "p---1000576|admin"), (1, "p---1000577|member")])
        assert rows(delta.membership_delta(local, remote, "p")) == sorted(
            [(1, "p---1000570|admin", "dropped"), (1, "p---1000576|admin", "added"), (1, "admin", "unchanged"), (1, "p---1000577|member", "unchanged")], key=repr
        )

    def test_equal_sets_change_nothing_even_for_superadmins(self, spark):
        both = roles(spark, [(1, "administration"), (1, "p---1|member")])
        assert {r[2] for r in rows(delta.membership_delta(both, both, "p"))} == {"unchanged"}

    def test_superadmin_roles_are_added_again_when_anything_differs(self, spark):
        local = roles(spark, [(1, "administration")])
        remote = roles(spark, [(1, "administration"), (1, "p---1|member")])
        found = delta.membership_delta(local, remote, "p")
        assert rows(found) == [(1, "administration", "added"), (1, "administration", "unchanged"), (1, "p---1|member", "added")]
        assert rows(delta.apply_membership(local, found)) == [(1, "administration"), (1, "p---1|member")]

    def test_apply_restores_the_remote_set_and_is_idempotent(self, spark):
        rng = random.Random(3)
        draw = lambda: list({(u, f"p---{rng.randrange(6)}|member") for u in range(20) for _ in range(rng.randrange(4))})
        local, remote = roles(spark, draw() + [(u, "own") for u in range(20)]), roles(spark, draw())
        once = delta.apply_membership(local, delta.membership_delta(local, remote, "p"))
        assert rows(once.where("role <> 'own'")) == rows(remote)
        assert rows(delta.apply_membership(once, delta.membership_delta(once, remote, "p"))) == rows(once)

    def test_empty(self, spark):
        assert rows(delta.membership_delta(roles(spark, []), roles(spark, []), "p")) == []


class TestSparseDiff:
    def test_rules(self, spark):
        schema = "id long, name string, n int, tags array<string>, place struct<city:string,zip:string>"
        old = spark.createDataFrame([(1, "a", 1, ["x"], ("c", "z")), (3, "k", 1, ["x"], ("c", "z"))], schema)
        new = spark.createDataFrame([(1, "b", 0, [], ("c", "y")), (2, "n", 5, None, None)], schema)
        assert rows(delta.sparse_diff(old, new, "id")) == [(1, "name", "b"), (1, "place.zip", "y"), (1, "tags", '["x"]'), (2, "n", "5"), (2, "name", "n")]
        kept = rows(delta.sparse_diff(old, new, "id", keep_falsy=True))
        assert (1, "n", "0") in kept and (1, "tags", '["x"]') in kept and (2, "tags", "[]") in kept

    def test_lists_are_given_as_what_differs(self, spark):
        old = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b"]), (3, None)], "id long, tags array<string>")
        new = spark.createDataFrame([(1, ["b", "c"]), (2, ["b", "a", "a"]), (3, ["a", "a"]), (4, ["d"])], "id long, tags array<string>")
        assert rows(delta.sparse_diff(old, new, "id")) == [(1, "tags", '["c","a"]'), (3, "tags", '["a","a"]'), (4, "tags", '["d"]')]

    def test_nested_rendering(self, spark):
        diff = spark.createDataFrame([(1, "b", "2"), (1, "a", "1")], "id long, path string, new_value string")
        assert rows(delta.nest_diff(diff)) == [(1, '{"a":"1","b":"2"}')]


def test_recursive_merge(spark):
    schema = "id long, s struct<a:string,b:string>, l array<int>, v string"
    base = spark.createDataFrame([(1, ("a", "b"), [1], "old"), (2, ("q", "r"), [9], "two")], schema)
    extra = spark.createDataFrame([(1, ("x", "y"), [2], "new"), (3, None, [5], "three")], schema)
    assert rows(delta.recursive_merge(base, extra, "id")) == [(1, ("x", "y"), [1, 2], "new"), (2, ("q", "r"), [9], "two"), (3, None, [5], "three")]


class TestResolve:
    USERS = "user_id long, username string, email string, user_profile string"
    PROBES = "probe_id long, external_method string, external_id string, orcid string, member_name string, email string"

    @pytest.fixture
    def keys(self, spark):
        profile = lambda o=None, m=None: "{" + ",".join(f'"{k}":"{v}"' for k, v in (("identifier_orcid", o), ("identifier_kc_username", m)) if v) + "}"
        users = spark.createDataFrame(
            [
                (1, "ann", "ann@x", profile("o1", "ann")),
                (2, "bob", "bob@x", profile("o2", "dup")),
                (3, "P-carl", "carl@x", profile("o2", "dup")),
                (4, "dup", "dup@x", profile()),
                (5, "eve", "eve@x", "not json"),
                (6, "p-dora", "", None),
            ],
            self.USERS,
        )
        identities = spark.createDataFrame([("m", "x1", 5), ("P", "legacy", 4)], "method string, id string, user_id long")
        return resolve.user_keys(users, identities)

    def found(self, spark, keys, policy, *probe):
        return [(r[1], r[2]) for r in rows(resolve.resolve_identity(spark.createDataFrame([(7, *probe)], self.PROBES), keys, "P", policy))]

    @pytest.mark.parametrize(
        ("probe", "out"),
        [
            (("m", "x1", "o1", "ann", "bob@x"), [(5, 1)]),
            (("m", "nobody", "o1", "bob", ""), [(1, 2)]),
            ((None, None, "o2", None, "carl@x"), [(3, 8)]),  # an ORCID of two users is none
            ((None, None, None, "dup", "eve@x"), [(5, 8)]),  # an ambiguous member name hides the plain user name
            ((None, None, None, "bob", None), [(2, 5)]),
            (("m", "n", None, "carl", None), [(3, 6)]),
            (("m", "n", None, "dora", None), [(6, 7)]),
            (("m", "n", None, "legacy", None), [(4, 4)]),
            ((None, None, None, "legacy", None), []),  # legacy and prefixed names need a method
            (("", "", "", "", ""), []),
        ],
    )
    def test_cascade(self, spark, keys, probe, out):
        assert self.found(spark, keys, "fallthrough", *probe) == out

    def test_notices_do_not_fall_back_to_mail(self, spark, keys):
        assert self.found(spark, keys, "none", None, None, None, "dup", "eve@x") == []
        assert self.found(spark, keys, "none", None, None, None, "ann", "eve@x") == [(1, 3)]

    def test_logout_takes_all(self, spark, keys):
        assert self.found(spark, keys, "all", None, None, None, "dup", None) == [(2, 3), (3, 3)]

    def test_logout_makes_only_the_rows_of_the_first_level(self, spark):
        """Owners of several arrays, probes of several cells, a probe that is repeated with other keys, and nothing shuffled after the join."""
        on = "kind string, key string, user_id long"
        keys = spark.createDataFrame([("member", f"m{u % 3}", u) for u in range(60)] + [("username", "m0", 1000), ("username", "plain", 7)], on).unionByName(spark.createDataFrame([("member", "m1", 0)], on))
        asked = spark.createDataFrame([(p, 3, "member", f"m{p % 5}") for p in range(40)] + [(p, 5, "username", "m0") for p in range(40)] + [(1, 3, "member", "m0"), (90, 5, "username", "plain")], "probe_id long, level int, kind string, key string")
        found = resolve._all_owners(asked, keys, block_rows=4, cell_probes=3)
        owners = {f"m{k}": {u for u in range(60) if u % 3 == k} | ({0} if k == 1 else set()) for k in range(3)}
        wanted = {(p, u, 3) for p in range(40) for u in owners.get(f"m{p % 5}", ())} | {(1, u, 3) for u in owners["m0"]} | {(p, 1000, 5) for p in range(40) if p % 5 > 2} | {(90, 7, 5)}
        got = rows(found.select("probe_id", "user_id", "level"))
        assert len(got) == len(wanted) and set(got) == wanted
        # The rows of probes with one key at their level go out as the join makes them.
        first = found._jdf.queryExecution().optimizedPlan().children().head().toString()
        assert "Generate explode(users" in first and "Aggregate" not in first.partition("Join")[0]

    def test_logout_of_shared_keys_is_dealt_by_rows_and_written_small(self, spark, tmp_path):
        """Tasks are counted by the rows that they make, not by the bytes that they read, and the rows come in an order that Parquet writes in a fraction of a byte each."""
        keys = spark.range(4000).select(F.lit("member").alias("kind"), F.concat(F.lit("m"), (F.col("id") % 4).cast("string")).alias("key"), F.col("id").alias("user_id"))
        asked = spark.range(800).select(F.when(F.col("id") > 0, F.col("id")).alias("probe_id"), F.lit(3).alias("level"), F.lit("member").alias("kind"), F.concat(F.lit("m"), (F.col("id") % 4).cast("string")).alias("key"))
        resolve._all_owners(asked, keys, block_rows=500, cell_probes=100).write.parquet(str(tmp_path / "out"))
        found = spark.read.parquet(str(tmp_path / "out"))
        named = found.where("probe_id IS NOT NULL")
        assert found.count() == found.distinct().count() == 800 * 1000
        assert named.count() == 799 * 1000 and named.where("probe_id % 4 <> user_id % 4 OR level <> 3").count() == 0
        assert sorted(r[0] for r in found.where("probe_id IS NULL").select("user_id").collect()) == list(range(0, 4000, 4))
        files = [p for p in (tmp_path / "out").glob("*.parquet") if p.stat().st_size > 2000]
        assert len(files) > 2 and sum(p.stat().st_size for p in files) < 0.35 * 800 * 1000

    def test_unknown_policy(self, spark, keys):
        with pytest.raises(ValueError, match="unknown policy"):
            self.found(spark, keys, "other", None, None, None, None, None)

    def test_source_priority_and_first_match(self, spark):
        ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
        source = lambda *pairs: spark.createDataFrame(list(pairs), "id long, value string")
        out = resolve.by_source_priority(ids, [("a", source((1, "a1"))), ("b", source((1, "b1"), (2, "b2")))], "id")
        assert rows(out) == [(1, "a", "a1"), (2, "b", "b2"), (3, None, None)]
        assert rows(resolve.first_match(ids, source((1, "z"), (1, "y")), ["id"], ["value"])) == [(1, "y"), (2, None), (3, None)]


class TestOverlay:
    def test_guard(self, spark):
        users = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "user_id long, username string")
        asked = spark.createDataFrame([(1, "b"), (2, "new"), (3, "new"), (4, "")], "user_id long, new_username string")
        out = overlay.collision_guard(users, asked, "username").select("user_id", "username", "username_collides")
        assert rows(out) == [(1, "a", True), (2, "new", False), (3, "c", True), (4, "d", False)]

    def test_own_value_is_no_collision(self, spark):
        users = spark.createDataFrame([(1, "a")], "user_id long, username string")
        asked = spark.createDataFrame([(1, "a")], "user_id long, new_username string")
        assert rows(overlay.collision_guard(users, asked, "username").select("username", "username_collides")) == [("a", False)]

    def test_document_changes_only_what_is_present(self, spark):
        fields = "id string, group_id string, title string, description string, website string, visibility string, group_name string, group_description string, group_visibility string"
        docs = spark.createDataFrame([("d1", "1", "t", "d", "w", "v", "gn", "gd", "gv"), ("d2", "2", "t", "d", "w", "v", "gn", "gd", "gv")], fields)
        meta = spark.createDataFrame([("1", '{"id": 1, "url": "u", "visibility": "public"}'), ("2", '{"name": "n", "description": null}')], "group_id string, raw string")
        assert rows(overlay.document_overlay(docs, meta)) == [("d1", "1", "t", "d", "u", "public", "gn", "gd", "public"), ("d2", "2", "t", "d", "w", "v", "n", None, "gv")]


class TestApply:
    def test_upsert_is_idempotent(self, spark):
        target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
        changes = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
        once = apply.upsert(target, changes, ["k"])
        assert rows(once) == [(1, "a"), (2, "B"), (3, "C")] == rows(apply.upsert(once, changes, ["k"]))

    def test_links(self, spark):
        kind = "method string, id string, user_id long"
        identities = spark.createDataFrame([("m", "x", 1)], kind)
        asked = spark.createDataFrame([("m", "x", 1), ("m", "x", 2), ("m", "y", 4), ("m", "y", 3)], kind)
        assert rows(apply.guarded_links(asked, identities)) == [("m", "x", 1, "exists"), ("m", "x", 2, "error"), ("m", "y", 3, "linked"), ("m", "y", 4, "error")]
        once = apply.link_identities(identities, asked)
        assert rows(once) == [("m", "x", 1), ("m", "y", 3)] == rows(apply.link_identities(once, asked))

    def test_create_users(self, spark):
        users = spark.createDataFrame([(5, "a", "a@x", True)], "user_id long, username string, email string, active boolean")
        asked = spark.createDataFrame([("b", "b@x"), ("c", "a@x"), ("", "d@x"), ("e", None), ("f", "f@x")], "username string, email string")
        made, failed = apply.create_users(users, asked)
        assert rows(made) == [(6, "b", "b@x", True), (7, "f", "f@x", True)]
        assert rows(failed) == [("", "d@x"), ("e", None)]

    def test_roles(self, spark):
        table = spark.createDataFrame([("r1", "r1", None)], "id string, name string, description string")
        wanted = spark.createDataFrame([("r1",), ("r2",)], "id string")
        assert [r[0] for r in rows(apply.find_or_create_roles(table, wanted))] == ["r1", "r2"]
        left, missing = apply.delete_roles(table, wanted)
        assert rows(left) == [] and rows(missing) == [("r2",)]
        held = roles(spark, [(1, "r1")])
        assert rows(apply.add_user_roles(held, held)) == [(1, "r1")]
        assert rows(apply.remove_user_roles(held, roles(spark, [(1, "r1"), (2, "r1")]))) == []


class TestNotices:
    @pytest.mark.parametrize(
        ("raw", "out"),
        [
            ('{"updates": {"users": [{"id": "1", "event": "updated"}]}}', [("users", "1", "updated", None)]),
            ('{"associations": {"associations": [{"id": "s", "event": "associated", "kc_id": "k"}]}}', [("associations", "s", "associated", "k")]),
            ('{"associations": [{"id": "s", "event": "associated"}]}', [("associations", "s", "associated", None)]),
            ('{"idp": "x"}', []),
            ("broken", []),
            (None, []),
        ],
    )
    def test_expand(self, spark, raw, out):
        found = notices.expand(spark.createDataFrame([(1, raw)], "request_id long, raw string"))
        assert [r[1:] for r in rows(found.select("request_id", "entity_type", "id", "event", "kc_id"))] == out

    @pytest.mark.parametrize(
        ("kind", "event", "out"),
        [("users", "updated", "update_user"), ("users", "created", "unexpected"), ("users", "deleted", "unexpected"), ("groups", "created", "update_group"), ("groups", "deleted", "not_implemented"), ("associations", "associated", "associate_user")],
    )
    def test_route(self, spark, kind, event, out):
        df = spark.createDataFrame([(kind, event)], "k string, e string")
        assert df.select(notices.route(F.col("k"), F.col("e"))).first()[0] == out

    def test_status(self, spark):
        items = [
            (1, False, True, True), (1, False, True, True),
            (2, False, True, True), (2, False, False, True),
            (3, False, True, False),
            (4, False, False, False),
            (5, True, True, True), (5, False, True, True),
            (6, False, True, False), (6, False, True, True),
        ]
        df = spark.createDataFrame(items, "request_id long, malformed boolean, allowed boolean, known boolean")
        assert [r[:3] for r in rows(notices.batch_status(df))] == [(1, 202, 2), (2, 400, 1), (3, 404, 0), (4, 400, 0), (5, 400, 0), (6, 202, 1)]

    def test_aliases(self, spark):
        table = notices.alias_table(spark, Config(provider="p", aliases=("cilogon", "other")))
        assert rows(table) == [("cilogon", "p", "cilogon"), ("other", "p", "other"), ("p", "p", "cilogon")]


def test_groups(spark):
    docs = spark.createDataFrame([("d1", "i", "1", False), ("d2", "i", "1", True), ("d3", "i", "2", False), ("d4", "i", "2", False), ("d5", "j", "1", False), ("d6", "i", "3", True)], "id string, instance string, group_id string, is_deleted boolean")
    wanted = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "group_id string")
    assert [r[0] for r in rows(groups.find_documents(docs, "i", wanted).select("id"))] == ["d1", "d3", "d4"]
    assert rows(groups.split_active(groups.find_documents(docs, "i", wanted, True))) == [("1", 1, 1, "update"), ("2", 2, 0, "error"), ("3", 0, 1, "deleted")]
    table = spark.createDataFrame([("p---1|admin",), ("p---1|member",), ("p---11|member",), ("q---1|member",)], "id string")
    assert rows(groups.deletion_summary(docs, table, wanted, "i", "p")) == [("1", "d1", "p---1|admin,p---1|member"), ("2", "d3,d4", ""), ("3", "", ""), ("4", "", "")]


def test_outcomes(spark):
    df = spark.createDataFrame([(1, True, "ok", 2), (2, True, "ok", 0), (3, False, "ok", 1), (4, True, "timeout", 0), (5, True, "parse_error", 0), (6, True, "not_found", 0), (7, True, "request_error", 0)], "id long, known boolean, status string, n long")
    marked = df.withColumn("bucket", report.bucket(F.col("known"), F.col("status"), F.col("n")))
    assert [r["bucket"] for r in marked.orderBy("id").collect()] == ["success", "unchanged", "not_found_local", "timeout", "invalid_response", "not_found_remote", "failure"]
    assert rows(report.outcome_lists(marked, "id"))[0] == ("failure", "7")
    assert rows(report.outcome_counts(marked))[0] == ("failure", 1)


def test_throttle_follows_the_last_emitted_event(spark):
    start = dt.datetime(2024, 1, 1)
    at = lambda s: start + dt.timedelta(seconds=s)
    times = [0, 30, 60, 61, 100, 121, 122, 400]
    df = spark.createDataFrame([(1, at(s)) for s in times] + [(1, at(30)), (2, at(5)), (2, None)], "u long, ts timestamp_ntz")
    out = {(u, int((ts.replace(tzinfo=None) - start).total_seconds())) for u, ts in throttle.throttle(df, "u", "ts", 60).select("u", F.col("ts").cast("timestamp_ntz")).collect()}
    assert out == {(1, 0), (1, 61), (1, 122), (1, 400), (2, 5)}
    assert throttle.throttle_in_state(None, [400, 0, 61, 60], 60) == (400, [0, 61, 400])
    assert throttle.throttle_in_state(100, [50, 160, 161], 60) == (161, [161])


@pytest.mark.parametrize("policy", ["fallthrough", "none"])
def test_shared_keys_are_counted_before_probes_meet_them(spark, policy):
    """Half of the users share one member name, which half of the probes ask for; repeated probes may name several keys."""
    keys = spark.createDataFrame([("member", "crowd" if u % 2 else f"m{u}", u) for u in range(100)] * 2, "kind string, key string, user_id long")
    names = [(p, "crowd" if p % 2 else f"m{p}") for p in range(100)] + [(0, "m2"), (4, "m4"), (6, "crowd")]
    probes = spark.createDataFrame([(p, None, None, None, n, None) for p, n in names], "probe_id long, external_method string, external_id string, orcid string, member_name string, email string")
    found = resolve.resolve_identity(probes, keys, "p", policy)
    assert sorted((r["probe_id"], r["user_id"], r["level"]) for r in found.collect()) == [(p, p, 3) for p in range(2, 100, 2) if p != 6]
    assert re.search(r"Aggregate \[kind#\d+, key#\d+\], ", found._jdf.queryExecution().optimizedPlan().toString())


def test_outcome_lists_are_whole(spark):
    marked = spark.range(2500).select("id", F.when(F.col("id") < 2400, "success").otherwise("timeout").alias("bucket"))
    assert sorted(rows(report.outcome_lists(marked, "id"))) == sorted(("success" if i < 2400 else "timeout", str(i)) for i in range(2500))


def test_keys_that_nobody_has_are_dropped(spark):
    """No key that is known goes, nearly all others do, and the columns stay."""
    asked = spark.range(20_000).selectExpr("id AS probe_id", "if(id % 2 = 0, 'a', 'b') AS kind", "cast(id % 5000 AS string) AS key")
    owners = spark.range(400).selectExpr("'a' AS kind", "cast(id AS string) AS key")
    left = resolve.maybe_known(asked, owners, ["kind", "key"])
    assert left.columns == asked.columns and left.join(owners, ["kind", "key"]).count() == asked.join(owners, ["kind", "key"]).count() == 800
    assert left.count() < 820
    full = resolve.maybe_known(asked, owners, ["kind", "key"], maps=1)
    assert full.join(owners, ["kind", "key"]).count() == 800
    assert resolve.maybe_known(asked, owners.limit(0), ["kind", "key"]).count() == 0


def test_most_probe_keys_of_the_cascade_are_not_shuffled(spark, sf_dir):
    from concord.plans import entity_queries

    users, identities, probes = entity_queries.cascade_levels_inputs(spark, sf_dir)
    keys, asked = resolve.user_keys(users, identities), resolve.probe_keys(probes, entity_queries.LEVELS_PROVIDER)
    assert resolve.maybe_known(asked, keys, ["kind", "key"]).count() < 0.7 * asked.count()
