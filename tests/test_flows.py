from __future__ import annotations

import http.server
import json
import threading
from datetime import date

import pytest
from pyspark.sql import functions as F

from concord.config import Config
from concord.functions import codec
from concord.operators import overlay
from concord.plans import pipelines
from concord.session import shared_path
from concord.sources import snapshots, tables
from concord.streaming import streams

CONFIG = Config(provider="p", aliases=("cilogon",))
USERS = "user_id long, username string, email string, active boolean, preferences map<string,string>, user_profile map<string,string>"
PROFILE = {"username": "ann", "name": "Ann A", "email": "ann@x", "first_name": "Ann", "last_name": None, "institutional_affiliation": "", "orcid": "o1", "groups": [{"id": 1000576, "role": "admin"}], "is_superadmin": False}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def responses(spark, *rows, key="user_id"):
    return spark.createDataFrame(list(rows), f"{key} long, body string, failure string")


class TestSnapshots:
    def test_member(self, spark):
        wrapped, lacking = json.dumps({"results": PROFILE}), json.dumps({k: v for k, v in PROFILE.items() if k != "orcid"})
        found = snapshots.profiles_by_member(responses(spark, (1, json.dumps(PROFILE), None), (2, wrapped, None), (3, lacking, None), (4, "<html>", None), (5, None, "timeout"), (6, None, None)), "user_id")
        assert {r["user_id"]: (r["status"], r["profile"] and r["profile"]["groups"][0]["id"]) for r in found.collect()} == {
            1: ("ok", "1000576"), 2: ("ok", "1000576"), 3: ("parse_error", None), 4: ("parse_error", None), 5: ("timeout", None), 6: ("not_found", None),
        }

    def test_subject_with_fallback(self, spark):
        body = lambda data, ok=True: json.dumps({"data": data, "meta": {"authorized": ok}})
        one = [{"sub": "s", "profile": PROFILE}]
        subject = snapshots.profiles_by_subject(responses(spark, (1, body(one), None), (2, body([]), None), (3, body(one, False), None), (4, "{}", None), (5, body([]), None)), "user_id")
        member = snapshots.profiles_by_member(responses(spark, (2, json.dumps(PROFILE), None)), "user_id")
        out = snapshots.with_fallback(subject, member, "user_id")
        assert {r["user_id"]: (r["status"], r["profile"] is not None) for r in out.collect()} == {1: ("ok", True), 2: ("ok", True), 3: ("unauthorized", False), 4: ("parse_error", False), 5: ("not_found", False)}

    def test_arguments(self):
        assert snapshots.request_kind("s", None) == "subject" and snapshots.request_kind(None, "m") == "member"
        for both in (("s", "m"), (None, None)):
            with pytest.raises(ValueError, match="exactly one"):
                snapshots.request_kind(*both)

    def test_fetch_reports_failures(self, spark):
        out = snapshots.fetch(spark.createDataFrame([(1,)], "user_id long"), "user_id", "http://127.0.0.1:9/", timeout=0.5)
        assert [(r[0], r[1], r[2] is not None) for r in out.collect()] == [("1", None, True)]

    def test_live_service(self, spark):
        """Fetching and logout notices against a service of this process."""

        class Service(http.server.BaseHTTPRequestHandler):
            def answer(self, code, body):
                self.send_response(code)
                self.end_headers()
                self.wfile.write(json.dumps(body).encode())

            def do_GET(self):
                self.answer(200 if self.path == "/a%20b" else 404, {"seen": self.headers["Authorization"]})

            def do_POST(self):
                notice = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                code = 500 if notice["user_name"] == "bad" else 200
                self.answer(code, {"data": {"user": notice["user_name"] if notice["user_agent"] == "x" else "another"}, "message": "Successful"})

            def log_message(self, *_):
                pass

        with http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service) as service:
            threading.Thread(target=service.serve_forever, daemon=True).start()
            url = f"http://127.0.0.1:{service.server_address[1]}/"
            got = snapshots.fetch(spark.createDataFrame([("a b",), ("c",)], "k string"), "k", url, token="t")
            assert rows(got) == [("a b", '{"seen": "Bearer t"}', None), ("c", None, "not_found")]
            sent = snapshots.send_logouts(spark.createDataFrame([("ann", "x"), ("bob", "y"), ("bad", "x")], "user_name string, user_agent string"), url)
            assert rows(sent) == [("ann", 200, None, True), ("bad", 500, "request_error", False), ("bob", 200, None, False)]
            service.shutdown()

    def test_logout_answer(self, spark):
        df = spark.createDataFrame([(200, '{"data": {"user": "u"}, "message": "Successful!"}'), (200, '{"data": {"user": "v"}, "message": "successful"}'), (500, '{"data": {"user": "u"}, "message": "successful"}'), (200, None)], "code int, body string")
        assert [r[0] for r in df.select(snapshots.logout_accepted(F.col("code"), F.col("body"), F.lit("u"))).collect()] == [True, False, False, False]


class TestSync:
    def test_users(self, spark):
        users = spark.createDataFrame(
            [(1, "old", "old@x", True, {"visibility": "restricted", "lang": "en"}, {"affiliations": "Uni", "full_name": "Old"}), (2, "bob", "bob@x", True, None, None), (3, "eve", "eve@x", True, {}, {})], USERS
        )
        roles = spark.createDataFrame([(1, "admin"), (1, "p---9|member"), (2, "p---9|member")], "user_id long, role string")
        asked = spark.createDataFrame([(1,), (2,), (9,)], "user_id long")
        profiles = snapshots.profiles_by_member(responses(spark, (1, json.dumps(PROFILE), None), (2, None, "timeout")), "user_id")
        out = pipelines.sync_users(users, roles, asked, profiles, CONFIG)
        new = {r["user_id"]: r for r in out.users.collect()}
        assert (new[1]["username"], new[1]["email"], new[1]["preferences"]) == ("ann", "ann@x", {"visibility": "public", "email_visibility": "public", "lang": "en"})
        assert new[1]["user_profile"] == {"affiliations": "Uni", "full_name": "Ann A", "name_parts": '{"first":"Ann","last":""}', "identifier_kc_username": "ann", "identifier_orcid": "o1", "identifier_email": "old@x"}
        assert new[2]["username"] == "bob" and new[3]["username"] == "eve"
        assert rows(out.user_roles) == [(1, "admin"), (1, "p---1000576|admin"), (2, "p---9|member")]
        assert rows(out.outcomes) == [(1, "success"), (2, "timeout"), (9, "not_found_local")]
        assert ("email", "ann@x") in {(r["path"], r["new_value"]) for r in out.changes.collect()}

    def test_second_sync_changes_nothing(self, spark):
        users = spark.createDataFrame([(1, "old", "old@x", True, {}, {})], USERS)
        roles, asked = spark.createDataFrame([], "user_id long, role string"), spark.createDataFrame([(1,)], "user_id long")
        profiles = snapshots.profiles_by_member(responses(spark, (1, json.dumps(PROFILE), None)), "user_id")
        once = pipelines.sync_users(users, roles, asked, profiles, CONFIG)
        twice = pipelines.sync_users(once.users, once.user_roles, asked, profiles, CONFIG)
        assert rows(twice.changes) == [] and rows(twice.outcomes) == [(1, "unchanged")]

    def test_groups(self, spark):
        fields = "id string, group_id string, instance string, is_deleted boolean, title string, description string, website string, visibility string, group_name string, group_description string, group_visibility string"
        doc = lambda i, g, gone: (i, g, "i", gone, "t", "d", "w", "v", "n", "gd", "gv")
        docs = spark.createDataFrame([doc("d1", "1", False), doc("d2", "2", False), doc("d3", "2", False), doc("d4", "3", True)], fields)
        meta = spark.createDataFrame([(g, json.dumps({"id": int(g), "url": "u"}), "ok") for g in "123"], "group_id string, raw string, status string")
        updated, actions = pipelines.sync_groups(docs, meta, "i")
        assert rows(updated.select("id", "website", "title")) == [("d1", "u", "t")]
        assert rows(actions.select("group_id", "action")) == [("1", "update"), ("2", "error"), ("3", "deleted")]
        table = spark.createDataFrame([("p---1|admin", None, None), ("p---2|admin", None, None)], "id string, name string, description string")
        kept, left, summary = pipelines.delete_groups(docs, table, spark.createDataFrame([("1",)], "group_id string"), "i", CONFIG)
        assert rows(kept.select("id", "group_id"))[0] == ("d1", None) and [r[0] for r in rows(left)] == ["p---2|admin"] and rows(summary) == [("1", "d1", "p---1|admin")]


class TestEntryPoints:
    @pytest.fixture
    def local(self, spark):
        users = spark.createDataFrame([(1, "ann", "ann@x", '{"identifier_kc_username": "ann"}'), (2, "bob", "bob@x", None)], "user_id long, username string, email string, user_profile string")
        return users, spark.createDataFrame([("cilogon", "sub-ann", 1)], "method string, id string, user_id long")

    def test_notices(self, spark, local):
        bodies = [
            {"idp": "p", "updates": {"users": [{"id": "ann", "event": "updated"}, {"id": "nobody", "event": "updated"}]}},
            {"idp": "p", "updates": {"users": [{"id": "ann", "event": "exploded"}]}},
            {"idp": "cilogon", "associations": {"associations": [{"id": "new", "event": "associated", "kc_id": "bob"}]}},
            {"idp": "p", "updates": {"users": [{"id": "nobody", "event": "updated"}]}},
            {"idp": "p", "updates": {"users": [{"event": "updated"}]}},
            None,
            {"idp": "elsewhere", "updates": {"users": [{"id": "ann", "event": "updated"}]}},
            {"updates": {"users": [{"id": "ann", "event": "updated"}]}},
            {"idp": "p", "updates": {"users": [{"id": "ann", "event": "updated"}, {"id": "ann"}], "groups": [{"id": "1", "event": "updated"}]}},
            {"idp": "p", "updates": {"associations": [{"id": "new", "event": "associated"}]}},
            {"idp": "p", "updates": {"things": [{}], "users": [{"id": "ann", "event": "updated"}]}},
            {"idp": "p", "updates": {"things": [], "users": [{"id": "ann", "event": "updated"}]}},
            {"idp": "p", "updates": {"users": [{"event": "exploded"}, {"id": "nobody", "event": "updated"}]}},
            {"idp": "p", "updates": {}},
        ]
        raw = spark.createDataFrame([(k, json.dumps(b) if b else "nonsense") for k, b in enumerate(bodies)], "request_id long, raw string")
        out = pipelines.receive_notices(raw, *local, CONFIG)
        status = {r["request_id"]: (r["status"], r["n_enqueued"]) for r in out.status.collect()}
        assert status == {0: (202, 1), 1: (400, 0), 2: (202, 1), 3: (404, 0), 4: (400, 0), 5: (400, 0), 6: (400, 0), 7: (400, 0), 8: (400, 0), 9: (400, 0), 10: (400, 1), 11: (400, 1), 12: (404, 0), 13: (400, 0)}
        routed = {(r["request_id"], r["route"], r["user_id"], r["oauth_id"]) for r in out.items.where("route IS NOT NULL").collect()}
        assert routed == {(0, "update_user", 1, "sub-ann"), (2, "associate_user", 2, None), (10, "update_user", 1, "sub-ann"), (11, "update_user", 1, "sub-ann")}
        assert {r["request_id"] for r in out.items.collect()}.isdisjoint({5, 6, 7, 13})

    def test_login(self, spark, local):
        token = lambda sub, exp, nonce, name=None: json.dumps({"userinfo": {"sub": sub, "email": "eve@x"}, "nonce": nonce, "exp": exp, "kc_username": name, "primary_email": ""})
        raw = [(1, token("sub-ann", 100, "n")), (2, token("s", 99.9, "n")), (3, token("s", 100, "other")), (4, token("s", 100, "n")), (5, token("s", 100, "n", "bob"))]
        sealed = spark.createDataFrame(raw, "login_id long, raw string").select("login_id", codec.seal(F.col("raw"), F.lit("k")).alias("token"))
        sealed = sealed.union(spark.createDataFrame([(6, "garbage")], sealed.schema))
        out = pipelines.broker_login(sealed, "k", spark.createDataFrame([("n",)], "nonce string"), *local, "100", CONFIG)
        assert rows(out.select("login_id", "status", "user_id")) == [(1, "ok", 1), (2, "expired", None), (3, "bad_nonce", None), (4, "new_user", None), (5, "ok", 2), (6, "bad_token", None)]

    def test_logout(self, spark, local):
        asked = spark.createDataFrame([(1, "ann"), (2, "nobody"), (3, "bob")], "request_id long, user_name string")
        sessions = spark.createDataFrame([("a", 1), ("b", 1), ("c", 5)], "session_id string, user_id long")
        left, status = pipelines.logout(asked, *local, sessions, CONFIG)
        assert rows(left) == [(5, "c")] or rows(left) == [("c", 5)]
        assert rows(status) == [(1, 200, 2), (2, 404, 0), (3, 200, 0)]

    def test_cli(self, spark, local):
        items = spark.createDataFrame([("1-3",), ("2",), ("bob",)], "item string")
        ids = pipelines.batch_update_ids(items)
        assert [r[0] for r in rows(ids)] == ["1", "2", "3", "bob"]
        found = pipelines.batch_update_targets(ids, local[1], ["cilogon", "p"])
        assert rows(found)[0] == ("1", "cilogon", 1, "sub-ann") and rows(found)[1] == ("2", None, None, None)
        new, status = pipelines.associate(spark.createDataFrame([("cilogon", "sub-ann", 2), ("p", "x", 2)], "method string, id string, user_id long"), local[1])
        assert rows(new) == [("cilogon", "sub-ann", 1), ("p", "x", 2)] and {r[3] for r in rows(status)} == {"error", "linked"}


class TestWrites:
    """What follows logins, associations and command-line batches."""

    @pytest.fixture
    def users(self, spark):
        return spark.createDataFrame([(1, "ann", "ann@x", True, {}, {"identifier_kc_username": "ann"}), (2, "bob", "bob@x", True, {}, {})], USERS)

    @pytest.fixture
    def identities(self, spark):
        return spark.createDataFrame([("cilogon", "sub-ann", 1)], "method string, id string, user_id long")

    @pytest.fixture
    def no_roles(self, spark):
        return spark.createDataFrame([], "user_id long, role string")

    def profiles(self, spark, key, *named):
        read = snapshots.profiles_by_member(spark.createDataFrame([(k, json.dumps(PROFILE | {"username": n, "email": f"{n}@x"}) if n else None, f) for k, n, f in named], f"{key} {'long' if key == 'user_id' else 'string'}, body string, failure string"), key)
        return read.select(key, "profile", "status")

    def test_logins(self, spark, users, identities, no_roles):
        logins = spark.createDataFrame([(1, "ok", 1, 1, "sub-ann"), (2, "new_user", None, None, "sub-new"), (3, "new_user", None, None, "sub-lost"), (4, "expired", None, None, "s"), (5, "ok", 2, 8, "sub-bob"), (6, "new_user", None, None, "sub-late"), (7, "new_user", None, None, "sub-new2")], "login_id long, status string, user_id long, level int, sub string")
        profiles = self.profiles(spark, "sub", ("sub-ann", "ann", None), ("sub-new", "cyd", None), ("sub-bob", None, "request_error"), ("sub-late", None, "timeout"), ("sub-new2", "dee", None))
        out = pipelines.complete_logins(logins, profiles, users, no_roles, identities, CONFIG)
        assert rows(out.outcomes) == [(1, 1, "logged_in"), (2, 3, "created"), (3, None, "failure"), (4, None, "expired"), (5, 2, "logged_in"), (6, None, "timeout"), (7, 4, "created")]
        assert rows(out.identities) == [("cilogon", "sub-ann", 1), ("cilogon", "sub-bob", 2), ("cilogon", "sub-new", 3), ("cilogon", "sub-new2", 4)]
        assert {r["user_id"]: r["username"] for r in out.users.collect()} == {1: "ann", 2: "bob", 3: "cyd", 4: "dee"}
        assert {r["user_id"]: r["bucket"] for r in out.sync.outcomes.collect()} == {1: "success", 2: "failure", 3: "success", 4: "success"}
        assert rows(out.sync.user_roles) == [(u, "p---1000576|admin") for u in (1, 3, 4)]

    def test_logins_are_worked_out_once(self, spark, users, identities, no_roles):
        """Those refused don't have the tokens opened and the users looked for again; repeated and null rows stay as they are."""
        path = shared_path(spark, "logins")
        made = [(1, "ok", 1, 1, "sub-ann"), (1, "ok", 1, 1, "sub-ann"), (2, "expired", None, None, None), (2, "expired", None, None, None), (None, "bad_token", None, None, "sub-ann"), (3, None, None, None, "sub-ann")]
        spark.createDataFrame(made, "login_id long, status string, user_id long, level int, sub string").write.parquet(path)
        out = pipelines.complete_logins(spark.read.parquet(path), self.profiles(spark, "sub", ("sub-ann", "ann", None)), users, no_roles, identities, CONFIG)
        assert out.outcomes.inputFiles() == []
        assert rows(out.outcomes) == [(1, 1, "logged_in"), (1, 1, "logged_in"), (2, None, "expired"), (2, None, "expired"), (None, None, "bad_token")]

    def test_associations(self, spark, users, identities, no_roles):
        requests = spark.createDataFrame([("cilogon", "sub-bob", 2), ("cilogon", "sub-ann", 2), ("cilogon", "sub-ann", 1), ("cilogon", "s", 9)], "method string, id string, user_id long")
        out = pipelines.associate_users(requests, users, no_roles, identities, self.profiles(spark, "user_id", (1, "ann", None), (2, "bob", None)), CONFIG)
        assert rows(out.status) == [("cilogon", "s", 9, "error", "user not found"), ("cilogon", "sub-ann", 1, "associated", None), ("cilogon", "sub-ann", 2, "error", "identity of another user"), ("cilogon", "sub-bob", 2, "associated", None)]
        assert rows(out.identities) == [("cilogon", "sub-ann", 1), ("cilogon", "sub-bob", 2)]
        assert {r["user_id"] for r in out.sync.outcomes.collect()} == {1, 2}

    def test_batch_and_summaries(self, spark, users, identities, no_roles):
        items = spark.createDataFrame([("1-2",), ("x",)], "item string")
        sync, outcome = pipelines.batch_update(items, users, no_roles, identities, self.profiles(spark, "user_id", (1, "ann", None)), ["cilogon", "p"], CONFIG)
        assert rows(outcome) == [("1", "cilogon", 1, "success"), ("2", None, None, "not_found_local"), ("x", None, None, "not_found_local")]
        tasks = spark.createDataFrame([(1, "p", "sub-ann", "ann")], "user_id long, idp string, remote_id string, kc_username string")
        found = {r["user_id"]: json.loads(r["summary"]) for r in pipelines.task_summaries(sync, tasks).collect()}
        assert found[1] == {
            "user_id": 1, "idp": "p", "remote_id": "sub-ann", "kc_username": "ann", "completed_user_id": 1, "groups": ["p---1000576|admin"], "group_changes": {"added": ["p---1000576|admin"], "dropped": [], "unchanged": []},
            "user_field_changes": {"preferences.email_visibility": "public", "preferences.visibility": "public", "user_profile.full_name": "Ann A", "user_profile.identifier_orcid": "o1", "user_profile.name_parts": '{"first":"Ann","last":""}'},
        }

    def test_corrupt_profile(self, spark):
        df = spark.createDataFrame([("{bad",), (None,), ('{"a": "b"}',), ("[1]",)], "t string")
        assert [r[0] for r in df.select(overlay.stored_profile(F.col("t"))).collect()] == [{}, {}, {"a": "b"}, {}]


def test_versioned_table(spark, tmp_path):
    t = tables.VersionedTable(spark, str(tmp_path / "users"))
    with pytest.raises(FileNotFoundError):
        t.read()
    t.replace(spark.range(3))
    t.replace(t.read().where("id > 0"))
    assert sorted(r[0] for r in t.read().collect()) == [1, 2]


def test_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    start = 1_700_000_000
    for chunk in ([(1, 0), (1, 30), (2, 5)], [(1, 61), (1, 100)], [(1, 122), (2, 66)]):
        df = spark.createDataFrame([(u, start + s) for u, s in chunk], "u long, s long")
        df.select("u", F.timestamp_seconds("s").alias("ts"), F.lit("users").alias("entity_type"), F.when(F.col("u") == 1, "updated").otherwise("odd").alias("event")).coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    streams.run_to_table(streams.throttle_stream(stream(), "u", "ts", 60), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = {(r["u"], int(r["us"]) - start) for r in spark.read.parquet(str(tmp_path / "out")).select("u", (F.unix_micros("ts") / 1_000_000).alias("us")).collect()}
    assert got == {(1, 0), (1, 61), (1, 122), (2, 5), (2, 66)}
    # With a watermark states time out, and the same events are emitted.
    streams.run_to_table(streams.throttle_stream(stream(), "u", "ts", 60, "40 seconds"), str(tmp_path / "out2"), str(tmp_path / "ck3"))
    assert {(r["u"], int(r["us"]) - start) for r in spark.read.parquet(str(tmp_path / "out2")).select("u", (F.unix_micros("ts") / 1_000_000).alias("us")).collect()} == got
    table = spark.createDataFrame([("users", "updated")], "entity_type string, event string")
    streams.write_routes(streams.route_stream(stream(), table), str(tmp_path / "routes"), str(tmp_path / "ck2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "routes")).where("route = 'update_user'").count() == 5


def arriving(spark, tmp_path, chunks, kind):
    """A stream of (u, ts) with a micro-batch for each of chunks (user, second)."""
    source = str(tmp_path / "in")
    for chunk in chunks:
        spark.createDataFrame([(u, 1_700_000_000 + s) for u, s in chunk], f"u {kind}, s long").select("u", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(f"u {kind}, ts timestamp").option("maxFilesPerTrigger", 1).parquet(source)


def test_a_throttled_stream_calls_python_for_groups_of_users(spark, tmp_path):
    """Each call takes milliseconds: there are no more of them, and of states, than groups, however many users there are."""
    chunks = [[(u, 100 * k + u % 90) for u in range(1500)] for k in range(2)]
    stream = arriving(spark, tmp_path, chunks, "long")
    query = streams.throttle_stream(stream, "u", "ts", 100).writeStream.format("memory").queryName("throttled").trigger(availableNow=True).start()
    query.awaitTermination()
    updated = [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.numInputRows]
    assert len(updated) == 2 and max(updated) <= 1024
    assert rows(spark.table("throttled").groupBy("u").count()) == sorted(((u, 1) for u in range(1500)), key=repr)


@pytest.mark.parametrize(("kind", "users"), [("long", [None, 2**60, 2**60 + 1]), ("string", [None, "", "a"]), ("double", [None, float("nan"), 0.5]), ("date", [None, date(1969, 5, 1), date(2024, 1, 1)])])
def test_a_throttled_stream_tells_users_of_one_group_apart(spark, tmp_path, kind, users):
    chunks = [[(u, 10 * n) for n, u in enumerate(users)], [(u, 70 * (n + 1)) for n, u in enumerate(users)], [(u, 135) for u in users]]
    streams.run_to_table(streams.throttle_stream(arriving(spark, tmp_path, chunks, kind), "u", "ts", 60, "1000 seconds", groups=1), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = spark.read.parquet(str(tmp_path / "out")).select(F.coalesce(F.col("u").cast("string"), F.lit("null")), F.unix_seconds("ts") - 1_700_000_000)
    names = ["null", *(str(u) if u == u else "null" for u in users[1:])]  # pandas, by which Spark takes the rows back, has one for both
    assert rows(got) == sorted([*zip(names, (0, 10, 20), strict=True), *zip(names, (70, 140, 210), strict=True), (names[0], 135)], key=repr)


def test_an_event_behind_the_watermark_of_its_batch(spark, tmp_path):
    """An event of a user whose interval has passed may come in the batch that the watermark passes it; then the user is forgotten."""
    stream = arriving(spark, tmp_path, [[(1, 0), (2, 100)], [(1, 50), (2, 120)], [(1, 111)]], "long")
    streams.run_to_table(streams.throttle_stream(stream, "u", "ts", 60, "10 seconds"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("u", F.unix_seconds("ts") - 1_700_000_000)) == [(1, 0), (1, 111), (2, 100)]


def test_login_plans_do_not_show_the_secret(spark):
    """Neither the shared secret nor the key made of it."""
    import hashlib

    secret = "a secret that nobody may read"
    tokens = spark.createDataFrame([(1, "x")], "login_id long, token string")
    nonces = spark.createDataFrame([("n",)], "nonce string")
    users = spark.createDataFrame([(1, "ann", "ann@x", None)], "user_id long, username string, email string, user_profile string")
    identities = spark.createDataFrame([], "method string, id string, user_id long")
    key = spark.createDataFrame([(secret,)], "secret string").scalar()
    from concord.functions import codec

    opened = tokens.select(codec.unseal(F.col("token"), key).alias("raw"))
    opened.collect()
    shown = opened._jdf.queryExecution().toString().lower()
    digest = hashlib.sha256(secret.encode()).hexdigest()
    assert secret not in shown and digest not in shown and "aes" in shown
    assert [r["status"] for r in pipelines.broker_login(tokens, secret, nonces, users, identities, "1", CONFIG).collect()] == ["bad_token"]


def test_wide_ranges_on_the_command_line(spark):
    items = spark.createDataFrame([("5-7",), ("6-9",), ("3-1",), ("x",), ("12",), ("100-3000000000",)], "item string")
    ids = spark.createDataFrame([("6",), ("8",), ("12",), ("012",), ("2999999999",), ("3000000001",), ("x",), ("y",)], "id string")
    assert rows(pipelines.ids_in_items(ids, items)) == [("12",), ("2999999999",), ("6",), ("8",), ("x",)]
    assert sorted(r["id"] for r in pipelines.batch_update_ids(items.where("item NOT LIKE '100%'")).collect()) == ["12", "5", "6", "7", "8", "9", "x"]
    wide = spark.createDataFrame([("1-70000",)], "item string")
    assert pipelines.batch_update_ids(wide).count() == 70_000


def test_a_journal_asks_once(spark, tmp_path):
    """A service counts what it is asked: each question once, after a failed run, when a plan is computed again and in a later run; failures are asked again."""
    asked: list[str] = []

    class Service(http.server.BaseHTTPRequestHandler):
        def answer(self, code, body):
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def do_GET(self):
            asked.append(self.path)
            self.answer(503 if self.path == "/9" and asked.count("/9") == 1 else 200, {"path": self.path})

        def do_POST(self):
            notice = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append(notice["user_name"])
            self.answer(200, {"data": {"user": notice["user_name"]}, "message": "successful"})

        def log_message(self, *_):
            pass

    def fails(batches):
        for b in batches:
            yield b
        raise RuntimeError("this task is lost after it asked")

    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service) as service:
        threading.Thread(target=service.serve_forever, daemon=True).start()
        url, journal = f"http://127.0.0.1:{service.server_address[1]}/", (tmp_path / "journal").as_uri()
        keys = spark.range(12).union(spark.range(6)).repartition(3)
        with pytest.raises(Exception, match="this task is lost"):
            snapshots.fetch(keys, "id", url, journal=journal).mapInArrow(fails, "id string, body string, failure string").collect()
        for _ in range(2):
            got = snapshots.fetch(keys, "id", url, journal=journal)
            assert sorted(int(r["id"]) for r in got.collect()) == list(range(12))
        assert got.where("failure IS NULL").count() >= 11
        assert all(asked.count(f"/{k}") == 1 for k in range(12) if k != 9)
        notices = spark.createDataFrame([(f"u{k}", "x") for k in range(5)], "user_name string, user_agent string")
        for batch, times in (("monday", 1), ("monday", 1), ("tuesday", 2)):
            sent = snapshots.send_logouts(notices, url, journal=journal, batch=batch)
            assert sent.where("accepted").count() == 5
            assert all(asked.count(f"u{k}") == times for k in range(5))
        service.shutdown()
