"""Queries over flows that end in writes: faulty notices, logins, associations, batches, summaries, group deletions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions import urls
from concord.operators import apply, delta, overlay
from concord.plans import flow_queries, pipelines
from concord.plans.entity_queries import CUT, order_documents, role_build
from concord.plans.entry import register
from concord.plans.flow_queries import CONFIG
from concord.session import table
from concord.sources import snapshots


@register(
    "notice_faults",
    """WITH e AS (SELECT event_id, event_id % 8 AS k, s_suppkey IS NOT NULL AS known FROM events LEFT JOIN supplier ON s_suppkey = user_id)
    SELECT event_id AS request_id,
      CAST(CASE WHEN k IN (0, 1, 2, 4) THEN 400 WHEN k IN (3, 6) THEN CASE WHEN known THEN 400 ELSE 404 END WHEN k = 5 THEN 400 WHEN known THEN 202 ELSE 404 END AS INTEGER) AS status,
      CAST(CASE WHEN k IN (0, 1, 2, 4) THEN 0 WHEN k = 5 THEN 1 WHEN known THEN 1 ELSE 0 END AS BIGINT) AS n_enqueued,
      CASE WHEN k IN (0, 1, 2, 4) THEN NULL WHEN k = 5 THEN 'update_group' WHEN known THEN 'update_user' END AS routes FROM e""",
)
def notice_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven of eight requests have a fault: an item without event, an unknown or no sender, an unknown type, an association without member, unknown events."""
    k, user = F.col("event_id") % 8, F.col("user_id").cast("string")
    updated = F.concat(F.lit('{"id": "'), user, F.lit('", "event": "updated"}'))
    users = lambda more="": F.concat(F.lit('"users": ['), updated, F.lit(more), F.lit("]"))
    body = lambda idp, *parts: F.concat(F.lit("{" + (f'"idp": "{idp}", ' if idp else "") + '"updates": {'), *[p if not isinstance(p, str) else F.lit(p) for p in parts], F.lit("}}"))
    raw = (
        F.when(k == 0, body("market", users(', {"id": "x"}')))
        .when(k == 1, body("elsewhere", users()))
        .when(k == 2, body("", users()))
        .when(k == 3, body("market", users(), ', "things": [{"name": "odd"}]'))
        .when(k == 4, body("market", users(), ', "associations": [{"id": "s", "event": "associated"}]'))
        .when(k == 5, body("market", '"users": [{"event": "exploded"}], "groups": [{"id": "7", "event": "updated"}]'))
        .when(k == 6, body("market", users(', {"event": "exploded"}')))
        .otherwise(body("broker", users()))
    )
    notices = table(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), raw.alias("raw"))
    batch = pipelines.receive_notices(notices, *flow_queries._users(spark, sf_dir), CONFIG)
    routes = batch.items.where("route IS NOT NULL").groupBy("request_id").agg(F.array_join(F.array_sort(F.collect_list("route")), ",").alias("routes"))
    return batch.status.select("request_id", "status", "n_enqueued").join(routes, "request_id", "left")


@register(
    "sparse_diff_lists",
    f"""WITH a AS (SELECT o_custkey AS id, coalesce(list_sort(list(DISTINCT o_orderpriority) FILTER (o_orderdate >= '{CUT}')), []) AS u, list_sort(list(DISTINCT o_orderpriority) FILTER (o_orderdate < '{CUT}')) AS o FROM orders GROUP BY 1),
    d AS (SELECT id, list_concat(list_filter(u, lambda x: NOT list_contains(coalesce(o, []), x)), list_filter(coalesce(o, []), lambda x: NOT list_contains(u, x))) AS v FROM a)
    SELECT id, 'priorities' AS path, CAST(to_json(v) AS VARCHAR) AS new_value FROM d WHERE len(v) > 0""",
)
def sparse_diff_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The priorities a customer used before a day and since; customers without earlier orders are new."""
    late = F.col("o_orderdate") >= F.lit(CUT)
    used = lambda when: F.array_sort(F.collect_set(F.when(when, F.col("o_orderpriority")))).alias("priorities")
    orders = table(spark, sf_dir, "orders").withColumn("id", F.col("o_custkey"))
    return delta.sparse_diff(orders.where(~late).groupBy("id").agg(used(F.lit(True))), orders.groupBy("id").agg(used(late)), "id")


@register(
    "create_users",
    """WITH q AS (SELECT DISTINCT user_id, 'mail' || user_id || '@x' AS email FROM events WHERE user_id % 5 <> 0), n AS (SELECT * FROM q WHERE user_id NOT IN (SELECT s_suppkey FROM supplier))
    SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY email) AS user_id, 'name' || user_id AS username, email FROM n""",
)
def create_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of events ask for accounts, some without a usable e-mail; suppliers have theirs."""
    mail = lambda c: F.concat(F.lit("mail"), F.col(c).cast("string"), F.lit("@x"))
    users = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("username"), mail("s_suppkey").alias("email"))
    asked = table(spark, sf_dir, "events").select(F.concat(F.lit("name"), F.col("user_id").cast("string")).alias("username"), F.when(F.col("user_id") % 5 == 0, "no address").otherwise(mail("user_id")).alias("email"))
    return apply.create_users(users, asked)[0].select("user_id", "username", "email")


@register(
    "link_identities",
    """WITH q AS (SELECT CAST(user_id AS VARCHAR) AS id, min(event_id % 7) AS user_id FROM events GROUP BY 1), i AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_suppkey % 7 AS user_id FROM supplier)
    SELECT * FROM i UNION ALL SELECT * FROM q WHERE id NOT IN (SELECT id FROM i)""",
)
def link_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    method = F.lit("m").alias("method")
    requests = table(spark, sf_dir, "events").select(method, F.col("user_id").cast("string").alias("id"), (F.col("event_id") % 7).alias("user_id"))
    identities = table(spark, sf_dir, "supplier").select(method, F.col("s_suppkey").cast("string").alias("id"), (F.col("s_suppkey") % 7).alias("user_id"))
    return apply.link_identities(identities, requests).select("id", "user_id")


@register(
    "delete_group",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F' AND o_custkey IN (SELECT s_suppkey FROM supplier) THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS group_id FROM orders
    UNION ALL SELECT DISTINCT 'chat---' || conv_id || '|' || role, 'role' FROM conversations WHERE conv_id NOT IN (SELECT s_suppkey FROM supplier)""",
)
def delete_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and roles that are left after the groups of all suppliers went."""
    none = F.lit(None).cast("string")
    roles = role_build(spark, sf_dir).select(F.col("role_name").alias("id"), F.col("role_name").alias("name"), none.alias("description")).distinct()
    wanted = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("group_id"))
    kept, left, _ = pipelines.delete_groups(order_documents(spark, sf_dir), roles, wanted, "1-URGENT", flow_queries.Config(provider="chat"))
    return kept.select("id", "group_id").unionByName(left.select("id", F.lit("role").alias("group_id")))


@register(
    "group_sync_written",
    """WITH a AS (SELECT CAST(o_custkey AS VARCHAR) AS g, count(*) AS n, min(o_orderkey) AS k FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F' GROUP BY 1)
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN s_suppkey IS NULL THEN 'unset' ELSE 'site ' || s_suppkey END AS website FROM orders LEFT JOIN a ON k = o_orderkey AND n = 1
    LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = a.g AND s_suppkey % 5 <> 0""",
)
def group_sync_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents after a group sync: metadata was fetched for every supplier, wrapped or bare, and failed for every fifth."""
    s = F.col("s_suppkey")
    text = s.cast("string")
    bare = F.to_json(F.struct(text.alias("id"), F.concat(F.lit("site "), text).alias("url")))
    body = F.when(s % 2 == 0, bare).otherwise(F.concat(F.lit('{"results": '), bare, F.lit("}")))
    responses = table(spark, sf_dir, "supplier").select(text.alias("group_id"), F.when(s % 10 != 5, body).alias("body"), F.when(s % 10 == 0, "timeout").alias("failure"))
    unset = {c: F.lit("unset") for c in ("title", "description", "website", "visibility", "group_name", "group_description", "group_visibility")}
    docs = order_documents(spark, sf_dir).withColumns(unset)
    updated, _ = pipelines.sync_groups(docs, snapshots.group_metadata(responses), "1-URGENT")
    return apply.upsert(docs.select("id", "website"), updated.select("id", "website"), ["id"])


@register(
    "associate",
    """WITH q AS (SELECT 'sub-' || (c_custkey + c_custkey % 2) AS id, CASE WHEN c_custkey % 3 = 0 THEN -1 - c_custkey ELSE c_custkey END AS user_id FROM customer), w AS (SELECT id, min(user_id) AS winner FROM q WHERE user_id >= 0 GROUP BY id)
    SELECT q.id, user_id, CASE WHEN user_id < 0 OR coalesce(s_suppkey, winner) <> user_id THEN 'error' ELSE 'associated' END AS status,
      CASE WHEN user_id < 0 THEN 'user not found' WHEN coalesce(s_suppkey, winner) <> user_id THEN 'identity of another user' END AS reason
    FROM q LEFT JOIN w ON w.id = q.id LEFT JOIN supplier ON 'sub-' || s_suppkey = q.id""",
)
def associate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers ask for their own subject or their neighbour's; every third is not known here."""
    users, roles, _, profiles = flow_queries.sync_inputs(spark, sf_dir)
    c = F.col("c_custkey")
    requests = table(spark, sf_dir, "customer").select(F.lit("broker").alias("method"), F.concat(F.lit("sub-"), (c + c % 2).cast("string")).alias("id"), F.when(c % 3 == 0, -1 - c).otherwise(c).alias("user_id"))
    return pipelines.associate_users(requests, users, roles, flow_queries._users(spark, sf_dir)[1], profiles, CONFIG).status.select("id", "user_id", "status", "reason")


@register(
    "broker_login_writes",
    """WITH t AS (SELECT event_id AS login_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
    SELECT login_id, CASE WHEN event_type = 'error' THEN 'bad_token' WHEN k < 20 THEN 'expired' WHEN k % 7 = 0 THEN 'bad_nonce' WHEN s_suppkey IS NOT NULL THEN 'logged_in' WHEN c_custkey IS NULL THEN 'failure' WHEN user_id % 10 = 0 THEN 'timeout' ELSE 'created' END AS outcome,
      CASE WHEN event_type = 'error' OR k < 20 OR k % 7 = 0 THEN NULL WHEN c_custkey IS NOT NULL AND user_id % 10 <> 0 THEN 'user ' || user_id ELSE s_name END AS username
    FROM t LEFT JOIN supplier ON s_suppkey = t.user_id LEFT JOIN customer ON c_custkey = t.user_id AND c_custkey % 4 <> 3""",
)
def broker_login_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logins of login_flow with what they write: customers' profiles, read but for every tenth, make accounts or new names."""
    nothing = F.create_map().cast("map<string,string>")
    known, identities = flow_queries._users(spark, sf_dir)
    users = known.select("user_id", "username", "email", F.lit(True).alias("active"), nothing.alias("preferences"), nothing.alias("user_profile"))
    text, none = F.col("c_custkey").cast("string"), F.lit(None).cast("string")
    profile = F.struct(
        F.concat(F.lit("user "), text).alias("username"), F.concat(text, F.lit("@x")).alias("email"), none.alias("name"), none.alias("first_name"), none.alias("last_name"), none.alias("institutional_affiliation"), none.alias("orcid"),
        F.array().cast("array<struct<id:string,role:string>>").alias("groups"), F.lit(False).alias("is_superadmin"),
    )
    late = F.col("c_custkey") % 10 == 0
    profiles = table(spark, sf_dir, "customer").where("c_custkey % 4 <> 3").select(F.concat(F.lit("sub-"), text).alias("sub"), F.when(~late, profile).alias("profile"), F.when(late, "timeout").otherwise("ok").alias("status"))
    no_roles = spark.createDataFrame([], "user_id long, role string")
    done = pipelines.complete_logins(flow_queries.logins(spark, sf_dir), profiles, users, no_roles, identities, CONFIG)
    return done.outcomes.join(done.users.select("user_id", "username"), "user_id", "left").select("login_id", "outcome", "username")


@register("cli_update", "SELECT p_partkey AS n, CASE WHEN s_suppkey IS NULL THEN 'not_found_local' WHEN s_suppkey % 9 = 0 THEN 'timeout' ELSE 'success' END AS bucket FROM part LEFT JOIN supplier ON s_suppkey = p_partkey")
def cli_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part number is an id on the command line; those of suppliers are synced."""
    users, roles, _, profiles = flow_queries.sync_inputs(spark, sf_dir)
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("item"))
    _, outcomes = pipelines.batch_update(items, users, roles, flow_queries._users(spark, sf_dir)[1], profiles, ["broker", "market"], CONFIG)
    return outcomes.select(F.col("id").cast("bigint").alias("n"), "bucket")


@register(
    "task_summary",
    """WITH q AS (SELECT DISTINCT user_id FROM events UNION ALL SELECT -1), m AS (SELECT q.user_id, c_custkey AS c, CASE WHEN c_custkey IS NOT NULL AND s_suppkey % 9 <> 0 THEN s_suppkey END AS k, s_suppkey, s_name FROM q LEFT JOIN customer ON c_custkey = q.user_id LEFT JOIN supplier ON s_suppkey = q.user_id)
    SELECT user_id, CASE WHEN c IS NULL THEN 'not_found_local' WHEN s_suppkey IS NULL THEN 'not_found_remote' WHEN k IS NULL THEN 'timeout' ELSE 'success' END AS bucket, k AS completed_user_id, CAST(s_suppkey AS VARCHAR) AS remote_id,
      CASE WHEN k IS NULL THEN '' ELSE concat_ws(',', CASE WHEN k % 10 = 0 THEN 'administration,administration-moderation' END, CASE WHEN c % 5 <> k % 4 THEN 'market---' || k % 4 || '|member' END) END AS added,
      CASE WHEN k IS NOT NULL AND c % 5 <> k % 4 THEN 'market---' || c % 5 || '|member' ELSE '' END AS dropped, CASE WHEN k IS NOT NULL THEN s_name END AS full_name FROM m""",
)
def task_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON summary of every user task, read again."""
    tasks = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"), F.lit("market").alias("idp"), F.col("s_suppkey").cast("string").alias("remote_id"), F.col("s_name").alias("kc_username"))
    made = pipelines.task_summaries(pipelines.sync_users(*flow_queries.sync_inputs(spark, sf_dir), CONFIG), tasks)
    shape = "remote_id string, completed_user_id long, group_changes struct<added:array<string>,dropped:array<string>>, user_field_changes map<string,string>"
    read = made.select("user_id", "bucket", F.from_json("summary", shape).alias("s"))
    roles = lambda k: F.array_join(f"s.group_changes.{k}", ",").alias(k)
    return read.select("user_id", "bucket", "s.completed_user_id", "s.remote_id", roles("added"), roles("dropped"), F.try_element_at("s.user_field_changes", F.lit("user_profile.full_name")).alias("full_name"))


@register(
    "collision_guard_email",
    """WITH u AS (SELECT c_custkey AS user_id, 'mail' || c_custkey AS old, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 'mail' || c_custkey WHEN c_custkey % 4 = 2 THEN 'mail' || (c_custkey + 1) ELSE 'new' || c_custkey // 8 END AS new FROM customer),
    w AS (SELECT new, min(user_id) AS winner FROM u WHERE new IS NOT NULL AND new <> old GROUP BY new)
    SELECT user_id, CASE WHEN u.new IS NULL OR u.new = old THEN old WHEN winner = user_id AND u.new NOT IN (SELECT old FROM u) THEN u.new ELSE old END AS email,
      CASE WHEN u.new <> old AND u.new IS NOT NULL AND winner = user_id AND u.new NOT IN (SELECT old FROM u) THEN old END AS identifier_email
    FROM u LEFT JOIN w ON w.new = u.new""",
)
def collision_guard_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New addresses that are null, the same, a neighbour's or asked for by several; a replaced one is kept in the profile."""
    c = F.col("c_custkey")
    mail = lambda n: F.concat(F.lit("mail"), n.cast("string"))
    users = table(spark, sf_dir, "customer").select(c.alias("user_id"), mail(c).alias("email"))
    new = F.when(c % 4 == 1, mail(c)).when(c % 4 == 2, mail(c + 1)).when(c % 4 == 3, F.concat(F.lit("new"), F.floor(c / 8).cast("string")))
    guarded = overlay.collision_guard(users, table(spark, sf_dir, "customer").select(c.alias("user_id"), new.alias("new_email")), "email")
    met = guarded.join(users.select("user_id", F.col("email").alias("old")), "user_id")
    profile = overlay.keep_old_email(F.create_map().cast("map<string,string>"), F.col("old"), F.col("email") != F.col("old"))
    return met.select("user_id", "email", F.try_element_at(profile, F.lit("identifier_email")).alias("identifier_email"))


@register("stored_profiles", "SELECT event_id, CASE WHEN event_type NOT IN ('error', 'signup') THEN CAST(json_extract_string(props, '$.k') AS VARCHAR) END AS k FROM events")
def stored_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored profiles as JSON text; those of errors are cut off and those of sign-ups are no objects."""
    text = F.when(F.col("event_type") == "error", F.substring("props", 1, 4)).when(F.col("event_type") == "signup", F.lit("[1, 2]")).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", F.try_element_at(overlay.stored_profile(text), F.lit("k")).alias("k"))


@register(
    "redirect_with_query",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'https://x.org/cb?next=' || replace(replace(c_name || ' & co', ' & ', '+%26+'), '#', '%23') ELSE 'https://x.org/cb?a=1' END AS target FROM customer""",
)
def redirect_with_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("c_name", F.lit(" & co"))
    even = F.col("c_custkey") % 2 == 0
    base = F.when(even, "https://x.org/cb").otherwise("https://x.org/cb?a=1")
    return table(spark, sf_dir, "customer").select("c_custkey", urls.with_query(base, next=F.when(even, name)).alias("target"))
