"""Whole reconciliations over the driver's tables: notices, logins, logouts, user and group syncs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.config import Config
from concord.functions import codec
from concord.plans import pipelines
from concord.plans.entry import register
from concord.session import table

CONFIG = Config(provider="market", aliases=("broker",), allowed_events={"users": ("created", "updated"), "groups": ("updated", "deleted"), "associations": ("associated",)})


def _users(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers as users whose member name is their number, each linked under `broker`."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    profile = F.to_json(F.struct(key.cast("string").alias("identifier_kc_username")))
    users = s.select(key.alias("user_id"), F.col("s_name").alias("username"), F.lit(None).cast("string").alias("email"), profile.alias("user_profile"))
    return users, s.select(F.lit("broker").alias("method"), F.concat(F.lit("sub-"), key.cast("string")).alias("id"), key.alias("user_id"))


def notices_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notice_bodies(table(spark, sf_dir, "events"))


def notice_bodies(events: DataFrame) -> DataFrame:
    """Each event as a request with one item: clicks and views are user notices, purchases and sign-ups group notices, errors associations."""
    e = F.col("event_type")
    text = F.col("user_id").cast("string")
    item = lambda event: F.array(F.struct(text.alias("id"), F.lit(event).alias("event")))
    users = F.when(e == "click", item("updated")).when(e == "view", item("created"))
    groups = F.when(e == "purchase", item("updated")).when(e == "signup", item("deleted"))
    plain = F.to_json(F.struct(F.lit("market").alias("idp"), F.struct(users.alias("users"), groups.alias("groups")).alias("updates")))
    # An association names the new subject, and the member by another key; the envelope has no updates.
    link = F.array(F.struct(F.concat(F.lit("new-"), text).alias("id"), F.lit("associated").alias("event"), text.alias("kc_id")))
    bare = F.to_json(F.struct(F.lit("market").alias("idp"), F.struct(link.alias("associations")).alias("associations")))
    return events.select(F.col("event_id").alias("request_id"), F.when(e == "error", bare).otherwise(plain).alias("raw"))


NOTICES_SQL = """
SELECT event_id AS request_id, CAST(CASE WHEN event_type IN ('purchase', 'signup') OR s_suppkey IS NOT NULL THEN 202 ELSE 404 END AS INTEGER) AS status,
  CASE WHEN event_type IN ('purchase', 'signup') OR s_suppkey IS NOT NULL THEN
    CASE event_type WHEN 'click' THEN 'update_user' WHEN 'view' THEN 'unexpected' WHEN 'purchase' THEN 'update_group' WHEN 'signup' THEN 'not_implemented' ELSE 'associate_user' END END AS route,
  CASE WHEN event_type IN ('click', 'view', 'error') THEN 'sub-' || s_suppkey END AS oauth_id
FROM events LEFT JOIN supplier ON s_suppkey = user_id"""


@register("notice_flow", NOTICES_SQL)
def notice_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = pipelines.receive_notices(notices_of(spark, sf_dir), *_users(spark, sf_dir), CONFIG)
    return batch.status.select("request_id", "status").join(batch.items.select("request_id", "route", "oauth_id"), "request_id", "left")


@register("flagship_routes", f"SELECT route, status, count(*) AS n FROM ({NOTICES_SQL}) GROUP BY route, status")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices are normalised, expanded, filtered, resolved to users, linked, routed and counted."""
    return notice_flow(spark, sf_dir).groupBy("route", "status").agg(F.count("*").alias("n"))


@register(
    "login_flow",
    """WITH t AS (SELECT event_id AS login_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
    SELECT login_id, CASE WHEN event_type = 'error' THEN 'bad_token' WHEN k < 20 THEN 'expired' WHEN k % 7 = 0 THEN 'bad_nonce' WHEN s_suppkey IS NULL THEN 'new_user' ELSE 'ok' END AS status,
      CASE WHEN event_type <> 'error' AND k >= 20 AND k % 7 <> 0 THEN s_suppkey END AS user_id FROM t LEFT JOIN supplier ON s_suppkey = t.user_id""",
)
def login_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logins(spark, sf_dir).select("login_id", "status", "user_id")


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is a login token: errors are sealed with another secret, k is the time of expiry and decides the nonce."""
    k = F.get_json_object("props", "$.k").cast("int")
    sub = F.concat(F.lit("sub-"), F.col("user_id").cast("string"))
    raw = F.to_json(F.struct(F.struct(sub.alias("sub"), F.lit("").alias("email")).alias("userinfo"), F.concat(F.lit("n"), k.cast("string")).alias("nonce"), (k + F.lit(0.5)).alias("exp")))
    token = codec.seal(raw, F.when(F.col("event_type") == "error", "wrong").otherwise("right"))
    tokens = table(spark, sf_dir, "events").select(F.col("event_id").alias("login_id"), token.alias("token"))
    nonces = spark.range(100).where("id % 7 <> 0").select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("nonce"))
    return pipelines.broker_login(tokens, "right", nonces, *_users(spark, sf_dir), "20.0", CONFIG)


@register(
    "logout_flow",
    """WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
    SELECT c_custkey AS request_id, CAST(CASE WHEN s_suppkey IS NULL THEN 404 ELSE 200 END AS INTEGER) AS status, CASE WHEN s_suppkey IS NULL THEN 0 ELSE coalesce(n, 0) END AS n_sessions
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey LEFT JOIN n ON n.user_id = c_custkey""",
)
def logout_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer number is logged out; events are sessions."""
    sessions = table(spark, sf_dir, "events").select(F.col("event_id").alias("session_id"), "user_id")
    requests = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("request_id"), F.col("c_custkey").cast("string").alias("user_name"))
    return pipelines.logout(requests, *_users(spark, sf_dir), sessions, CONFIG)[1]


def sync_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Customers are local users; the suppliers of equal number their remote profiles, some of which could not be read."""
    text = lambda *pairs: F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)])
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    users = table(spark, sf_dir, "customer").select(
        c.alias("user_id"), F.col("c_name").alias("username"), F.concat(F.lit("mail"), c.cast("string")).alias("email"), F.lit(True).alias("active"), text(("visibility", F.lit("public")), ("email_visibility", F.lit("public"))).alias("preferences"), text(("full_name", F.col("c_name"))).alias("user_profile")
    )
    roles = table(spark, sf_dir, "customer").select(c.alias("user_id"), F.concat(F.lit("market---"), (c % 5).cast("string"), F.lit("|member")).alias("role"))
    none = F.lit(None).cast("string")
    profile = F.struct(
        F.when(s % 2 == 0, F.col("s_name")).otherwise(F.concat(F.lit("Customer#"), F.lpad((s + 1).cast("string"), 9, "0"))).alias("username"), F.concat(F.lit("mail"), s.cast("string")).alias("email"), F.col("s_name").alias("name"), none.alias("first_name"), none.alias("last_name"), none.alias("institutional_affiliation"), none.alias("orcid"),
        F.array(F.struct((s % 4).cast("string").alias("id"), F.lit("member").alias("role"))).alias("groups"), (s % 10 == 0).alias("is_superadmin"),
    )
    profiles = table(spark, sf_dir, "supplier").select(s.alias("user_id"), profile.alias("profile"), F.when(s % 9 == 0, "timeout").otherwise("ok").alias("status"))
    requests = table(spark, sf_dir, "events").select("user_id").distinct().union(spark.range(1).select((F.col("id") - 1).alias("user_id")))
    return users, roles, requests, profiles


@register(
    "user_sync_roles",
    """WITH q AS (SELECT DISTINCT user_id FROM events), r AS (SELECT s_suppkey AS k FROM supplier JOIN q ON user_id = s_suppkey WHERE s_suppkey % 9 <> 0)
    SELECT c_custkey AS user_id, 'market---' || c_custkey % 5 || '|member' AS role FROM customer WHERE c_custkey NOT IN (SELECT k FROM r)
    UNION SELECT k, 'market---' || k % 4 || '|member' FROM r
    UNION SELECT k, a FROM r, (VALUES ('administration'), ('administration-moderation')) t(a) WHERE k % 10 = 0""",
)
def user_sync_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.sync_users(*sync_inputs(spark, sf_dir), CONFIG).user_roles


@register(
    "user_sync_names",
    """WITH q AS (SELECT DISTINCT user_id FROM events), r AS (SELECT s_suppkey AS k, s_name FROM supplier JOIN q ON user_id = s_suppkey WHERE s_suppkey % 9 <> 0)
    SELECT c_custkey AS user_id, CASE WHEN k % 2 = 0 THEN s_name WHEN k IS NOT NULL AND c_custkey + 1 >= (SELECT count(*) FROM customer) THEN 'Customer#' || lpad(CAST(k + 1 AS VARCHAR), 9, '0') ELSE c_name END AS username,
      coalesce(s_name, c_name) AS full_name FROM customer LEFT JOIN r ON k = c_custkey""",
)
def user_sync_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even users take the new name; odd ones ask for their neighbour's, which is taken."""
    users = pipelines.sync_users(*sync_inputs(spark, sf_dir), CONFIG).users
    return users.select("user_id", "username", F.try_element_at("user_profile", F.lit("full_name")).alias("full_name"))


@register(
    "user_sync_outcomes",
    """SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN c_custkey IS NULL THEN 'not_found_local' WHEN s_suppkey IS NULL THEN 'not_found_remote' WHEN s_suppkey % 9 = 0 THEN 'timeout' ELSE 'success' END AS bucket
    FROM (SELECT DISTINCT user_id FROM events UNION ALL SELECT -1) q LEFT JOIN customer ON c_custkey = q.user_id LEFT JOIN supplier ON s_suppkey = q.user_id) GROUP BY bucket""",
)
def user_sync_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.sync_users(*sync_inputs(spark, sf_dir), CONFIG).outcomes.groupBy("bucket").agg(F.count("*").alias("n"))


@register(
    "group_sync",
    """WITH a AS (SELECT CAST(o_custkey AS VARCHAR) AS g, count(*) FILTER (o_orderstatus <> 'F') AS n, min(o_orderkey) FILTER (o_orderstatus <> 'F') AS k FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
    SELECT CAST(k AS VARCHAR) AS id, g AS group_id, s_name AS group_name, 'site ' || s_suppkey AS website FROM a JOIN supplier ON CAST(s_suppkey AS VARCHAR) = g WHERE n = 1""",
)
def group_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as group metadata for the order documents of equal number."""
    from concord.plans.entity_queries import order_documents

    text = F.col("s_suppkey").cast("string")
    raw = F.to_json(F.struct(text.alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("site "), text).alias("url")))
    metadata = table(spark, sf_dir, "supplier").select(text.alias("group_id"), raw.alias("raw"), F.lit("ok").alias("status"))
    unset = {c: F.lit("unset") for c in ("title", "description", "website", "visibility", "group_name", "group_description", "group_visibility")}
    docs = order_documents(spark, sf_dir).withColumns(unset)
    return pipelines.sync_groups(docs, metadata, "1-URGENT")[0].select("id", "group_id", "group_name", "website")


@register("cli_targets", "SELECT p_partkey AS n, CASE WHEN s_suppkey IS NOT NULL THEN 'broker' END AS matched_source, s_suppkey AS user_id FROM part LEFT JOIN supplier ON s_suppkey = p_partkey")
def cli_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part number is an id on the command line."""
    found = pipelines.batch_update_targets(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id")), _users(spark, sf_dir)[1], ["broker", "market"])
    return found.select(F.col("id").cast("bigint").alias("n"), "matched_source", "user_id")
