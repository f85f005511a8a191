"""Queries over remote snapshots and role tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators import apply
from concord.plans.entry import register
from concord.session import shared_path, table
from concord.sources import snapshots

KEYS = '"first_name": null, "last_name": "x", "institutional_affiliation": ""'


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer for each event: whole, wrapped, incomplete, missing or garbled, by kind of event."""
    e, name = F.col("event_type"), F.col("user_id").cast("string")
    whole = F.concat(F.lit('{"username": "u'), name, F.lit('", "orcid": "o", ' + KEYS + "}"))
    body = F.when(e == "click", whole).when(e == "view", F.concat(F.lit('{"results": '), whole, F.lit("}"))).when(e == "purchase", F.lit("{" + KEYS + "}")).when(e == "signup", "<html>")
    failure = F.when((e == "error") & (F.col("event_id") % 2 == 0), "timeout")
    return table(spark, sf_dir, "events").select("event_id", body.alias("body"), failure.alias("failure"))


@register(
    "snapshot_by_member",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'u' || user_id END AS username,
      CASE event_type WHEN 'click' THEN 'ok' WHEN 'view' THEN 'ok' WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'timeout' ELSE 'not_found' END ELSE 'parse_error' END AS status FROM events""",
)
def snapshot_by_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.profiles_by_member(_responses(spark, sf_dir), "event_id").select("event_id", "profile.username", "status")


@register(
    "snapshot_fallback",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_type IN ('click', 'view') THEN 'u' || user_id END WHEN event_id % 3 = 1 THEN 's' || user_id END AS username,
      CASE event_id % 3 WHEN 0 THEN CASE event_type WHEN 'click' THEN 'ok' WHEN 'view' THEN 'ok' WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'timeout' ELSE 'not_found' END ELSE 'parse_error' END
        WHEN 1 THEN 'ok' ELSE 'unauthorized' END AS status FROM events""",
)
def snapshot_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject answers: every third without data, every third not authorized."""
    n, name = F.col("event_id"), F.col("user_id").cast("string")
    entry = F.concat(F.lit('{"sub": "x", "profile": {"username": "s'), name, F.lit('", "orcid": "o", ' + KEYS + "}}"))
    body = F.concat(F.lit('{"meta": {"authorized": '), F.when(n % 3 == 2, "false").otherwise("true"), F.lit('}, "data": ['), F.when(n % 3 == 0, "").otherwise(entry), F.lit("]}"))
    subject = table(spark, sf_dir, "events").select("event_id", body.alias("body"), F.lit(None).cast("string").alias("failure"))
    by_subject = snapshots.profiles_by_subject(subject, "event_id")
    by_member = snapshots.profiles_by_member(_responses(spark, sf_dir), "event_id")
    return snapshots.with_fallback(by_subject, by_member, "event_id").select("event_id", "profile.username", "status")


@register(
    "snapshot_files",
    "SELECT event_id, CASE event_type WHEN 'click' THEN 'ok' WHEN 'view' THEN 'ok' WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'timeout' ELSE 'not_found' END ELSE 'parse_error' END AS status FROM events",
)
def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member answers that a fetcher left as files of JSON lines."""
    path = shared_path(spark, "responses")
    _responses(spark, sf_dir).write.json(path)
    found = snapshots.profiles_by_member(snapshots.read_responses(spark, path, "event_id"), "event_id")
    return found.select(F.col("event_id").cast("bigint").alias("event_id"), "status")


@register("logout_answers", "SELECT event_id, event_type = 'click' AND event_id % 2 = 0 AS accepted FROM events")
def logout_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_type")
    user = F.col("user_id").cast("string")
    body = F.concat(F.lit('{"data": {"user": "'), F.when(e == "view", "another").otherwise(user), F.lit('"}, "message": "'), F.when(e == "error", "failed").otherwise("Logout Successful"), F.lit('"}'))
    code = F.when(F.col("event_id") % 2 == 0, F.when(e.isin("click", "view", "error"), 204).otherwise(302)).otherwise(500)
    return table(spark, sf_dir, "events").select("event_id", snapshots.logout_accepted(code, body, user).alias("accepted"))


@register("issued_nonces", "SELECT event_id FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)")
def issued_nonces(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("nonce"))
    nonces = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("string").alias("nonce"))
    return snapshots.issued(tokens, nonces).select("event_id")


def _roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("id"), F.col("p_brand").alias("name"), none.alias("description")).distinct()


@register("role_find_or_create", "SELECT DISTINCT p_brand AS id FROM part UNION SELECT DISTINCT p_type FROM part")
def role_find_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.find_or_create_roles(_roles(spark, sf_dir), table(spark, sf_dir, "part").select(F.col("p_type").alias("id"))).select("id")


@register("role_delete", "SELECT DISTINCT p_brand || ' ' || p_size AS id FROM part WHERE p_size <= 45")
def role_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands by size are roles; those of large sizes go."""
    roles = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_brand", F.col("p_size").cast("string")).alias("id"), "p_size").distinct()
    return apply.delete_roles(roles.drop("p_size"), roles.where("p_size > 45").select("id"))[0]


@register(
    "user_role_edits",
    """SELECT DISTINCT c_custkey AS user_id, role FROM (SELECT c_custkey, c_mktsegment AS role FROM customer UNION ALL SELECT o_custkey, o_orderpriority FROM orders)
       WHERE (c_custkey, role) NOT IN (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F')""",
)
def user_role_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments are held, priorities of orders are added, those of finished orders removed."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("role"), "o_orderstatus")
    held = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("role"))
    return apply.remove_user_roles(apply.add_user_roles(held, orders), orders.where("o_orderstatus = 'F'"))
