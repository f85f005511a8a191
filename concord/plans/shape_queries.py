"""Queries over JSON of any shape: conversations packed as nested objects, and the properties of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators import shapes
from concord.plans.entry import register
from concord.session import table


def _object(pairs: Column) -> Column:
    """A JSON object of an array of (key, JSON text), in the order of keys."""
    member = F.transform(F.array_sort(pairs), lambda p: F.concat(F.lit('"'), p["key"], F.lit('":'), p["value"]))
    return F.concat(F.lit("{"), F.array_join(member, ","), F.lit("}"))


def packed(turns: DataFrame, role: Column) -> DataFrame:
    """id and one object for each conversation: n, roles (a list in the order of turns), and turns, each an object of role and size."""
    turn = F.struct(F.concat(F.lit("t"), F.col("turn").cast("string")).alias("key"), F.to_json(F.struct(role.alias("role"), F.coalesce(F.length("text"), F.lit(0)).alias("size"))).alias("value"))
    held = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.collect_list(turn).alias("turns"), F.array_sort(F.collect_list(F.struct("turn", role.alias("role")))).alias("roles"))
    roles = F.to_json(F.transform("roles", lambda r: r["role"]))
    body = F.concat(F.lit('{"n":'), F.col("n").cast("string"), F.lit(',"roles":'), roles, F.lit(',"turns":'), _object(F.col("turns")), F.lit("}"))
    return held.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("id"), body.alias("body"))


def event_bodies(spark: SparkSession, sf_dir: str, k: Column | None = None) -> DataFrame:
    """id and props of each event, or an object with other values in their place."""
    other = F.to_json(F.struct(k.alias("k"), F.lit(1).alias("z"))) if k is not None else F.col("props")
    return table(spark, sf_dir, "events").select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"), other.alias("body"))


_SEEN = "WITH c AS (SELECT 'c' || conv_id AS id, conv_id, turn, role, coalesce(length(text), 0) AS size, conv_id % 5 = 0 AS fresh, turn % 2 = 0 AND conv_id % 5 <> 0 AS known FROM conversations)"


@register(
    "shape_diff",
    _SEEN
    + """, h AS (SELECT conv_id FROM c GROUP BY conv_id HAVING bool_or(known)), f AS (SELECT c.*, h.conv_id IS NULL AS whole FROM c LEFT JOIN h USING (conv_id))
    SELECT id, 'turns/t' || turn || '/role' AS path, '"' || role || '"' AS new_value FROM f WHERE NOT known OR (conv_id % 3 = 0 AND role <> 'other')
    UNION ALL SELECT id, 'turns/t' || turn || '/size', CAST(size AS VARCHAR) FROM f WHERE NOT known
    UNION ALL SELECT id, 'n', CAST(count(*) AS VARCHAR) FROM f GROUP BY id HAVING count(*) <> count(*) FILTER (known)
    UNION ALL SELECT id, 'roles', CAST(to_json(d) AS VARCHAR) FROM (SELECT id, CASE WHEN any_value(whole) THEN list(role ORDER BY turn)
      ELSE list_concat(list_filter(list(role ORDER BY turn), lambda x: NOT list_contains(list(CASE WHEN conv_id % 3 = 0 THEN 'other' ELSE role END) FILTER (known), x)),
        list_filter(list(CASE WHEN conv_id % 3 = 0 THEN 'other' ELSE role END ORDER BY turn) FILTER (known), lambda x: NOT list_contains(list(role), x))) END AS d FROM f GROUP BY id) WHERE len(d) > 0
    UNION ALL SELECT 'e' || event_id, 'k', json_extract_string(props, '$.k') FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50""",
)
def shape_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What conversations have now and did not when only their even turns were known, some with another role and some not at all; and properties of events that were counted only up to 50."""
    turns = table(spark, sf_dir, "conversations")
    before = packed(turns.where("turn % 2 = 0 AND conv_id % 5 <> 0"), F.when(F.col("conv_id") % 3 == 0, "other").otherwise(F.col("role")))
    k = F.get_json_object("props", "$.k").cast("int")
    old = before.unionByName(event_bodies(spark, sf_dir, k % 50))
    found = shapes.shape_diff(old, packed(turns, F.col("role")).unionByName(event_bodies(spark, sf_dir)), "id", "body")
    return found.select("id", F.array_join("path", "/").alias("path"), "new_value")


@register(
    "shape_merge",
    """WITH c AS (SELECT 'c' || conv_id AS id, count(*) AS turns, coalesce(nullif(count(*) FILTER (turn % 2 = 1), 0), count(*)) AS n, coalesce(string_agg(role, ',' ORDER BY turn) FILTER (turn % 2 = 0), '') AS a,
      coalesce(string_agg(role, ',' ORDER BY turn) FILTER (turn % 2 = 1), '') AS b, sum(coalesce(length(text), 0)) AS size FROM conversations GROUP BY conv_id)
    SELECT id, CAST(n AS VARCHAR) AS n, concat_ws(',', nullif(a, ''), nullif(b, '')) AS roles, CAST(turns AS INTEGER) AS turns, CAST(size AS BIGINT) AS size FROM c""",
)
def shape_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The odd turns of each conversation laid over the even ones: counts replaced, roles appended, turns entered; read from the rebuilt text."""
    turns = table(spark, sf_dir, "conversations")
    even, odd = (packed(turns.where(f"turn % 2 = {k}"), F.col("role")) for k in (0, 1))
    whole = shapes.rebuild(shapes.shape_merge(even, odd, "id", "body"), "value")
    held = F.from_json("value", "n long, roles array<string>, turns map<string,struct<role:string,size:long>>")
    read = whole.select("id", held.alias("h"))
    size = F.aggregate(F.map_values("h.turns"), F.lit(0).cast("long"), lambda a, t: a + t["size"])
    return read.select("id", F.col("h.n").cast("string").alias("n"), F.array_join("h.roles", ",").alias("roles"), F.size("h.turns").alias("turns"), size.alias("size"))
