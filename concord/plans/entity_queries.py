"""Queries over customers, suppliers, orders and conversations as users, identities, groups and roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions import codec, names, urls
from concord.functions.values import or_else, symmetric_difference
from concord.operators import apply, delta, groups, overlay, resolve
from concord.plans.entry import register
from concord.session import table

PROVIDER = "orders"
CUT = "1998-04-01"


# --- resolution


def cascade_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as users (with an ORCID that several may share), suppliers as linked identities, and one probe for each event.

    A probe's keys follow from its user and event ids: the identity is a supplier's, the ORCID and the member name are those of a customer, the e-mail of another."""
    c = F.col("c_custkey")
    users = table(spark, sf_dir, "customer").select(
        c.alias("user_id"),
        F.concat(F.lit("name"), (c % 400).cast("string")).alias("username"),
        F.concat(F.lit("mail"), (c % 700).cast("string")).alias("email"),
        F.to_json(F.struct(F.concat(F.lit("orcid"), (c % 90).cast("string")).alias("identifier_orcid"), F.concat(F.lit("member"), (c % 120).cast("string")).alias("identifier_kc_username"))).alias("user_profile"),
    )
    identities = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("method"), F.col("s_suppkey").cast("string").alias("id"), F.col("s_suppkey").alias("user_id"))
    e, u = F.col("event_id"), F.col("user_id")
    text = lambda prefix, n: F.concat(F.lit(prefix), n.cast("string"))
    probes = table(spark, sf_dir, "events").select(
        e.alias("probe_id"),
        F.when(e % 3 == 0, "supplier").alias("external_method"),
        u.cast("string").alias("external_id"),
        F.when(e % 5 == 0, text("orcid", e % 100)).alias("orcid"),
        F.when(e % 2 == 0, text("member", e % 150)).when(e % 7 == 0, text("name", e % 500)).alias("member_name"),
        F.when(e % 4 != 0, text("mail", e % 900)).otherwise("").alias("email"),
    )
    return users, identities, probes


CASCADE_SQL = """
WITH users AS (
  SELECT c_custkey AS user_id, 'name' || c_custkey % 400 AS username, 'mail' || c_custkey % 700 AS email, 'orcid' || c_custkey % 90 AS orcid, 'member' || c_custkey % 120 AS member FROM customer
), probes AS (
  SELECT event_id AS probe_id, CASE WHEN event_id % 3 = 0 THEN 'supplier' END AS method, CAST(user_id AS VARCHAR) AS external_id,
    CASE WHEN event_id % 5 = 0 THEN 'orcid' || event_id % 100 END AS orcid,
    CASE WHEN event_id % 2 = 0 THEN 'member' || event_id % 150 WHEN event_id % 7 = 0 THEN 'name' || event_id % 500 END AS name,
    CASE WHEN event_id % 4 <> 0 THEN 'mail' || event_id % 900 ELSE '' END AS email FROM events
), hits AS (
  SELECT DISTINCT * FROM (
    SELECT probe_id, 1 AS level, s_suppkey AS user_id FROM probes JOIN supplier ON method = 'supplier' AND external_id = CAST(s_suppkey AS VARCHAR)
    UNION ALL SELECT probe_id, 2, user_id FROM probes p JOIN users u ON p.orcid = u.orcid
    UNION ALL SELECT probe_id, 3, user_id FROM probes p JOIN users u ON p.name = u.member
    UNION ALL SELECT probe_id, 5, user_id FROM probes p JOIN users u ON p.name = u.username
    UNION ALL SELECT probe_id, 6, user_id FROM probes p JOIN users u ON method IS NOT NULL AND 'orders-' || p.name = u.username
    UNION ALL SELECT probe_id, 8, user_id FROM probes p JOIN users u ON p.email <> '' AND p.email = u.email)
), counted AS (
  SELECT probe_id, level, count(*) AS n, min(user_id) AS user_id FROM hits GROUP BY probe_id, level
), open AS (
  SELECT * FROM counted c WHERE n = 1 AND NOT (level BETWEEN 3 AND 7 AND EXISTS (SELECT 1 FROM counted m WHERE m.probe_id = c.probe_id AND m.level = 3 AND m.n > 1))
)
"""


@register("identity_cascade", CASCADE_SQL + "SELECT probe_id, user_id, level FROM (SELECT *, row_number() OVER (PARTITION BY probe_id ORDER BY level) AS r FROM open) WHERE r = 1")
def identity_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, identities, probes = cascade_inputs(spark, sf_dir)
    return resolve.resolve_identity(probes, resolve.user_keys(users, identities), PROVIDER, "fallthrough")


@register(
    "identity_cascade_logout",
    CASCADE_SQL + "SELECT probe_id, user_id, level FROM hits h WHERE level BETWEEN 3 AND 7 AND level = (SELECT min(level) FROM hits f WHERE f.probe_id = h.probe_id AND f.level BETWEEN 3 AND 7)",
)
def identity_cascade_logout(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, identities, probes = cascade_inputs(spark, sf_dir)
    return resolve.resolve_identity(probes, resolve.user_keys(users, identities), PROVIDER, "all")


# The inputs above have keys modulo fixed numbers, which several users share at any size but the smallest. Below, keys follow the whole
# c_custkey, a tenth of the users share one of each kind, and all levels occur at every size.
LEVELS_PROVIDER = "Orders"


def cascade_levels_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as users, of whom every twentieth has the key of another (in turn for each kind of key), suppliers and every fourth
    customer as linked identities, and one probe for each event that asks for its user's keys."""
    c = F.col("c_custkey")
    text = lambda prefix, n: F.concat(F.lit(prefix), n.cast("string"))
    key = lambda prefix, r: text(prefix, F.when(c % 20 == 10 + r, c - 10).otherwise(c))
    prefix = F.when(c % 3 == 0, "orders-").when(c % 3 == 1, "Orders-").otherwise("")
    users = table(spark, sf_dir, "customer").select(
        c.alias("user_id"),
        F.concat(prefix, text("name", c)).alias("username"),
        key("mail", 0).alias("email"),
        F.to_json(F.struct(key("orcid", 1).alias("identifier_orcid"), key("member", 2).alias("identifier_kc_username"))).alias("user_profile"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("method"), F.col("s_suppkey").cast("string").alias("id"), F.col("s_suppkey").alias("user_id"))
    legacy = table(spark, sf_dir, "customer").where(c % 4 == 3).select(F.lit(LEVELS_PROVIDER).alias("method"), text("name", c).alias("id"), c.alias("user_id"))
    e, u = F.col("event_id"), F.col("user_id")
    probes = table(spark, sf_dir, "events").select(
        e.alias("probe_id"),
        F.when(e % 2 == 0, "supplier").alias("external_method"),
        F.when(e % 8 == 0, u.cast("string")).otherwise(text("x", u)).alias("external_id"),
        F.when(e % 8 == 1, text("orcid", u)).alias("orcid"),
        F.when((e % 8).isin(2, 3), text("member", u)).when((e % 8).isin(4, 5, 6), text("name", u)).when(e % 8 == 7, text("none", u)).alias("member_name"),
        F.when(e % 4 != 2, text("mail", u)).otherwise("").alias("email"),
    )
    return users, suppliers.unionByName(legacy), probes


CASCADE_LEVELS_SQL = """
WITH users AS (
  SELECT c_custkey AS user_id, CASE c_custkey % 3 WHEN 0 THEN 'orders-' WHEN 1 THEN 'Orders-' ELSE '' END || 'name' || c_custkey AS username,
    'mail' || CASE WHEN c_custkey % 20 = 10 THEN c_custkey - 10 ELSE c_custkey END AS email, 'orcid' || CASE WHEN c_custkey % 20 = 11 THEN c_custkey - 10 ELSE c_custkey END AS orcid,
    'member' || CASE WHEN c_custkey % 20 = 12 THEN c_custkey - 10 ELSE c_custkey END AS member FROM customer
), probes AS (
  SELECT event_id AS probe_id, CASE WHEN event_id % 2 = 0 THEN 'supplier' END AS method, CASE WHEN event_id % 8 = 0 THEN CAST(user_id AS VARCHAR) ELSE 'x' || user_id END AS external_id,
    CASE WHEN event_id % 8 = 1 THEN 'orcid' || user_id END AS orcid,
    CASE WHEN event_id % 8 IN (2, 3) THEN 'member' || user_id WHEN event_id % 8 IN (4, 5, 6) THEN 'name' || user_id WHEN event_id % 8 = 7 THEN 'none' || user_id END AS name,
    CASE WHEN event_id % 4 <> 2 THEN 'mail' || user_id ELSE '' END AS email FROM events
), hits AS (
  SELECT DISTINCT * FROM (
    SELECT probe_id, 1 AS level, s_suppkey AS user_id FROM probes JOIN supplier ON method = 'supplier' AND external_id = CAST(s_suppkey AS VARCHAR)
    UNION ALL SELECT probe_id, 2, user_id FROM probes p JOIN users u ON p.orcid = u.orcid
    UNION ALL SELECT probe_id, 3, user_id FROM probes p JOIN users u ON p.name = u.member
    UNION ALL SELECT probe_id, 4, c_custkey FROM probes p JOIN customer ON method IS NOT NULL AND c_custkey % 4 = 3 AND p.name = 'name' || c_custkey
    UNION ALL SELECT probe_id, 5, user_id FROM probes p JOIN users u ON p.name = u.username
    UNION ALL SELECT probe_id, 6, user_id FROM probes p JOIN users u ON method IS NOT NULL AND 'Orders-' || p.name = u.username
    UNION ALL SELECT probe_id, 7, user_id FROM probes p JOIN users u ON method IS NOT NULL AND 'orders-' || p.name = u.username
    UNION ALL SELECT probe_id, 8, user_id FROM probes p JOIN users u ON p.email <> '' AND p.email = u.email)
), counted AS (
  SELECT probe_id, level, count(*) AS n, min(user_id) AS user_id FROM hits GROUP BY probe_id, level
), open AS (
  SELECT * FROM counted c WHERE n = 1 AND NOT (level BETWEEN 3 AND 7 AND EXISTS (SELECT 1 FROM counted m WHERE m.probe_id = c.probe_id AND m.level = 3 AND m.n > 1))
)
"""


@register("identity_cascade_levels", CASCADE_LEVELS_SQL + "SELECT probe_id, user_id, level FROM (SELECT *, row_number() OVER (PARTITION BY probe_id ORDER BY level) AS r FROM open) WHERE r = 1")
def identity_cascade_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, identities, probes = cascade_levels_inputs(spark, sf_dir)
    return resolve.resolve_identity(probes, resolve.user_keys(users, identities), LEVELS_PROVIDER, "fallthrough")


@register(
    "identity_cascade_notices",
    CASCADE_LEVELS_SQL + "SELECT probe_id, user_id, level FROM (SELECT *, row_number() OVER (PARTITION BY probe_id ORDER BY level) AS r FROM open WHERE level BETWEEN 3 AND 7) WHERE r = 1",
)
def identity_cascade_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, identities, probes = cascade_levels_inputs(spark, sf_dir)
    return resolve.resolve_identity(probes, resolve.user_keys(users, identities), LEVELS_PROVIDER, "none")


@register(
    "unique_or_nothing",
    "SELECT c.c_custkey, u.owner FROM customer c LEFT JOIN (SELECT c_acctbal, min(c_custkey) AS owner FROM customer GROUP BY c_acctbal HAVING count(*) = 1) u ON c.c_acctbal = u.c_acctbal",
)
def unique_or_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    owners = resolve.unique_or_nothing(customers.select("c_acctbal", F.col("c_custkey").alias("owner")), "c_acctbal", "owner")
    return customers.join(owners, "c_acctbal", "left").select("c_custkey", "owner")


@register(
    "first_identity",
    """SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) o
       ON o.o_custkey = c.c_custkey AND o.r = 1""",
)
def first_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate")
    return resolve.first_match(table(spark, sf_dir, "customer").select("c_custkey"), orders, ["c_custkey"], ["o_orderdate", "o_orderkey"]).select("c_custkey", "o_orderkey")


@register(
    "source_priority",
    """SELECT e.user_id, CASE WHEN s.s_suppkey IS NOT NULL THEN 'supplier' WHEN c.c_custkey IS NOT NULL THEN 'customer' END AS matched_source, coalesce(s.s_name, c.c_name) AS value
       FROM (SELECT DISTINCT user_id FROM events) e LEFT JOIN supplier s ON s.s_suppkey = e.user_id LEFT JOIN customer c ON c.c_custkey = e.user_id""",
)
def source_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [(name, table(spark, sf_dir, name).select(F.col(key).alias("user_id"), F.col(value).alias("value"))) for name, key, value in (("supplier", "s_suppkey", "s_name"), ("customer", "c_custkey", "c_name"))]
    return resolve.by_source_priority(table(spark, sf_dir, "events").select("user_id").distinct(), sources, "user_id")


# --- deltas


def memberships(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Roles of customers from their orders before (local) and from (remote) a date; even customers also hold roles of another provider."""
    orders = table(spark, sf_dir, "orders")
    role = names.role_name(PROVIDER, F.col("o_orderstatus"), F.col("o_orderpriority"))
    of = lambda rows: rows.select(F.col("o_custkey").alias("user_id"), role.alias("role")).distinct()
    other = orders.where(f"o_orderdate < '{CUT}' AND o_custkey % 2 = 0").select(F.col("o_custkey").alias("user_id"), F.concat(F.lit("other---"), "o_orderpriority").alias("role")).distinct()
    return of(orders.where(f"o_orderdate < '{CUT}'")).union(other), of(orders.where(f"o_orderdate >= '{CUT}'"))


MEMBERSHIP_SQL = f"""
WITH remote AS (SELECT DISTINCT o_custkey AS user_id, 'orders---' || o_orderstatus || '|' || o_orderpriority AS role FROM orders WHERE o_orderdate >= '{CUT}'),
managed AS (SELECT DISTINCT o_custkey AS user_id, 'orders---' || o_orderstatus || '|' || o_orderpriority AS role FROM orders WHERE o_orderdate < '{CUT}'),
other AS (SELECT DISTINCT o_custkey AS user_id, 'other---' || o_orderpriority AS role FROM orders WHERE o_orderdate < '{CUT}' AND o_custkey % 2 = 0),
dropped AS (SELECT * FROM managed EXCEPT SELECT * FROM remote), added AS (SELECT * FROM remote EXCEPT SELECT * FROM managed),
unchanged AS (SELECT * FROM managed INTERSECT SELECT * FROM remote UNION SELECT * FROM other)
"""


@register("membership_delta", MEMBERSHIP_SQL + "SELECT *, 'dropped' AS change FROM dropped UNION ALL SELECT *, 'added' FROM added UNION ALL SELECT *, 'unchanged' FROM unchanged")
def membership_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.membership_delta(*memberships(spark, sf_dir), PROVIDER)


@register("membership_apply", MEMBERSHIP_SQL + "SELECT * FROM remote UNION SELECT * FROM other")
def membership_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    local, remote = memberships(spark, sf_dir)
    return delta.apply_membership(local, delta.membership_delta(local, remote, PROVIDER))


@register(
    "list_symdiff",
    f"""WITH u AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate >= '{CUT}'), o AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderdate < '{CUT}')
    SELECT *, 'update' AS side FROM u WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.o_custkey = u.o_custkey AND o.o_orderpriority = u.o_orderpriority)
    UNION ALL SELECT *, 'original' FROM o WHERE NOT EXISTS (SELECT 1 FROM u WHERE o.o_custkey = u.o_custkey AND o.o_orderpriority = u.o_orderpriority)""",
)
def list_symdiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderdate")
    old, new = (orders.where(f"o_orderdate {op} '{CUT}'").drop("o_orderdate") for op in ("<", ">="))
    return delta.list_difference(old, new, ["o_custkey", "o_orderpriority"])


@register(
    "array_symdiff",
    """WITH a AS (SELECT ps.conv_id, list(ps.role ORDER BY ps.turn) FILTER (ps.turn % 2 = 0) AS u, list(ps.role ORDER BY ps.turn) FILTER (ps.turn % 2 = 1) AS o FROM conversations ps GROUP BY 1)
    SELECT conv_id, array_to_string(list_concat(list_filter(coalesce(u, []), lambda x: NOT list_contains(coalesce(o, []), x)), list_filter(coalesce(o, []), lambda x: NOT list_contains(coalesce(u, []), x))), ',') AS diff FROM a""",
)
def array_symdiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of even turns against those of odd turns."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    lists = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    roles = lambda odd: F.transform(F.filter("t", lambda x: x["turn"] % 2 == odd), lambda x: x["role"])
    return lists.select("conv_id", F.array_join(symmetric_difference(roles(0), roles(1)), ",").alias("diff"))


@register(
    "sparse_diff",
    """WITH n AS (
      SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN c_name || ' II' ELSE c_name END AS c_name, CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE c_nationkey END AS c_nationkey,
        CASE WHEN c_custkey % 6 = 0 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment FROM customer
    )
    SELECT n.c_custkey AS id, 'c_name' AS path, n.c_name AS new_value FROM n JOIN customer o USING (c_custkey) WHERE n.c_name IS DISTINCT FROM o.c_name AND n.c_name <> ''
    UNION ALL SELECT n.c_custkey, 'place.c_nationkey', CAST(n.c_nationkey AS VARCHAR) FROM n JOIN customer o USING (c_custkey) WHERE n.c_nationkey IS DISTINCT FROM o.c_nationkey AND n.c_nationkey <> 0
    UNION ALL SELECT n.c_custkey, 'place.c_mktsegment', n.c_mktsegment FROM n JOIN customer o USING (c_custkey) WHERE n.c_mktsegment IS DISTINCT FROM o.c_mktsegment AND n.c_mktsegment <> ''""",
)
def sparse_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    new = c.select(
        k,
        F.when(k % 10 == 0, "").when(k % 3 == 0, F.concat("c_name", F.lit(" II"))).otherwise(F.col("c_name")).alias("c_name"),
        F.struct(F.when(k % 4 == 0, 0).otherwise(F.col("c_nationkey")).alias("c_nationkey"), F.when(k % 6 == 0, "NEW").otherwise(F.col("c_mktsegment")).alias("c_mktsegment")).alias("place"),
    )
    old = c.select(k, "c_name", F.struct("c_nationkey", "c_mktsegment").alias("place"))
    return delta.sparse_diff(old, new, "c_custkey")


@register(
    "recursive_merge",
    """SELECT coalesce(c.c_custkey, s.s_suppkey) AS id, CASE WHEN s.s_suppkey IS NULL THEN c.c_name ELSE s.s_name END AS name,
      CASE WHEN s.s_suppkey IS NULL THEN c.c_nationkey ELSE s.s_nationkey END AS nation, concat_ws(',', c.c_mktsegment, CASE WHEN s.s_suppkey IS NOT NULL THEN 'SUPPLIER' END) AS tags
    FROM customer c FULL OUTER JOIN supplier s ON c.c_custkey = s.s_suppkey""",
)
def recursive_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier records laid over the customer records of equal number: nested place, tags appended."""
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.struct(F.col("c_nationkey").alias("nation")).alias("place"), F.array("c_mktsegment").alias("tags"))
    extra = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.struct(F.col("s_nationkey").alias("nation")).alias("place"), F.array(F.lit("SUPPLIER")).alias("tags"))
    merged = delta.recursive_merge(base, extra, "id")
    return merged.select("id", "name", F.col("place.nation").alias("nation"), F.array_join("tags", ",").alias("tags"))


# --- roles and groups


@register("role_build", "SELECT conv_id, turn, 'chat---' || conv_id || '|' || role AS role_name FROM conversations")
def role_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", names.role_name("chat", F.col("conv_id"), F.col("role")).alias("role_name"))


@register("role_parse", "SELECT conv_id, turn, 'chat' AS provider, CAST(conv_id AS VARCHAR) AS group_id, role FROM conversations")
def role_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = role_build(spark, sf_dir)
    return built.select("conv_id", "turn", *[c.alias(n) for c, n in zip(names.role_parts(F.col("role_name")), ("provider", "group_id", "role"), strict=True)])


ROLE_SAMPLE = "CASE conv_id % 3 WHEN 0 THEN 'chat' WHEN 1 THEN 'chat---' || conv_id || '|' || role ELSE 'other---' || conv_id || '|' || role END"


def role_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv, role = F.col("conv_id"), F.col("role")
    name = F.when(conv % 3 == 0, "chat").when(conv % 3 == 1, names.role_name("chat", conv, role)).otherwise(names.role_name("other", conv, role))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", name.alias("role_name"))


@register("role_prefix", f"SELECT conv_id, turn, {ROLE_SAMPLE} AS role_name FROM conversations WHERE string_split({ROLE_SAMPLE}, '---')[1] = 'chat'")
def role_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_sample(spark, sf_dir).where(names.is_managed(F.col("role_name"), "chat"))


@register("role_contains", f"SELECT conv_id, turn, contains({ROLE_SAMPLE}, 'chat---' || conv_id || '|') AS is_of_group FROM conversations")
def role_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_sample(spark, sf_dir).select("conv_id", "turn", names.of_group(F.col("role_name"), "chat", F.col("conv_id")).alias("is_of_group"))


@register("group_members", "SELECT DISTINCT c.conv_id AS user_id, role FROM conversations c WHERE role = 'assistant'")
def group_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("user_id"), "role").distinct()
    return resolve.members_of(turns, turns.select("user_id").distinct(), "assistant").select("user_id", "role")


@register("user_role_count", "SELECT c_custkey AS user_id, count(DISTINCT o_orderpriority) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def user_role_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    roles = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("role")).distinct()
    return resolve.roles_of(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id")), roles).groupBy("user_id").agg(F.count("role").alias("n"))


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as collection documents of the instance of their priority; finished ones are deleted."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("instance"), F.col("o_custkey").cast("string").alias("group_id"), (F.col("o_orderstatus") == "F").alias("is_deleted")
    )


@register(
    "active_deleted_split",
    """SELECT CAST(o_custkey AS VARCHAR) AS group_id, count(*) FILTER (o_orderstatus <> 'F') AS n_active, count(*) FILTER (o_orderstatus = 'F') AS n_deleted,
      CASE count(*) FILTER (o_orderstatus <> 'F') WHEN 0 THEN 'deleted' WHEN 1 THEN 'update' ELSE 'error' END AS action FROM orders GROUP BY o_custkey""",
)
def active_deleted_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.split_active(order_documents(spark, sf_dir))


@register(
    "document_search",
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS group_id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F' AND o_custkey IN (SELECT s_suppkey FROM supplier)",
)
def document_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("group_id"))
    return groups.find_documents(order_documents(spark, sf_dir), "1-URGENT", wanted).select("id", "group_id")


@register(
    "deletion_summary",
    """WITH g AS (SELECT CAST(s_suppkey AS VARCHAR) AS group_id FROM supplier)
    SELECT g.group_id,
      coalesce((SELECT string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)) FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F' AND CAST(o_custkey AS VARCHAR) = g.group_id), '') AS disowned_communities,
      coalesce((SELECT string_agg(r, ',' ORDER BY r) FROM (SELECT DISTINCT 'chat---' || conv_id || '|' || role AS r FROM conversations WHERE CAST(conv_id AS VARCHAR) = g.group_id)), '') AS deleted_roles FROM g""",
)
def deletion_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("group_id"))
    roles = role_build(spark, sf_dir).select(F.col("role_name").alias("id")).distinct()
    return groups.deletion_summary(order_documents(spark, sf_dir), roles, wanted, "1-URGENT", "chat")


# --- overlays and writes


@register(
    "profile_overlay",
    """SELECT c_custkey AS user_id, s_name AS username, CASE WHEN s_suppkey % 3 = 0 THEN c_mktsegment ELSE 'affiliation ' || s_nationkey END AS affiliations,
      s_name AS full_name, s_name AS identifier_kc_username, 'public' AS visibility, c_name AS kept FROM customer JOIN supplier ON s_suppkey = c_custkey""",
)
def profile_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as remote profiles of the customers of equal number; every third has no affiliation."""
    text = lambda *pairs: F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)])
    local = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"), F.lit("x").alias("email"), F.lit(True).alias("active"), text(("visibility", F.lit("restricted"))).alias("preferences"), text(("affiliations", F.col("c_mktsegment")), ("kept", F.col("c_name"))).alias("user_profile")
    )
    none = F.lit(None).cast("string")
    s = F.col("s_suppkey")
    remote = table(spark, sf_dir, "supplier").select(
        s.alias("user_id"), F.col("s_name").alias("username"), F.lit("y").alias("email"), F.col("s_name").alias("name"), none.alias("first_name"), none.alias("last_name"), F.when(s % 3 == 0, "").otherwise(F.concat(F.lit("affiliation "), "s_nationkey")).alias("institutional_affiliation"), none.alias("orcid")
    )
    new = overlay.profile_overlay(local, remote)
    of = lambda m, k: F.try_element_at(m, F.lit(k)).alias(k)
    return new.select("user_id", "username", of("user_profile", "affiliations"), of("user_profile", "full_name"), of("user_profile", "identifier_kc_username"), of("preferences", "visibility"), of("user_profile", "kept"))


@register("or_else", "SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_name END, ''), c_mktsegment) AS value FROM customer")
def or_else_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", or_else(F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_name")), F.col("c_mktsegment")).alias("value"))


@register(
    "collision_guard",
    """WITH p AS (SELECT c_custkey AS user_id, c_name AS old, CASE WHEN c_custkey % 3 = 0 THEN 'Customer#' || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0') ELSE 'segment ' || CAST(c_custkey // 2 AS VARCHAR) END AS new FROM customer),
    r AS (SELECT *, row_number() OVER (PARTITION BY new ORDER BY user_id) AS k, EXISTS (SELECT 1 FROM customer c WHERE c.c_name = p.new) AS taken FROM p)
    SELECT user_id, CASE WHEN taken OR k > 1 THEN old ELSE new END AS username, taken OR k > 1 AS username_collides FROM r""",
)
def collision_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    users = table(spark, sf_dir, "customer").select(c.alias("user_id"), F.col("c_name").alias("username"))
    new = F.when(c % 3 == 0, F.concat(F.lit("Customer#"), F.lpad((c + 1).cast("string"), 9, "0"))).otherwise(F.concat(F.lit("segment "), F.floor(c / 2).cast("string")))
    return overlay.collision_guard(users, table(spark, sf_dir, "customer").select(c.alias("user_id"), new.alias("new_username")), "username").select("user_id", "username", "username_collides")


@register(
    "doc_overlay",
    """SELECT CAST(page_id AS VARCHAR) AS id, 'title ' || page_id AS title, CASE WHEN page_id % 2 = 0 THEN url ELSE 'old' END AS website,
      CASE WHEN page_id % 3 = 0 THEN 'public' WHEN page_id % 3 = 1 THEN 'restricted' ELSE 'unset' END AS visibility, CASE WHEN page_id % 3 = 0 THEN 'public' WHEN page_id % 3 = 1 THEN 'hidden' ELSE 'unset' END AS group_visibility FROM pages""",
)
def doc_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as group metadata: some lack the url, some the visibility."""
    p = F.col("page_id")
    text = p.cast("string")
    raw = F.to_json(F.struct(text.alias("id"), F.when(p % 2 == 0, F.col("url")).alias("url"), F.when(p % 3 == 0, "public").when(p % 3 == 1, "hidden").alias("visibility")))
    pages = table(spark, sf_dir, "pages")
    unset = F.lit("unset")
    docs = pages.select(
        text.alias("id"), text.alias("group_id"), F.concat(F.lit("title "), text).alias("title"), unset.alias("description"), F.lit("old").alias("website"), unset.alias("visibility"), unset.alias("group_name"), unset.alias("group_description"), unset.alias("group_visibility")
    )
    return overlay.document_overlay(docs, pages.select(text.alias("group_id"), raw.alias("raw"))).select("id", "title", "website", "visibility", "group_visibility")


@register(
    "upsert_users",
    "SELECT c_custkey AS user_id, c_name AS username FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey + 50 FROM supplier) UNION ALL SELECT s_suppkey + 50, s_name FROM supplier",
)
def upsert_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"))
    return apply.upsert(users, table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 50).alias("user_id"), F.col("s_name").alias("username")), ["user_id"])


@register(
    "guarded_links",
    """WITH q AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, event_id % 7 AS user_id FROM events), i AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_suppkey % 7 AS owner FROM supplier),
    w AS (SELECT id, min(user_id) AS winner FROM q GROUP BY id)
    SELECT q.id, q.user_id, CASE WHEN coalesce(owner, winner) <> q.user_id THEN 'error' WHEN owner IS NOT NULL THEN 'exists' ELSE 'linked' END AS status FROM q JOIN w USING (id) LEFT JOIN i USING (id)""",
)
def guarded_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = table(spark, sf_dir, "events").select(F.lit("m").alias("method"), F.col("user_id").cast("string").alias("id"), (F.col("event_id") % 7).alias("user_id")).distinct()
    identities = table(spark, sf_dir, "supplier").select(F.lit("m").alias("method"), F.col("s_suppkey").cast("string").alias("id"), (F.col("s_suppkey") % 7).alias("user_id"))
    return apply.guarded_links(requests, identities).select("id", "user_id", "status")


# --- scalars


@register(
    "range_expand",
    "SELECT DISTINCT CAST(n AS VARCHAR) AS id FROM (SELECT unnest(range(p_partkey, p_partkey + p_size + 1)) AS n FROM part WHERE p_size % 2 = 0) UNION SELECT p_brand FROM part WHERE p_size % 2 = 1",
)
def range_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    from concord.plans.pipelines import batch_update_ids

    item = F.when(F.col("p_size") % 2 == 0, F.concat_ws("-", F.col("p_partkey").cast("string"), (F.col("p_partkey") + F.col("p_size")).cast("string"))).otherwise(F.col("p_brand"))
    return batch_update_ids(table(spark, sf_dir, "part").select(item.alias("item")))


@register("prefix_strip", "SELECT c_custkey, regexp_replace(c_name, 'cUSTOMER', '', 'gi') AS bare FROM customer")
def prefix_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", names.strip_provider(F.col("c_name"), "cUSTOMER").alias("bare"))


@register("key_hash", "SELECT c_custkey, sha256(c_name) AS key FROM customer")
def key_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.lower(F.hex(codec.key_of(F.col("c_name")))).alias("key"))


@register("codec_roundtrip", "SELECT doc_id, text FROM documents")
def codec_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sealed = table(spark, sf_dir, "documents").select("doc_id", codec.seal(F.col("text"), F.lit("a shared secret")).alias("token"))
    return sealed.select("doc_id", codec.unseal(F.col("token"), F.lit("a shared secret")).alias("text"))


HOST = "https?://([^/?#]*)"


@register(
    "safe_redirect",
    f"""SELECT page_id, CASE WHEN regexp_extract(url, '{HOST}', 1) LIKE '%.example.org' AND regexp_extract(url, '{HOST}', 1) = 'thther.example.org' THEN url
      WHEN regexp_extract(url, '{HOST}([^?#]*)', 2) <> '' THEN regexp_extract(url, '{HOST}(.*)$', 2) ELSE '/' END AS target FROM pages""",
)
def safe_redirect(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = urls.safe_redirect(F.col("url"), F.lit(None).cast("string"), ("thther.example.org",))
    return table(spark, sf_dir, "pages").select("page_id", target.alias("target"))


@register(
    "path_exclusion",
    f"""WITH p AS (SELECT page_id, regexp_extract(url, '{HOST}([^?#]*)', 2) AS path FROM pages)
    SELECT page_id, starts_with(path, '/en/') OR starts_with(path, '/de/') OR rtrim(path, '/') = '/fr' OR ends_with(path, '0') AS excluded FROM p""",
)
def path_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = urls.url_part(F.col("url"), "PATH")
    return table(spark, sf_dir, "pages").select("page_id", urls.is_excluded(path, F.lit(None).cast("string"), ("/en/", "/de/"), "/fr", "0").alias("excluded"))


@register("lock_key", "SELECT c_custkey, c_mktsegment || ':' || c_custkey || ':group-data-updating' AS key FROM customer")
def lock_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", names.lock_key(F.col("c_mktsegment"), F.col("c_custkey").cast("string"), F.lit("group-data-updating")).alias("key"))


@register("bearer_token", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS token FROM customer")
def bearer_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("Bearer  "), "c_name", F.lit(" "))).when(F.col("c_custkey") % 3 == 1, "Bearer ").otherwise(F.concat(F.lit("Basic "), "c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", names.bearer(header).alias("token"))
