"""Queries over keyed state: unique values that change hands, repeated rows of one key, written tables, busy users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions import names, urls
from concord.operators import apply, groups, overlay, report, resolve, throttle
from concord.plans import flow_queries, pipelines
from concord.plans.entry import register
from concord.plans.flow_queries import CONFIG
from concord.session import cut_lineage, shared_path, table
from concord.sources.tables import KeyedTable

BUSY_SECONDS = 3600

@register(
    "collision_chains",
    """WITH RECURSIVE c AS (SELECT c_custkey AS id, c_custkey // 100 AS k, c_custkey % 100 AS j, c_name AS old FROM customer),
    a AS (SELECT id, old, CASE WHEN j = 0 AND k % 3 = 2 THEN id + 99 WHEN j > 0 AND j < 1 + (37 * k) % 50 THEN id - 1 WHEN j IN (60, 61) THEN id + 1 WHEN j = 62 THEN id - 2
      WHEN j = 63 THEN id + 2 WHEN j IN (64, 65) THEN id - 1 WHEN j BETWEEN 80 AND 89 THEN k * 100 END AS other, CASE WHEN j = 0 AND k % 3 <> 2 THEN 'free' || k WHEN j BETWEEN 70 AND 79 THEN 'many' || k END AS free FROM c),
    p AS (SELECT id, old, coalesce(free, 'Customer#' || lpad(CAST(other AS VARCHAR), 9, '0')) AS new FROM a),
    w AS (SELECT p.new, min(p.id) AS id, min(o.id) AS holder FROM p LEFT JOIN c o ON o.old = p.new WHERE p.new IS NOT NULL AND (o.id IS NULL OR o.id < p.id) GROUP BY p.new),
    g(id) AS (SELECT id FROM w WHERE holder IS NULL UNION ALL SELECT w.id FROM w JOIN g ON w.holder = g.id)
    SELECT p.id AS user_id, CASE WHEN g.id IS NULL THEN old ELSE new END AS username, new IS NOT NULL AND g.id IS NULL AS username_collides FROM p LEFT JOIN g ON g.id = p.id""",
)
def collision_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In each hundred customers: a chain of 1 to 50 that each ask for the name of the one before, whose first asks for a free name or one that stays held; circles in both directions;
    a free name that ten ask for, and the name of the chain's first, which ten more would like."""
    c = F.col("c_custkey")
    k, j = F.floor(c / 100), c % 100
    name = lambda n: F.concat(F.lit("Customer#"), F.lpad(n.cast("string"), 9, "0"))
    other = (
        F.when((j == 0) & (k % 3 == 2), c + 99)
        .when((j > 0) & (j < 1 + (37 * k) % 50), c - 1)
        .when(j.isin(60, 61), c + 1)
        .when(j == 62, c - 2)
        .when(j == 63, c + 2)
        .when(j.isin(64, 65), c - 1)
        .when(j.between(80, 89), k * 100)
    )
    free = F.when((j == 0) & (k % 3 != 2), F.concat(F.lit("free"), k.cast("string"))).when(j.between(70, 79), F.concat(F.lit("many"), k.cast("string")))
    customers = table(spark, sf_dir, "customer")
    asked = customers.select(c.alias("user_id"), F.coalesce(free, name(other)).alias("new_username"))
    guarded = overlay.collision_guard(customers.select(c.alias("user_id"), F.col("c_name").alias("username")), asked, "username")
    return guarded.select("user_id", "username", "username_collides")


@register(
    "user_sync_repeated",
    """WITH q AS (SELECT DISTINCT user_id FROM events), r AS (SELECT s_suppkey AS k, s_name AS remote FROM supplier JOIN q ON user_id = s_suppkey WHERE s_suppkey % 9 <> 0 OR s_suppkey % 2 = 1)
    SELECT c_custkey AS user_id, CASE WHEN k % 2 = 0 THEN remote WHEN k IS NOT NULL AND c_custkey + 1 >= (SELECT count(*) FROM customer) THEN 'Customer#' || lpad(CAST(k + 1 AS VARCHAR), 9, '0') ELSE c_name END AS username,
      CASE WHEN c_custkey < 0 OR c_custkey NOT IN (SELECT user_id FROM q) THEN NULL WHEN s_suppkey IS NULL THEN 'not_found_remote' WHEN k IS NULL THEN 'timeout' ELSE 'success' END AS bucket
    FROM customer LEFT JOIN r ON k = c_custkey LEFT JOIN supplier ON s_suppkey = c_custkey""",
)
def user_sync_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every profile comes several times: with another name, once more as it is, and as a timeout. Some that timed out came later after all. A user stays one row."""
    users, roles, requests, profiles = flow_queries.sync_inputs(spark, sf_dir)
    late = profiles.withColumn("status", F.lit("timeout"))
    odd = F.col("user_id") % 2 == 1
    renamed = profiles.withColumn("profile", F.col("profile").withField("username", F.concat("profile.username", F.lit("~")))).where("status = 'ok'")
    retried = profiles.where(odd).withColumn("status", F.lit("ok"))
    out = pipelines.sync_users(users, roles, requests.union(requests), profiles.union(late).union(renamed).union(retried), CONFIG)
    return out.users.select("user_id", "username").join(out.outcomes, "user_id", "left")


@register(
    "upsert_repeated",
    """WITH e AS (SELECT user_id, max(event_id) AS n FROM events GROUP BY user_id)
    SELECT coalesce(s_suppkey, user_id) AS user_id, CASE WHEN n IS NULL THEN s_name ELSE 'seen ' || n END AS username FROM supplier FULL OUTER JOIN e ON user_id = s_suppkey""",
)
def upsert_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event changes its user; the last change of each counts."""
    users = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("username"))
    changes = table(spark, sf_dir, "events").select("user_id", F.concat(F.lit("seen "), F.col("event_id").cast("string")).alias("username"), "event_id")
    return apply.upsert(users, changes, ["user_id"], order="event_id")


BUSY_SQL = f"""
WITH RECURSIVE t AS (SELECT DISTINCT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, ts FROM events WHERE ts IS NOT NULL), e(user_id, ts) AS (
  SELECT user_id, min(ts) FROM t GROUP BY user_id
  UNION ALL
  SELECT e.user_id, (SELECT min(t.ts) FROM t WHERE t.user_id = e.user_id AND t.ts > e.ts + INTERVAL {BUSY_SECONDS} SECOND) AS ts FROM e
  WHERE EXISTS (SELECT 1 FROM t WHERE t.user_id = e.user_id AND t.ts > e.ts + INTERVAL {BUSY_SECONDS} SECOND)
)
SELECT user_id, epoch_us(ts) AS us FROM e"""


@register("login_throttle_busy", BUSY_SQL)
def login_throttle_busy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user has a third of all events, which is over what one task takes here."""
    events = table(spark, sf_dir, "events").withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")))
    emitted = throttle.throttle(events, "user_id", "ts", BUSY_SECONDS, busy_rows=200)
    return emitted.select("user_id", F.unix_micros("ts").alias("us"))


PARTS = 256
PART_SQL = f"CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8)) AS BIGINT) % {PARTS}"


@register(
    "written_upsert",
    f"""WITH e AS (SELECT c_custkey, arg_max(event_type, event_id) AS seen FROM customer JOIN events ON user_id = c_custkey WHERE c_custkey % 100 = 7 GROUP BY c_custkey)
    SELECT c.c_custkey AS user_id, CASE WHEN seen IS NULL THEN c_name ELSE 'last ' || seen END AS username, {PART_SQL} IN (SELECT {PART_SQL} FROM e) AS rewritten FROM customer c LEFT JOIN e ON e.c_custkey = c.c_custkey"""
    .replace(f"{PART_SQL} IN", PART_SQL.replace("c_custkey", "c.c_custkey") + " IN"),
)
def written_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are written as a table, the events of one in a hundred change them, several times each, and the table is read again. A row is rewritten if its file is another one."""
    c = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").select(c.alias("user_id"), F.col("c_name").alias("username"))
    events = table(spark, sf_dir, "events").where("user_id % 100 = 7").join(customers.select("user_id"), "user_id", "left_semi")
    users = KeyedTable(spark, shared_path(spark, "keyed-users"), ["user_id"], PARTS)
    users.create(customers)
    before = cut_lineage(users.files())
    users.upsert(events.select("user_id", F.concat(F.lit("last "), "event_type").alias("username"), "event_id"), order="event_id")
    after = users.files().join(before, ["part", "file"], "left_anti").select("part", F.lit(True).alias("rewritten")).distinct()
    stored = spark.read.parquet(users.path)
    return stored.join(after, stored[KeyedTable.PART] == after["part"], "left").select("user_id", "username", F.coalesce("rewritten", F.lit(False)).alias("rewritten"))


@register(
    "range_lookup",
    """WITH s AS (SELECT s_suppkey, max(s_suppkey) OVER () AS top FROM supplier), r AS (SELECT s_suppkey * 20 + 1 AS low, CASE WHEN s_suppkey = top THEN 3000000000 ELSE s_suppkey * 20 + s_suppkey % 9 END AS high FROM s WHERE s_suppkey % 3 <> 0 OR s_suppkey = top)
    SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM r WHERE p_partkey BETWEEN low AND high) OR p_partkey IN (SELECT s_suppkey * 20 + 10 FROM s WHERE s_suppkey % 3 = 0 AND s_suppkey <> top)""",
)
def range_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that command-line items ask for: single numbers, narrow, empty and overlapping ranges, and one up to three billion."""
    s, top = F.col("s_suppkey"), table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).scalar()
    text = lambda n: n.cast("string")
    narrow = F.concat(text(s * 20 + 1), F.lit("-"), text(s * 20 + s % 9))
    item = F.when(s == top, F.concat(text(s * 20 + 1), F.lit("-3000000000"))).when(s % 3 != 0, narrow).otherwise(text(s * 20 + 10))
    ids = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"))
    return pipelines.ids_in_items(ids, table(spark, sf_dir, "supplier").select(item.alias("item"))).select(F.col("id").cast("long").alias("p_partkey"))


@register(
    "roles_of_groups_inside",
    """WITH r AS (SELECT DISTINCT CASE WHEN conv_id % 2 = 0 THEN 'chat---' || conv_id || '|' || role ELSE 'old chat---' || conv_id || '|see chat---' || (conv_id + 2) || '|' || role END AS id FROM conversations)
    SELECT CAST(s_suppkey AS VARCHAR) AS group_id, id FROM supplier JOIN r ON contains(id, 'chat---' || s_suppkey || '|')""",
)
def roles_of_groups_inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Role names that name one group at their beginning, or two further on."""
    conv, role = F.col("conv_id").cast("string"), F.col("role")
    two = F.concat(F.lit("old chat---"), conv, F.lit("|see chat---"), (F.col("conv_id") + 2).cast("string"), F.lit("|"), role)
    named = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("chat---"), conv, F.lit("|"), role)).otherwise(two)
    wanted = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("group_id"))
    return groups.roles_of_groups(table(spark, sf_dir, "conversations").select(named.alias("id")).distinct(), wanted, "chat")


@register(
    "roles_asked_for",
    """WITH q AS (SELECT DISTINCT user_id FROM events), r AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_custkey % 4 <> 1)
    SELECT user_id, CASE WHEN s_suppkey IS NOT NULL THEN o_orderpriority END AS role, CASE WHEN s_suppkey IS NULL THEN 'user not found' END AS error
    FROM q LEFT JOIN supplier ON s_suppkey = user_id LEFT JOIN r ON o_custkey = user_id AND s_suppkey IS NOT NULL""",
)
def roles_asked_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of events ask for their roles; only suppliers are known, and some have none."""
    users = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"))
    held = table(spark, sf_dir, "orders").where("o_custkey % 4 <> 1").select(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("role"))
    return resolve.roles_asked_for(table(spark, sf_dir, "events").select("user_id"), users, held)


@register(
    "outcome_lists",
    """SELECT CASE WHEN s_suppkey IS NULL THEN 'not_found_local' WHEN event_type = 'error' THEN 'failure' WHEN event_type = 'signup' THEN 'not_found_remote' WHEN event_type = 'view' THEN 'timeout' ELSE 'unchanged' END AS bucket,
      CAST(event_id AS VARCHAR) AS id FROM events LEFT JOIN supplier ON s_suppkey = user_id""",
)
def outcome_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which events ended in which bucket."""
    known = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"), F.lit(True).alias("known"))
    e = F.col("event_type")
    status = F.when(e == "error", "request_error").when(e == "signup", "not_found").when(e == "view", "timeout").otherwise("ok")
    met = table(spark, sf_dir, "events").join(known, "user_id", "left")
    return report.outcome_lists(met.select("event_id", report.bucket(F.col("known").isNotNull(), status, F.lit(0)).alias("bucket")), "event_id")


@register(
    "redirect_attacks",
    """SELECT page_id, CASE page_id % 9 WHEN 0 THEN '/evil.com/p?a=1' WHEN 1 THEN '/evil.com/p' WHEN 2 THEN 'HTTPS://OK.example.org/' || page_id WHEN 3 THEN '/home' WHEN 4 THEN '/p#f' WHEN 5 THEN 'https://ok.example.org/x'
      WHEN 6 THEN '/' WHEN 7 THEN '/home' ELSE '/evil.com' END AS target FROM pages""",
)
def redirect_attacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets that browsers would take to another host if their local part went out as it is; others fall back to the referrer or to the start page."""
    p = F.col("page_id")
    case = p % 9
    target = (
        F.when(case == 0, "https://evil.org//evil.com/p?a=1")
        .when(case == 1, "https://evil.org///evil.com/p")
        .when(case == 2, F.concat(F.lit("HTTPS://OK.example.org/"), p.cast("string")))
        .when(case == 3, "javascript://ok.example.org/%0aalert(1)")
        .when(case == 4, "//evil.com/p#f")
        .when(case == 5, "https://ok.exa\tmple.org/x")
        .when(case == 6, "https://evil.org\\@ok.example.org/")
        .when(case == 7, "https://evil.org")
        .otherwise("/\t/evil.com")
    )
    target = F.when(case == 8, "https://evil.org/\t/evil.com").otherwise(target)
    referrer = F.when(case.isin(3, 7), "https://evil.org/home")
    return table(spark, sf_dir, "pages").select("page_id", urls.safe_redirect(target, referrer, ("ok.example.org",)).alias("target"))


@register(
    "redirect_fragment",
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'https://x.org/cb?next=' || c_custkey || '#part' WHEN 1 THEN 'https://x.org/cb?a=1&next=' || c_custkey || '#?b=2' WHEN 2 THEN 'https://x.org/?next=' || c_custkey || '#' ELSE 'https://x.org/cb#part' END AS target FROM customer""",
)
def redirect_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query goes before the fragment, behind the query that is there."""
    c = F.col("c_custkey")
    base = F.when(c % 4 == 0, "https://x.org/cb#part").when(c % 4 == 1, "https://x.org/cb?a=1#?b=2").when(c % 4 == 2, "https://x.org/?#").otherwise("https://x.org/cb#part")
    return table(spark, sf_dir, "customer").select("c_custkey", urls.with_query(base, next=F.when(c % 4 != 3, c.cast("string"))).alias("target"))


@register("prefix_strip_literal", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE replace(c_name, 'Customer#', 'Custome') END AS bare FROM customer")
def prefix_strip_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider whose name would be a pattern."""
    name = F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(F.regexp_replace("c_name", "#", "."))
    return table(spark, sf_dir, "customer").select("c_custkey", names.strip_provider(name, "R.").alias("bare"))
