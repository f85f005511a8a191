"""Queries over events as change notices: allow list, routing, status, outcomes, throttling, times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions import times
from concord.operators import notices, report, resolve, throttle
from concord.plans.entry import register
from concord.session import table

ALLOWED = ("click", "view", "purchase")
THROTTLE_SECONDS = 6 * 3600
NOW = 1705320000.0


def _allowed_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("users", e) for e in ALLOWED], "entity_type string, event string")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as notice items: the kind of event is the event, the user is the entity."""
    return table(spark, sf_dir, "events").select("event_id", "user_id", F.lit("users").alias("entity_type"), F.col("event_type").alias("event"), "props", "ts")


@register("event_allowlist", "SELECT event_id, user_id, event_type AS event FROM events WHERE event_type IN ('click', 'view', 'purchase')")
def event_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.allowed(_items(spark, sf_dir), _allowed_types(spark)).select("event_id", "user_id", "event")


@register("event_rejects", "SELECT event_id, user_id, event_type AS event FROM events e WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('click'), ('view'), ('purchase')) a(x) WHERE a.x = e.event_type)")
def event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.rejected(_items(spark, sf_dir), _allowed_types(spark)).select("event_id", "user_id", "event")


@register("unknown_entities", "SELECT user_id, count(*) AS n FROM events e WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = e.user_id) GROUP BY user_id")
def unknown_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"))
    return resolve.unknown(table(spark, sf_dir, "events").select("user_id"), known, ["user_id"]).groupBy("user_id").agg(F.count("*").alias("n"))


def as_notice(event_type: Column) -> tuple[Column, Column]:
    """Entity type and event that stand for the driver's kinds of event."""
    kind = F.when(event_type.isin("click", "view"), "users").when(event_type.isin("purchase", "signup"), "groups").otherwise("associations")
    event = F.when(event_type == "click", "updated").when(event_type == "view", "created").when(event_type == "purchase", "updated").when(event_type == "signup", "deleted").otherwise("associated")
    return kind, event


ROUTE_SQL = """CASE event_type WHEN 'click' THEN 'update_user' WHEN 'view' THEN 'unexpected' WHEN 'purchase' THEN 'update_group'
 WHEN 'signup' THEN 'not_implemented' ELSE 'associate_user' END"""


@register("event_routes", f"SELECT {ROUTE_SQL} AS route, count(*) AS n FROM events GROUP BY 1")
def event_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = table(spark, sf_dir, "events").select(notices.route(*as_notice(F.col("event_type"))).alias("route"))
    return routed.groupBy("route").agg(F.count("*").alias("n"))


@register(
    "batch_status",
    """
    WITH j AS (
      SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS request_id, event_type IN ('click', 'view', 'purchase') AS ok,
        EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = e.user_id) AS known FROM events e
    ), s AS (
      SELECT request_id, count(*) FILTER (ok AND known) AS n_enqueued, count(*) FILTER (NOT ok) AS n_rejected, count(*) FILTER (ok AND NOT known) AS n_unknown FROM j GROUP BY request_id
    )
    SELECT request_id, CAST(CASE WHEN n_enqueued > 0 AND n_rejected > 0 THEN 400 WHEN n_enqueued > 0 THEN 202 WHEN n_unknown > 0 THEN 404 ELSE 400 END AS INTEGER) AS status,
      n_enqueued, n_rejected, n_unknown FROM s""",
)
def batch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of an hour are one request."""
    known = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"), F.lit(True).alias("is_known"))
    judged = table(spark, sf_dir, "events").join(known, "user_id", "left").select(
        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000).cast("long").alias("request_id"),
        F.lit(False).alias("malformed"),
        F.col("event_type").isin(*ALLOWED).alias("allowed"),
        F.coalesce("is_known", F.lit(False)).alias("known"),
    )
    return notices.batch_status(judged)


@register(
    "outcome_buckets",
    """
    WITH o AS (
      SELECT CASE WHEN s.s_suppkey IS NULL THEN 'not_found_local' WHEN event_type = 'error' THEN 'failure' WHEN event_type = 'signup' THEN 'not_found_remote'
        WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) > 50 THEN 'success' ELSE 'unchanged' END AS bucket
      FROM events e LEFT JOIN supplier s ON s.s_suppkey = e.user_id
    ) SELECT bucket, count(*) AS n FROM o GROUP BY bucket""",
)
def outcome_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"), F.lit(True).alias("is_known"))
    status = F.when(F.col("event_type") == "error", "request_error").when(F.col("event_type") == "signup", "not_found").otherwise("ok")
    changes = F.when(F.get_json_object("props", "$.k").cast("int") > 50, 1).otherwise(0)
    met = table(spark, sf_dir, "events").join(known, "user_id", "left")
    return report.outcome_counts(met.select(report.bucket(F.col("is_known").isNotNull(), status, changes).alias("bucket")))


THROTTLE_SQL = f"""
WITH RECURSIVE t AS (SELECT DISTINCT user_id, ts FROM events WHERE ts IS NOT NULL), e(user_id, ts) AS (
  SELECT user_id, min(ts) FROM t GROUP BY user_id
  UNION ALL
  SELECT e.user_id, (SELECT min(t.ts) FROM t WHERE t.user_id = e.user_id AND t.ts > e.ts + INTERVAL {THROTTLE_SECONDS} SECOND) AS ts FROM e
  WHERE EXISTS (SELECT 1 FROM t WHERE t.user_id = e.user_id AND t.ts > e.ts + INTERVAL {THROTTLE_SECONDS} SECOND)
)
SELECT user_id, epoch_us(ts) AS us FROM e"""


@register("login_throttle", THROTTLE_SQL)
def login_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    emitted = throttle.throttle(table(spark, sf_dir, "events"), "user_id", "ts", THROTTLE_SECONDS)
    return emitted.select("user_id", F.unix_micros("ts").alias("us"))


def _epoch(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1_000_000.0)


@register("token_expiry", f"SELECT event_id, trunc(epoch_us(ts) / 1000000.0) < trunc({NOW}) AS expired FROM events")
def token_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", times.is_expired(_epoch("ts").cast("string"), F.lit(str(NOW))).alias("expired"))


@register(
    "cookie_ready",
    f"""SELECT event_id, CASE WHEN event_type = 'error' THEN true ELSE trunc({NOW}) - trunc(epoch_us(ts) / 1000000.0) >= 86400 END AS ready FROM events""",
)
def cookie_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events stand for malformed cookies."""
    cookie = F.when(F.col("event_type") == "error", "not a number").otherwise(_epoch("ts").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", times.is_ready(cookie, F.lit(str(NOW)), 86_400).alias("ready"))


@register("json_extract", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@register("summary_json", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k FROM events GROUP BY event_type")
def summary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries are built as JSON and read again."""
    sums = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("int")).alias("k"))
    text = sums.select(F.to_json(F.struct("event_type", "n", "k")).alias("summary"))
    return text.select(F.from_json("summary", "event_type string, n long, k long").alias("s")).select("s.*")


@register("backoff_schedule", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS attempt, CAST(1.0 + 0.5 * (CAST(json_extract_string(props, '$.k') AS BIGINT) % 10) AS DOUBLE) AS wait FROM events")
def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wait after each event's attempt; stream_retries waits by the same rule."""
    attempt = F.get_json_object("props", "$.k").cast("long") % 10
    return table(spark, sf_dir, "events").select("event_id", attempt.alias("attempt"), times.backoff_wait(attempt, 1.0, 0.5).alias("wait"))


@register("first_event_of_user", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def first_event_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return resolve.first_match(events.select("user_id").distinct(), events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")
