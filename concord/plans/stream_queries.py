"""Streaming forms of batch queries, run over files that arrive in the order of time."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.plans import flow_queries
from concord.plans.entry import register
from concord.plans.event_queries import ROUTE_SQL, THROTTLE_SECONDS, THROTTLE_SQL, as_notice
from concord.session import shared_path, table
from concord.streaming import retries, streams

BATCHES = 3
FILES = 4
ATTEMPTS, INITIAL_MS, STEP_MS = 3, 20, 10


def arriving(spark: SparkSession, sf_dir: str, rows=None) -> DataFrame:
    """events (or what rows makes of them) as a stream: the files of each third of the time span, one third after the other, FILES of them a micro-batch.

    Within a third a user's events are in one file, so that however the files are dealt, each user's arrive in the order of time."""
    path = shared_path(spark, "arriving")
    events = table(spark, sf_dir, "events").where("ts IS NOT NULL")
    span = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    for k in range(BATCHES):
        low, high = (span["a"] + (span["b"] - span["a"]) * i / BATCHES for i in (k, k + 1))
        part = events.where((F.col("ts") >= F.lit(low)) & ((F.col("ts") < F.lit(high)) | F.lit(k == BATCHES - 1)))
        part = part.repartition(FILES, "user_id")
        (part if rows is None else rows(part)).write.mode("append").parquet(path)
    schema = (events if rows is None else rows(events)).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES).parquet(path)


def _landed(stream: DataFrame) -> DataFrame:
    spark = stream.sparkSession
    path = shared_path(spark, "stream-out")
    streams.run_to_table(stream, path, shared_path(spark, "stream-checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


@register("stream_throttle", THROTTLE_SQL)
def stream_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A third of the time comes after the other, so nothing is later than the whole span; state goes once the watermark says that nothing can come.
    span = table(spark, sf_dir, "events").agg(F.unix_seconds(F.max("ts").cast("timestamp")) - F.unix_seconds(F.min("ts").cast("timestamp"))).first()[0] or 0
    logins = arriving(spark, sf_dir, lambda events: events.select("user_id", "ts"))
    emitted = _landed(streams.throttle_stream(logins, "user_id", "ts", THROTTLE_SECONDS, f"{span // BATCHES + 1} seconds"))
    return emitted.select("user_id", F.unix_micros("ts").alias("us"))


@register("stream_route", f"SELECT {ROUTE_SQL} AS route, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1")
def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, event = as_notice(F.col("event_type"))
    items = arriving(spark, sf_dir).select("event_id", kind.alias("entity_type"), event.alias("event"))
    configured = spark.createDataFrame([("users", "created"), ("users", "updated"), ("groups", "updated"), ("groups", "deleted")], "entity_type string, event string")
    return _landed(streams.route_stream(items, configured)).groupBy("route").agg(F.count("*").alias("n"))


@register("stream_notices", f"SELECT {ROUTE_SQL} AS route, count(*) AS n FROM events GROUP BY 1")
def stream_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request bodies that arrive as text are checked, taken apart and routed."""
    bodies = arriving(spark, sf_dir, lambda events: flow_queries.notice_bodies(events).select(F.col("raw").alias("value")))
    return _landed(streams.notice_stream(bodies, flow_queries.CONFIG)).groupBy("route").agg(F.count("*").alias("n"))


@register(
    "stream_retries",
    f"""WITH e AS (SELECT event_id AS item, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS position, CASE WHEN event_id % 131 = 0 THEN 9 WHEN event_id % 97 = 0 THEN 2 WHEN event_id % 41 = 0 THEN 1 ELSE 0 END AS failures FROM events WHERE ts IS NOT NULL)
    SELECT item, position, CASE WHEN failures < {ATTEMPTS} THEN 'done' ELSE 'timeout' END AS status, CAST(least(failures + 1, {ATTEMPTS}) AS INTEGER) AS attempts,
      CAST(CASE least(failures, {ATTEMPTS} - 1) WHEN 0 THEN 0 WHEN 1 THEN {INITIAL_MS} ELSE {2 * INITIAL_MS + STEP_MS} END AS BIGINT) AS waited_ms FROM e""",
)
def stream_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events update their users one after the other; some fail once, twice or always, and hold back those behind them until they are retried or given up."""
    e = F.col("event_id")
    failures = F.when(e % 131 == 0, "9").when(e % 97 == 0, "2").when(e % 41 == 0, "1").otherwise("0")
    # Times are unique neither within a user nor across; events of one time come by their number.
    rows = lambda events: events.select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("sort"), e.alias("item"), failures.alias("payload"))
    settled = retries.retry_stream(arriving(spark, sf_dir, rows), "user_id", lambda item, payload, attempt: attempt >= int(payload), ATTEMPTS, INITIAL_MS, STEP_MS)
    path, wanted = shared_path(spark, "retries"), table(spark, sf_dir, "events").where("ts IS NOT NULL").count()

    def landed() -> DataFrame:
        return spark.read.schema(settled.schema).parquet(path)

    def whole() -> bool:
        try:
            return landed().count() >= wanted
        except AnalysisException:  # nothing was written yet
            return False

    retries.run_until(settled, path, shared_path(spark, "stream-checkpoint"), whole)
    return landed()
