"""Change notices: normalisation, expansion, allow list, routing and the status of a request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.config import Config

ITEMS = "map<string,array<struct<id:string,event:string,kc_id:string>>>"


def normalise(raw: Column) -> Column:
    """The updates of a notice as JSON text; a notice of associations alone is brought into that form, nested or not."""
    updates = F.get_json_object(raw, "$.updates")
    bare = F.get_json_object(raw, "$.associations")
    nested = F.coalesce(F.get_json_object(bare, "$.associations"), bare)
    return F.coalesce(updates, F.when(nested.isNotNull(), F.concat(F.lit('{"associations":'), nested, F.lit("}"))))


def alias_table(spark, config: Config) -> DataFrame:
    """(idp, provider, auth_method): the provider's own name uses its first alias, an alias names the provider and itself."""
    own = [(config.provider, config.provider, config.aliases[0] if config.aliases else config.provider)]
    return spark.createDataFrame(own + [(a, config.provider, a) for a in config.aliases], "idp string, provider string, auth_method string")


def with_sender(notices: DataFrame, spark, config: Config) -> DataFrame:
    """notices with idp, provider and auth_method by the `idp` of the body; those that name none, or one that is not known, go. notices has raw."""
    named = notices.withColumn("idp", F.get_json_object("raw", "$.idp"))
    return named.join(F.broadcast(alias_table(spark, config)), "idp")  # configuration


def expand(notices: DataFrame) -> DataFrame:
    """One row for each item: the columns of notices but raw, then entity_type, id, event and kc_id. notices has raw."""
    parsed = notices.withColumn("items", F.from_json(normalise(F.col("raw")), ITEMS)).drop("raw")
    by_type = parsed.select(*[c for c in parsed.columns if c != "items"], F.explode("items").alias("entity_type", "list"))
    return by_type.withColumn("item", F.explode("list")).select(*[c for c in by_type.columns if c != "list"], "item.*")


def expand_judged(notices: DataFrame, config: Config) -> DataFrame:
    """As expand, with what the request alone tells of each item and of its request: allowed, malformed, broken (an item of the request is
    malformed) and odd_types (the request has a type that is not configured, if only with an empty list).

    An item of a configured type needs an event; if that is allowed it needs an id, and an association a member too. Items of
    other types, or with another event, are rejected as they are. A null counts as absent. Requests are judged before their items are taken apart, so nothing is shuffled."""
    types = F.array(*[F.lit(t) for t in config.allowed_events])
    pairs = F.array(*[F.concat_ws(" ", F.lit(t), F.lit(e)) for t, events in config.allowed_events.items() for e in events])

    def judged(kind: Column, item: Column) -> Column:
        allowed = F.coalesce(F.array_contains(pairs, F.concat(kind, F.lit(" "), item["event"])), F.lit(False))
        lacks = item["id"].isNull() | ((kind == "associations") & item["kc_id"].isNull())
        malformed = F.array_contains(types, kind) & (item["event"].isNull() | (allowed & lacks))
        return F.struct(kind.alias("entity_type"), item["id"].alias("id"), item["event"].alias("event"), item["kc_id"].alias("kc_id"), allowed.alias("allowed"), malformed.alias("malformed"))

    parsed = notices.withColumn("by_type", F.from_json(normalise(F.col("raw")), ITEMS)).drop("raw")
    odd = F.exists(F.map_keys("by_type"), lambda t: ~F.array_contains(types, t))
    items = F.flatten(F.transform(F.map_entries("by_type"), lambda e: F.transform(F.coalesce(e["value"], F.array().cast("array<struct<id:string,event:string,kc_id:string>>")), lambda i: judged(e["key"], i))))
    whole = parsed.withColumn("items", items).withColumn("odd_types", odd).drop("by_type")
    broken = F.exists("items", lambda i: i["malformed"])
    return whole.withColumn("broken", broken).withColumn("item", F.explode("items")).drop("items").select("*", "item.*").drop("item")


def allowed_table(spark, config: Config) -> DataFrame:
    rows = [(kind, event) for kind, events in config.allowed_events.items() for event in events]
    return spark.createDataFrame(rows, "entity_type string, event string")


def allowed(items: DataFrame, table: DataFrame) -> DataFrame:
    """Items whose type and event are configured; the table is configuration, so it is broadcast."""
    return items.join(F.broadcast(table), ["entity_type", "event"], "left_semi")


def rejected(items: DataFrame, table: DataFrame) -> DataFrame:
    return items.join(F.broadcast(table), ["entity_type", "event"], "left_anti")


def route(entity_type: Column, event: Column) -> Column:
    """Where an allowed item goes. Created and deleted users are accepted and then unexpected."""
    return (
        F.when((entity_type == "users") & (event == "updated"), "update_user")
        .when((entity_type == "groups") & event.isin("created", "updated"), "update_group")
        .when((entity_type == "groups") & (event == "deleted"), "not_implemented")
        .when((entity_type == "associations") & (event == "associated"), "associate_user")
        .otherwise("unexpected")
    )


def batch_status(judged: DataFrame, request: str = "request_id") -> DataFrame:
    """HTTP status and counts of each request. judged: request, malformed, allowed and known (booleans for each item), and optionally odd_types.

    A malformed item fails the whole request before anything is enqueued; then valid items decide, rejected ones turn 202 into
    400, and without valid items unknown entities give 404, all else 400."""
    malformed, valid = F.col("malformed"), F.col("allowed") & F.col("known")
    odd = F.bool_or("odd_types") if "odd_types" in judged.columns else F.lit(False)
    sums = judged.groupBy(request).agg(
        F.bool_or(malformed).alias("broken"),
        odd.alias("odd"),
        F.count_if(~malformed & valid).alias("n_valid"),
        F.count_if(~malformed & ~F.col("allowed")).alias("n_rejected"),
        F.count_if(~malformed & F.col("allowed") & ~F.col("known")).alias("n_unknown"),
    )
    status = (
        F.when(F.col("broken"), 400)
        .when((F.col("n_valid") > 0) & (F.col("odd") | (F.col("n_rejected") > 0)), 400)
        .when(F.col("n_valid") > 0, 202)
        .when(F.col("n_unknown") > 0, 404)
        .otherwise(400)
    )
    enqueued = F.when(F.col("broken"), 0).otherwise(F.col("n_valid"))
    return sums.select(request, status.cast("int").alias("status"), enqueued.cast("long").alias("n_enqueued"), "n_rejected", "n_unknown")
