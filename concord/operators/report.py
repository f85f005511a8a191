"""Outcome buckets of a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = ("success", "unchanged", "not_found_local", "not_found_remote", "timeout", "invalid_response", "failure")


def bucket(found_local: Column, status: Column, n_changes: Column) -> Column:
    """Of one entity, from whether it is known, how its remote snapshot was read and how many changes followed."""
    return (
        F.when(~found_local, "not_found_local")
        .when(status == "timeout", "timeout")
        .when(status == "not_found", "not_found_remote")
        .when(status == "parse_error", "invalid_response")
        .when(status != "ok", "failure")
        .when(n_changes > 0, "success")
        .otherwise("unchanged")
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """(bucket, n) of outcomes, which has bucket."""
    return outcomes.groupBy("bucket").agg(F.count("*").alias("n"))


def outcome_lists(outcomes: DataFrame, id_col: str) -> DataFrame:
    """(bucket, id as text) of every outcome: a row each, so that no bucket has to fit one task. Write it with partitionBy("bucket")."""
    return outcomes.select("bucket", F.col(id_col).cast("string").alias("id"))
