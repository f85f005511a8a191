"""Truthiness, key presence and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_else(first: Column, second: Column) -> Column:
    """first, or second where first is null or an empty string."""
    return F.coalesce(F.nullif(first, F.lit("")), second)


def filled(value: Column) -> Column:
    """True for a string that can serve as a lookup key."""
    return value.isNotNull() & (value != "")


def truthy(value: Column, kind: str) -> Column:
    """False for null and for the empty, zero or false value of the type named by kind."""
    if kind == "string":
        some = value != ""
    elif kind == "boolean":
        some = value
    elif kind.startswith(("array", "map")):
        some = F.size(value) > 0
    elif kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        some = value != 0
    else:
        some = value.isNotNull()
    return F.coalesce(some, F.lit(False))


def has_key(raw: Column, key: str) -> Column:
    """Whether a JSON object has a key, whatever its value."""
    return F.coalesce(F.array_contains(F.json_object_keys(raw), key), F.lit(False))


def name_parts(first: Column, last: Column) -> Column:
    return F.to_json(F.struct(F.coalesce(first, F.lit("")).alias("first"), F.coalesce(last, F.lit("")).alias("last")))


def unwrap(raw: Column, envelope: str) -> Column:
    """The JSON value below an optional envelope key."""
    return F.coalesce(F.get_json_object(raw, f"$.{envelope}"), raw)


def let(value: Column, result) -> Column:
    """result(value), where value is computed once however often result names it, within lambdas too."""
    return F.transform(F.array(value), result)[0]


def symmetric_difference(update: Column, original: Column) -> Column:
    """Elements of update that original lacks, then the reverse; order and repeats stay, nulls go."""
    return let(F.struct(F.array_compact(update).alias("u"), F.array_compact(original).alias("o")), lambda p: F.concat(_lacking(p["u"], p["o"]), _lacking(p["o"], p["u"])))


def _lacking(some: Column, other: Column) -> Column:
    """Elements of some that other lacks. Spark's set functions are hashed but give each element once; only lists with repeats are gone through again, by the fewer of the new and the common elements."""

    def kept(h: Column) -> Column:
        of_new, of_common = F.filter(some, lambda x: F.array_contains(h["new"], x)), F.filter(some, lambda x: ~F.array_contains(h["common"], x))
        return F.when(h["once"], h["new"]).when(F.size(h["new"]) <= F.size(h["common"]), of_new).otherwise(of_common)

    once = F.size(F.array_distinct(some)) == F.size(some)
    return let(F.struct(F.array_except(some, other).alias("new"), F.array_intersect(some, other).alias("common"), once.alias("once")), kept)
