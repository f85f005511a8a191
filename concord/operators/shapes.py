"""Differences and merges of JSON objects of any shape.

Objects are opened one level at a time, all rows together, until no level has objects left: as many steps as the deepest object has levels. Between steps a value is
its JSON text, made once. What two objects hold is put side by side within the row, so only the two sides' meeting is a shuffle. A path is the array of keys that leads to a value.

Cases: text that is no JSON, or has a key twice, is an absent side. A key that is absent counts as null. Where the sides have different kinds of value, the new one
counts whole. Numbers are compared as JSON has them in its shortest form: 1.50 is 1.5, 1 is not true. Lists are compared by their elements, whatever the order of keys within them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.values import let, symmetric_difference
from concord.session import cut_lineage

MEMBERS = "map<string,variant>"


def members(text: Column) -> Column:
    """The values of an object by key, from its JSON text; none for all else."""
    return F.coalesce(F.when(text.startswith("{"), F.from_json(text, MEMBERS)), F.create_map().cast(MEMBERS))


def falsy(text: Column) -> Column:
    """Whether the JSON text of a value is absent, null, false, zero or empty."""
    return text.isNull() | text.isin("null", "false", '""', "[]", "{}") | text.rlike(r"^-?0(\.0*)?([eE][+-]?\d+)?$")


def elements(text: Column) -> Column:
    """The JSON texts of a list's elements, from its own; empty for all else."""
    listed = F.when(text.startswith("["), F.transform(F.try_variant_get(F.parse_json(text), "$", "array<variant>"), lambda x: F.to_json(x)))
    return F.coalesce(listed, F.array().cast("array<string>"))


def _sides(left: DataFrame, right: DataFrame, id_col: str, left_col: str, right_col: str, how: str) -> DataFrame:
    a = left.select(F.col(id_col).alias("id"), F.try_parse_json(left_col).alias("u"))
    b = right.select(F.col(id_col).alias("id"), F.try_parse_json(right_col).alias("o"))
    return a.join(b, "id", how).select("id", F.array().cast("array<string>").alias("path"), F.to_json("u").alias("ut"), F.to_json("o").alias("ot"))


def _opened(pairs: DataFrame, of_update: bool) -> DataFrame:
    """A row for each key that either of two objects has, or only for those that the update has, with the JSON texts of the values that both have there."""
    rest = [c for c in pairs.columns if c not in ("id", "path", "ut", "ot")]
    # Side by side before they become rows, so that no row holds more than its own two values.
    both = F.map_zip_with(members(F.col("ut")), members(F.col("ot")), lambda _, u, o: F.struct(F.to_json(u).alias("ut"), F.to_json(o).alias("ot")))
    each = pairs.select("id", "path", *rest, F.explode(both).alias("key", "value"))
    rows = each.select("id", F.concat("path", F.array("key")).alias("path"), *rest, "value.ut", "value.ot")
    return rows.where("ut IS NOT NULL") if of_update else rows


def shape_diff(original: DataFrame, update: DataFrame, id_col: str, value_col: str, keep_falsy: bool = False) -> DataFrame:
    """(id, path, new_value) of what update's objects have otherwise than original's; value_col is JSON text, new_value too. One row an id on either side.

    An object is compared key by key, and whole where original has nothing or something falsy in its place: then all it holds is new. Of lists the elements that only update has
    are given, then those that only original has, repeats and order kept. What is falsy now is left out unless the object around it is new, or keep_falsy. Keys that only original has are left out."""
    here = _sides(update, original, id_col, value_col, value_col, "left").withColumn("fresh", falsy(F.col("ot")))
    found = []
    while True:
        rows = _opened(here, True)
        ut, ot, fresh = F.col("ut"), F.col("ot"), F.col("fresh")
        deeper = ut.startswith("{") & (ut != "{}")
        changes = F.to_json(F.transform(symmetric_difference(elements(ut), elements(ot)), lambda x: F.parse_json(x)))
        differs = ~F.coalesce(ut, F.lit("null")).eqNullSafe(F.coalesce(ot, F.lit("null"))) & (F.lit(keep_falsy) | ~falsy(ut))
        value = F.when(fresh, ut).when(ut.startswith("["), let(changes, lambda c: F.when(c != "[]", c))).when(differs & (ut != "{}"), ut)
        # Of a row is kept what it gives, or else the objects to open next, with whether what they hold is new.
        inner = F.when(deeper, F.struct("ut", "ot", (fresh | falsy(ot) | ~ot.startswith("{")).alias("fresh")))
        rows = cut_lineage(rows.select("id", "path", F.when(~deeper, value).alias("new_value"), inner.alias("inner")))
        found.append(rows.where("new_value IS NOT NULL").select("id", "path", "new_value"))
        here = rows.where("inner IS NOT NULL").select("id", "path", "inner.*")
        if here.isEmpty():
            break
    return _union(found)


def shape_merge(base: DataFrame, extra: DataFrame, id_col: str, value_col: str) -> DataFrame:
    """(id, path, value) of base's objects with those of extra laid over: objects are entered, lists appended, other values replaced where extra has the key.

    An id that one side has stays as it is there. An empty object of extra changes nothing that base has."""
    here, found = _sides(extra, base, id_col, value_col, value_col, "full_outer"), []
    while True:
        rows = cut_lineage(_opened(here, False))
        ut, ot = F.col("ut"), F.col("ot")
        enters = lambda t: t.startswith("{") & (t != "{}")
        deeper = F.coalesce(F.when(ut.isNotNull(), ut.startswith("{") & (enters(ut) | enters(ot))).otherwise(enters(ot)), F.lit(False))
        appended = F.to_json(F.transform(F.concat(elements(ot), elements(ut)), lambda x: F.parse_json(x)))
        value = F.when(ut.startswith("[") & ot.startswith("["), appended).when(ut == "{}", F.coalesce(ot, ut)).otherwise(F.coalesce(ut, ot))
        found.append(rows.where(~deeper).select("id", "path", value.alias("value")))
        # A value that is no object gives way to an object, and holds nothing of its own there.
        here = rows.where(deeper).select("id", "path", "ut", "ot")
        if here.isEmpty():
            break
    return _union(found)


def rebuild(rows: DataFrame, value_col: str) -> DataFrame:
    """(id, value): one JSON object for each id of (id, path, value_col), where value_col is JSON text. Objects are closed from the deepest level up."""
    rows = cut_lineage(rows.select("id", "path", F.col(value_col).alias("value")))
    for depth in range(rows.agg(F.max(F.size("path"))).first()[0] or 0, 0, -1):
        name = F.to_json(F.array(F.element_at("path", -1)))
        member = F.concat(F.expr("substring(name, 2, length(name) - 2)"), F.lit(":"), "value")
        deep = rows.where(F.size("path") == depth).withColumn("name", name)
        closed = deep.groupBy("id", F.slice("path", 1, depth - 1).alias("path")).agg(F.array_sort(F.collect_list(member)).alias("members"))
        closed = closed.select("id", "path", F.concat(F.lit("{"), F.array_join("members", ","), F.lit("}")).alias("value"))
        rows = closed.unionByName(rows.where(F.size("path") < depth))
    return rows.select("id", "value")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
