"""Differences between a local and a remote state, and their application."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from concord.functions.names import is_managed
from concord.functions.values import symmetric_difference, truthy


def remote_roles(groups: DataFrame, provider: str, superadmins: DataFrame, superadmin_roles: tuple[str, ...]) -> DataFrame:
    """(user_id, role) a remote profile grants: one role a group, and the administration roles of superadmins.

    groups has user_id, group_id and role; superadmins has user_id."""
    from concord.functions.names import role_name

    granted = groups.select("user_id", role_name(provider, F.col("group_id"), F.col("role")).alias("role"))
    extra = superadmins.select("user_id", F.explode(F.array(*[F.lit(r) for r in superadmin_roles])).alias("role"))
    return granted.unionByName(extra).distinct()


def membership_delta(local: DataFrame, remote: DataFrame, provider: str) -> DataFrame:
    """(user_id, role, change) where change is added, dropped or unchanged.

    Only roles of the provider are compared with the remote ones: those missing there are dropped, remote ones missing among
    them are added, and every local role that is not dropped is unchanged. Users whose two role sets are equal keep all
    of theirs. One shuffle by user serves the join of the two states and the test of equality."""
    mine = local.select("user_id", "role", F.lit(True).alias("here"), F.lit(False).alias("there"))
    theirs = remote.select("user_id", "role", F.lit(False).alias("here"), F.lit(True).alias("there"))
    states = mine.unionByName(theirs).groupBy("user_id", "role").agg(F.max("here").alias("here"), F.max("there").alias("there"))
    differs = F.max(F.col("here") != F.col("there")).over(Window.partitionBy("user_id"))
    managed = is_managed(F.col("role"), provider)
    marked = states.withColumn("differs", differs)
    dropped = F.col("differs") & F.col("here") & managed & ~F.col("there")
    added = F.col("differs") & F.col("there") & ~(F.col("here") & managed)
    changes = F.array(F.when(dropped, "dropped"), F.when(added, "added"), F.when(F.col("here") & ~dropped, "unchanged"))
    return marked.select("user_id", "role", F.explode(F.array_compact(changes)).alias("change"))


def apply_membership(local: DataFrame, delta: DataFrame) -> DataFrame:
    """(user_id, role) after a delta; applying it twice changes nothing more."""
    return delta.where("change <> 'dropped'").select("user_id", "role").union(
        local.select("user_id", "role").join(delta.where("change = 'dropped'"), ["user_id", "role"], "left_anti")
    ).distinct()


def list_difference(original: DataFrame, update: DataFrame, on: list[str]) -> DataFrame:
    """Rows of update that original lacks and the reverse, repeats kept, with their side."""
    new = update.join(original.select(*on).distinct(), on, "left_anti").withColumn("side", F.lit("update"))
    old = original.join(update.select(*on).distinct(), on, "left_anti").withColumn("side", F.lit("original"))
    return new.unionByName(old)


def leaves(schema: StructType, id_col: str) -> dict[str, DataType]:
    """The path of every leaf with its type; structs are entered, their paths joined by dots, each part in backquotes."""
    found: dict[str, DataType] = {}

    def enter(path: str, kind: DataType) -> None:
        if isinstance(kind, StructType):
            for f in kind.fields:
                enter(f"{path}.`{f.name}`" if path else f"`{f.name}`", f.dataType)
        else:
            found[path] = kind

    enter("", StructType([f for f in schema.fields if f.name != id_col]))
    return found


def sparse_diff(original: DataFrame, update: DataFrame, id_col: str, keep_falsy: bool = False) -> DataFrame:
    """(id, path, new_value) of the leaves of update that differ from original.

    A list that differs is given as its symmetric difference: elements that only update has, then those that only original has; the order of
    elements and repeats make no difference. Paths that only original has are left out. Values that are empty, zero, false or null are left
    out as well, unless keep_falsy. A row that original lacks is new in all its leaves. The two sides meet in one join; only what differs becomes a row."""
    met = update.select(F.col(id_col).alias("id"), F.struct(*[c for c in update.columns if c != id_col]).alias("u"))
    met = met.join(original.select(F.col(id_col).alias("id"), F.struct(*[c for c in original.columns if c != id_col]).alias("o"), F.lit(True).alias("known")), "id", "left")
    return diff_of_pairs(met, keep_falsy)


def diff_of_pairs(met: DataFrame, keep_falsy: bool = False) -> DataFrame:
    """sparse_diff where the two sides are in one row already. met: id, structs u (update) and o (original), and known, null for a row that is new."""
    new_leaves, old_leaves = (leaves(met.schema[c].dataType, "") for c in ("u", "o"))

    def changed(path: str, kind: DataType) -> Column:
        name, new = F.lit(path.replace("`", "")), F.col(f"u.{path}")
        old = F.col(f"o.{path}") if path in old_leaves else F.lit(None).cast(kind)
        if isinstance(kind, ArrayType):
            none = F.array().cast(kind)
            value = symmetric_difference(F.coalesce(new, none), F.coalesce(old, none))
            return F.when((F.size(value) > 0) | (F.lit(keep_falsy) & F.col("known").isNull()), F.struct(name.alias("path"), F.to_json(value).alias("value")))
        text = (lambda c: F.to_json(c)) if isinstance(kind, MapType) else (lambda c: c.cast("string"))
        differs = F.col("known").isNull() | ~text(new).eqNullSafe(text(old))
        return F.when(differs & (F.lit(keep_falsy) | truthy(new, kind.simpleString())), F.struct(name.alias("path"), text(new).alias("value")))

    rows = F.array_compact(F.array(*[changed(p, k) for p, k in new_leaves.items()]))
    return met.select("id", F.explode(rows).alias("leaf")).select("id", "leaf.path", F.col("leaf.value").alias("new_value"))


def nest_diff(diff: DataFrame) -> DataFrame:
    """One JSON object of path and value for each id."""
    pairs = F.array_sort(F.collect_list(F.struct("path", "new_value")))
    return diff.groupBy("id").agg(F.to_json(F.map_from_entries(pairs)).alias("diff"))


def recursive_merge(base: DataFrame, extra: DataFrame, id_col: str) -> DataFrame:
    """Rows of base with those of extra laid over: structs are entered, arrays appended, other values replaced where extra has the column.

    Both sides are joined on the id; a row that only one side has stays as it is. Depth follows the schema."""
    b, e = base.alias("b"), extra.alias("e")

    def merged(path: str, kind, other):
        left, right = F.col(f"b.{path}"), F.col(f"e.{path}")
        if other is None:
            return left
        if kind.typeName() == "struct":
            theirs = {f.name: f.dataType for f in other.fields}
            inner = [merged(f"{path}.`{f.name}`", f.dataType, theirs.get(f.name)).alias(f.name) for f in kind.fields]
            return F.when(right.isNull(), left).when(left.isNull(), right).otherwise(F.struct(*inner)) if set(theirs) == {f.name for f in kind.fields} else F.struct(*inner)
        if kind.typeName() == "array":
            return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(F.concat(left, right))
        return F.when(F.col(f"e.{id_col}").isNull(), left).otherwise(right)

    theirs = {f.name: f.dataType for f in extra.schema.fields}
    columns = [merged(f"`{f.name}`", f.dataType, theirs.get(f.name)).alias(f.name) for f in base.schema.fields if f.name != id_col]
    return b.join(e, F.col(f"b.{id_col}") == F.col(f"e.{id_col}"), "full_outer").select(F.coalesce(f"b.{id_col}", f"e.{id_col}").alias(id_col), *columns)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
