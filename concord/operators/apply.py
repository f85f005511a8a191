"""Keyed writes: upserts, guarded links and role tables, as whole new states of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concord.session import cut_lineage


def last_of_each(changes: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row of changes for each key: the last by order, and of rows that are equal in it the greatest by all columns, as text where they can't be compared."""
    text = lambda c: F.to_json(F.struct(F.col(f"`{c}`")))
    rank = F.struct(*([F.col(f"`{order}`").alias("order")] if order else []), *[text(c).alias(f"c{i}") for i, c in enumerate(changes.columns)])
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(changes.columns)])
    best = changes.groupBy(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]).agg(F.max_by(row, rank).alias("row"))
    return best.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(changes.columns)])


def upsert(target: DataFrame, changes: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """target with the rows of changes in place of those with their keys, and the others added. Of several changes of one key the last by
    order (a column of changes, which target need not have) counts; see last_of_each. Null keys are equal to nothing."""
    last = last_of_each(changes, keys, order)
    if order is not None and order not in target.columns:
        last = last.drop(order)
    return target.join(last.select(*keys), keys, "left_anti").unionByName(last, allowMissingColumns=True)


def guarded_links(requests: DataFrame, identities: DataFrame) -> DataFrame:
    """requests (method, id, user_id) with status: linked, exists (same user) or error (another user owns the key).

    Of several users asking for one free key the lowest gets it."""
    owners = identities.select("method", "id", F.col("user_id").alias("owner"))
    wanted = requests.groupBy("method", "id").agg(F.min("user_id").alias("winner"))
    met = requests.join(owners, ["method", "id"], "left").join(wanted, ["method", "id"])
    owner = F.coalesce("owner", "winner")
    status = F.when(owner != F.col("user_id"), "error").when(F.col("owner").isNotNull(), "exists").otherwise("linked")
    return met.select("method", "id", "user_id", status.alias("status")).distinct()


def link_identities(identities: DataFrame, requests: DataFrame) -> DataFrame:
    """identities with the new links; asking twice adds nothing."""
    new = guarded_links(requests, identities).where("status = 'linked'").select("method", "id", "user_id")
    return identities.unionByName(new)


def create_users(users: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New users for requests (username, email) whose e-mail nobody has, and the requests that cannot be met (no usable name or e-mail).

    Of several requests for one e-mail the smallest name is taken. Ids go on from the highest one in use, in the order of e-mails: rows are
    sorted by range, and each range starts where the counts of those before it end."""
    usable = F.coalesce((F.col("username") != "") & F.col("email").contains("@"), F.lit(False))
    failed = requests.where(~usable)
    new = requests.where(usable).groupBy("email").agg(F.min("username").alias("username")).join(users.select("email"), "email", "left_anti")
    dealt = new.repartitionByRange("email").sortWithinPartitions("email").withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    dealt = cut_lineage(dealt.withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1))))  # the number within the partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = dealt.groupBy("part").agg(F.count("*").alias("n")).select("part", before.alias("before"))  # a row for each partition
    top = F.coalesce(users.agg(F.max("user_id")).scalar(), F.lit(-1))
    numbered = dealt.join(F.broadcast(starts), "part")
    return numbered.select((top + 1 + F.col("before") + F.col("at")).alias("user_id"), "username", "email", F.lit(True).alias("active")), failed


def find_or_create_roles(roles: DataFrame, wanted: DataFrame) -> DataFrame:
    """roles (id, name, description) with a row for each wanted id that is missing."""
    new = wanted.select("id").distinct().join(roles, "id", "left_anti")
    return roles.unionByName(new.select("id", F.col("id").alias("name"), F.lit(None).cast("string").alias("description")))


def delete_roles(roles: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """roles without the given ids, and the ids that no role had."""
    return roles.join(ids, "id", "left_anti"), ids.join(roles, "id", "left_anti")


def add_user_roles(user_roles: DataFrame, added: DataFrame) -> DataFrame:
    return user_roles.select("user_id", "role").union(added.select("user_id", "role")).distinct()


def remove_user_roles(user_roles: DataFrame, removed: DataFrame) -> DataFrame:
    return user_roles.join(removed.select("user_id", "role"), ["user_id", "role"], "left_anti")
