"""Group collections: finding, splitting, updating and disowning their documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions.names import groups_named


def find_documents(documents: DataFrame, instance: str, group_ids: DataFrame, include_deleted: bool = False) -> DataFrame:
    """Documents of an instance for the given group ids; deleted ones only where asked. documents: instance, group_id, is_deleted."""
    found = documents.where(F.col("instance") == instance).join(group_ids, "group_id", "left_semi")
    return found if include_deleted else found.where(~F.col("is_deleted"))


def split_active(documents: DataFrame, key: str = "group_id") -> DataFrame:
    """For each group: its number of active and deleted documents, and what an update does with it."""
    sums = documents.groupBy(key).agg(F.count_if(~F.col("is_deleted")).alias("n_active"), F.count_if(F.col("is_deleted")).alias("n_deleted"))
    action = F.when(F.col("n_active") > 1, "error").when(F.col("n_active") == 1, "update").otherwise("deleted")
    return sums.select(key, "n_active", "n_deleted", action.alias("action"))


def roles_of_groups(roles: DataFrame, groups: DataFrame, provider: str) -> DataFrame:
    """(group_id, id) of the roles whose name has `provider---group|` in it, anywhere. Every group that a name may mean is a row of a list of postings, so this is an equality join."""
    postings = roles.select("id", F.explode(groups_named(F.col("id"), provider)).alias("group_id")).distinct()
    return groups.select("group_id").join(postings, "group_id").select("group_id", "id")


def deletion_summary(documents: DataFrame, roles: DataFrame, groups: DataFrame, instance: str, provider: str) -> DataFrame:
    """(group_id, disowned_communities, deleted_roles), each a sorted list in one string."""
    listed = lambda df, column, name: df.groupBy("group_id").agg(F.array_join(F.array_sort(F.collect_set(column)), ",").alias(name))
    disowned = listed(find_documents(documents, instance, groups), "id", "disowned_communities")
    deleted = listed(roles_of_groups(roles, groups, provider), "id", "deleted_roles")
    return groups.join(disowned, "group_id", "left").join(deleted, "group_id", "left").fillna("", ["disowned_communities", "deleted_roles"])
