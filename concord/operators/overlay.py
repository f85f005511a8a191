"""New values of profiles and collection documents from remote snapshots, and guards for unique fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.values import filled, has_key, name_parts, or_else
from concord.session import cut_lineage


def profile_overlay(local: DataFrame, remote: DataFrame, member_field: str = "identifier_kc_username") -> DataFrame:
    """New rows of the users that a remote profile is known for.

    local: user_id, username, email, active, preferences (map), user_profile (map). remote: user_id, username, email, name, first_name,
    last_name, institutional_affiliation, orcid."""
    fields = ("username", "email", "name", "first_name", "last_name", "institutional_affiliation", "orcid")
    met = local.join(remote.select("user_id", F.struct(*fields).alias("profile")), "user_id")
    return met.select("user_id", *overlaid(F.col("preferences"), F.col("user_profile"), F.col("profile"), member_field))


def overlaid(preferences: Column, user_profile: Column, remote: Column, member_field: str = "identifier_kc_username") -> list[Column]:
    """username, email, active, preferences and user_profile of a user with the remote profile (a struct) laid over.

    Full name, name parts and member name are always set, affiliation and ORCID only where the remote has them; other profile fields
    stay. Visibility preferences become public."""
    always = F.map_from_arrays(
        F.array(F.lit("full_name"), F.lit("name_parts"), F.lit(member_field)),
        F.array(or_else(remote["name"], F.lit("")), name_parts(remote["first_name"], remote["last_name"]), or_else(remote["username"], F.lit(""))),
    )
    where_known = F.map_filter(F.map_from_arrays(F.array(F.lit("affiliations"), F.lit("identifier_orcid")), F.array(remote["institutional_affiliation"], remote["orcid"])), lambda _, v: filled(v))
    public = F.create_map(*[F.lit(x) for x in ("visibility", "public", "email_visibility", "public")])
    return [
        remote["username"].alias("username"),
        remote["email"].alias("email"),
        F.lit(True).alias("active"),
        overlay_map(preferences, public).alias("preferences"),
        overlay_map(user_profile, F.map_concat(always, where_known)).alias("user_profile"),
    ]


def overlay_map(base: Column, over: Column) -> Column:
    """base with the entries of over on top; a null base is empty. Works under any duplicate-key setting."""
    kept = F.map_filter(F.coalesce(base, F.create_map().cast("map<string,string>")), lambda k, _: ~F.map_contains_key(over, k))
    return F.map_concat(kept, over)


def unique_guard(users: DataFrame, proposals: DataFrame, fields: list[str], order: str = "user_id") -> DataFrame:
    """proposals with each `<field>` as it may be written and `<field>_collides`, as if users came one after the other by `order`, then by user_id.

    A user gets a new value if nobody has it when their turn comes: nobody ever had it, or the one who had it changed to another before, and no earlier user
    got it. A refused user keeps the old value. A value that several users have at the start is never free. proposals: user_id, new_<field> for each field, and the column that
    order names; one row a user. users: user_id and the fields. Each field is settled for itself, all in one pass.

    Only the first user after the holder's turn can get a value, and does if the holder got theirs. So each such user waits for at most
    one other: chains of waiting are settled by pointer jumping, in as many rounds as the logarithm of the longest has; nobody in a circle gets anything."""
    turn = F.struct(F.col(order).alias("turn"), F.col("user_id").alias("user_id"))
    olds = users.select("user_id", *[F.col(f).alias(f"__old_{f}") for f in fields])
    met = proposals.join(olds, "user_id")
    changes = {f: F.coalesce(filled(F.col(f"new_{f}")) & ~F.col(f"new_{f}").eqNullSafe(F.col(f"__old_{f}")), F.lit(False)) for f in fields}
    # Only real changes are compared with each other and with what is held: nulls and values that stay would pile up on a few keys.
    wanted = F.array_compact(F.array(*[F.when(changes[f], F.struct(F.lit(f).alias("field"), F.col(f"new_{f}").alias("value"))) for f in fields]))
    asks = cut_lineage(met.select(turn.alias("asker"), F.explode(wanted).alias("w")).select("asker", "w.field", "w.value"))
    own = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])
    holds = users.select("user_id", F.explode(own).alias("h")).select("h.field", "h.value", F.col("user_id").alias("holder")).where(filled(F.col("value")))
    held = holds.join(asks.select("field", "value"), ["field", "value"], "left_semi")
    turns = asks.select("field", F.col("asker.user_id").alias("holder"), F.col("asker").alias("holders_turn"))
    held = held.join(turns, ["field", "holder"], "left").groupBy("field", "value").agg(F.count("*").alias("n"), F.min("holder").alias("holder"), F.min("holders_turn").alias("holders_turn"))
    # A holder without a turn, or several holders, leave holders_turn null or n above one: no asker comes after them.
    after = F.col("n").isNull() | ((F.col("n") == 1) & F.coalesce(F.col("asker") > F.col("holders_turn"), F.lit(False)))
    firsts = asks.join(held, ["field", "value"], "left").where(after).groupBy("field", "value").agg(F.min("asker.turn").alias("turn"), F.min("asker").alias("asker"), F.min("holder").alias("waits_for"))
    got = _settled(cut_lineage(firsts.select("field", F.col("asker.user_id").alias("user_id"), "waits_for")))
    granted = got.groupBy("user_id").agg(F.collect_set("field").alias("__granted"))
    judged = met.join(granted, "user_id", "left")
    has = lambda f: F.coalesce(F.array_contains("__granted", f), F.lit(False))
    values = [F.when(has(f), F.col(f"new_{f}")).otherwise(F.col(f"__old_{f}")).alias(f) for f in fields]
    return judged.select(*[c for c in proposals.columns if c not in {f"new_{f}" for f in fields}], *values, *[(changes[f] & ~has(f)).alias(f"{f}_collides") for f in fields], *[f"new_{f}" for f in fields])


def _settled(waiting: DataFrame) -> DataFrame:
    """(field, user_id) of those in waiting (field, user_id, waits_for) who wait for nobody, or for one of these."""
    at = waiting.select("field", F.col("user_id").alias("waits_for"), F.col("waits_for").alias("further"), F.lit(True).alias("there"))
    while not waiting.where("waits_for IS NOT NULL").isEmpty():
        met = waiting.join(at, ["field", "waits_for"], "left")
        # One who waits for somebody that can't get anything has no row to jump to, and goes.
        waiting = cut_lineage(met.where("waits_for IS NULL OR there").select("field", "user_id", F.col("further").alias("waits_for")))
        at = waiting.select("field", F.col("user_id").alias("waits_for"), F.col("waits_for").alias("further"), F.lit(True).alias("there"))
    return waiting.select("field", "user_id")


def collision_guard(users: DataFrame, proposals: DataFrame, field: str, order: str = "user_id") -> DataFrame:
    """unique_guard for one field."""
    return unique_guard(users, proposals, [field], order)


def keep_old_email(profile: Column, refused_or_old: Column, changed: Column, field: str = "identifier_email") -> Column:
    """The profile map with the previous e-mail under `field` where the address changed."""
    return F.when(changed & filled(refused_or_old), overlay_map(profile, F.create_map(F.lit(field), refused_or_old))).otherwise(profile)


def stored_profile(text: Column) -> Column:
    """The profile map of stored JSON text; empty where the text is null or no JSON object, so that a user with a corrupt profile starts afresh."""
    return F.coalesce(F.from_json(F.when(F.json_object_keys(text).isNotNull(), text), "map<string,string>"), F.create_map().cast("map<string,string>"))


VISIBILITY = {"public": "public", "private": "restricted", "hidden": "restricted"}


def document_overlay(documents: DataFrame, metadata: DataFrame) -> DataFrame:
    """Collection documents with the parts that remote group metadata has.

    documents: id, group_id, title, description, website, visibility, group_name, group_description, group_visibility. metadata: group_id and
    raw (JSON text). Only keys that are present change anything: url the website, visibility both visibilities, name and description
    the group's own fields. Title and description of the document stay."""
    raw = F.col("raw")
    field = lambda k: F.get_json_object(raw, f"$.{k}")
    shown = F.create_map(*[F.lit(x) for pair in VISIBILITY.items() for x in pair])
    put = lambda key, value, old: F.when(has_key(raw, key), value).otherwise(F.col(old)).alias(old)
    return documents.join(metadata.select("group_id", "raw"), "group_id").select(
        "id",
        "group_id",
        "title",
        "description",
        put("url", field("url"), "website"),
        put("visibility", F.coalesce(F.try_element_at(shown, field("visibility")), F.lit("restricted")), "visibility"),
        put("name", field("name"), "group_name"),
        put("description", field("description"), "group_description"),
        put("visibility", field("visibility"), "group_visibility"),
    )
