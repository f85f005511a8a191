"""Entity resolution: which local user a set of remote keys means.

The reference point is a cascade of lookups, tried in order until one gives an unambiguous hit. Here all keys of all
probes meet all keys of all users in one equality join; levels and ambiguity are settled by counting. Where only unambiguous
keys resolve, users are counted for each key before the join, so that a probe meets one row a key however many share it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.functions.bitmaps import mark_maybe
from concord.functions.values import filled
from concord.session import cut_lineage

IDENTITY, ORCID, MEMBER, LEGACY, USERNAME, PREFIXED, LOWER_PREFIXED, EMAIL = range(1, 9)
MEMBER_LEVELS = (MEMBER, LEGACY, USERNAME, PREFIXED, LOWER_PREFIXED)


def _keys(*entries: tuple[int | str, Column, Column]) -> Column:
    """An array of (level, kind, key), without entries whose key can match nothing."""
    made = [F.struct(F.lit(level).alias("level"), kind.alias("kind"), key.alias("key")) for level, kind, key in entries]
    return F.filter(F.array(*made), lambda e: e["kind"].isNotNull() & filled(e["key"]))


def user_keys(users: DataFrame, identities: DataFrame, member_field: str = "identifier_kc_username") -> DataFrame:
    """(kind, key, user_id) by which a user can be found. users: user_id, username, email, user_profile (JSON text)."""
    profile = lambda f: F.get_json_object("user_profile", f"$.{f}")
    own = _keys((0, F.lit("orcid"), profile("identifier_orcid")), (0, F.lit("member"), profile(member_field)), (0, F.lit("username"), F.col("username")), (0, F.lit("email"), F.col("email")))
    of_users = users.select("user_id", F.explode(own).alias("k")).select("k.kind", "k.key", "user_id")
    linked = identities.select(F.concat(F.lit("identity:"), "method").alias("kind"), F.col("id").alias("key"), F.col("user_id")).where(filled(F.col("key")))
    return of_users.unionByName(linked).distinct()


def probe_keys(probes: DataFrame, provider: str) -> DataFrame:
    """(probe_id, level, kind, key). probes: probe_id, external_method, external_id, orcid, member_name, email."""
    name, method = F.col("member_name"), F.col("external_method")
    if_external = lambda key: F.when(filled(method) & filled(name), key)
    entries = _keys(
        (IDENTITY, F.concat(F.lit("identity:"), method), F.col("external_id")),
        (ORCID, F.lit("orcid"), F.col("orcid")),
        (MEMBER, F.lit("member"), name),
        (LEGACY, F.lit(f"identity:{provider}"), if_external(name)),
        (USERNAME, F.lit("username"), name),
        (PREFIXED, F.lit("username"), if_external(F.concat(F.lit(f"{provider}-"), name))),
        (LOWER_PREFIXED, F.lit("username"), if_external(F.concat(F.lit(f"{provider.lower()}-"), name))),
        (EMAIL, F.lit("email"), F.col("email")),
    )
    return probes.select("probe_id", F.explode(entries).alias("k")).select("probe_id", "k.*")


def maybe_known(asked: DataFrame, owners: DataFrame, on: list[str], maps: int = 256) -> DataFrame:
    """The rows of asked whose key may be one of owners: all that are, and few others as long as owners has far fewer keys than the maps have bits.

    A bitmap of the keys' hashes, `maps` rows of 32768 bits each (1 MB by default, whatever owners holds), goes to all tasks, so that keys that nobody
    has are dropped before they are shuffled. With very many keys it fills up and drops less; what follows joins in any case."""
    return mark_maybe(asked, owners, on, "__maybe", maps).where("__maybe").select(*asked.columns)


def _all_owners(asked: DataFrame, keys: DataFrame, block_rows: int = 16384, cell_probes: int = 16384, task_rows: int = 1 << 27) -> DataFrame:
    """(probe_id, user_id, level) of all owners of the keys that a probe asks for at its first level where anybody has one.

    The result has a row for each probe and owner, which for keys that many share grows with the product of both, so none of it is shuffled or sorted:
    the level is settled by counts of owners, before any is met. A key's owners then lie in blocks of about block_rows, its probes in cells of about
    cell_probes (in 256 of either at most, which hold more then), each in short arrays. Each block meets each cell in one join, which makes the rows as they are read.
    So a probe is shuffled once for each block of its key and an owner once for each cell, 256 times at most. Since the bytes that a task
    reads don't tell how many rows it makes, these are counted, and dealt over as many tasks as give each about task_rows."""
    on, at = ["kind", "key"], ["kind", "key", "block", "cell"]
    owned = cut_lineage(keys.select(*on, "user_id").distinct())
    counts = cut_lineage(owned.groupBy(*on).agg(F.count("*").alias("n_owners")))
    # Dealt by probe once; what follows needs no other order.
    met = maybe_known(asked, counts, on).join(counts, on, "left_semi").repartition("probe_id").distinct()
    of_level = met.withColumn("first", F.min("level").over(Window.partitionBy("probe_id"))).where("level = first")
    settled = cut_lineage(of_level.withColumn("n_keys", F.count("*").over(Window.partitionBy("probe_id", "level"))).drop("first"))
    parts = lambda n, size: F.least(F.ceil(F.col(n) / size), F.lit(256)).cast("int")
    sized = settled.groupBy(*on).agg(F.count("*").alias("n_probes")).join(counts, on)
    wanted = cut_lineage(sized.select(*on, (F.col("n_probes") * F.col("n_owners")).alias("made"), parts("n_owners", block_rows).alias("blocks"), parts("n_probes", cell_probes).alias("cells")))
    made = wanted.agg(F.sum(F.col("made").cast("decimal(38,0)"))).first()[0] or 0
    spark = keys.sparkSession
    # Not fewer than Spark's own, which would deal the arrays once more.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism, min(10_000, int(made) // task_rows))

    place = lambda column, n: F.pmod(F.xxhash64(column), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # The owners of a slice, a multiple of 8, follow one another for each probe of a cell: in a Parquet file they repeat byte for byte, which compresses.
    slices = lambda array, size: F.explode(F.transform(F.sequence(F.lit(0), F.floor((F.size(array) - 1) / size).cast("int")), lambda i: F.slice(array, i * size + 1, size))).alias(array)
    users = owned.join(wanted, on).groupBy(*on, "cells", place("user_id", "blocks").alias("block")).agg(F.collect_list("user_id").alias("users"))
    users = users.select(*on, "block", each("cells").alias("cell"), "users").select(*at, slices("users", 128)).repartition(tasks, *at)
    nameless = F.when(F.max(F.col("probe_id").isNull()), F.array(F.lit(None).cast(asked.schema["probe_id"].dataType))).otherwise(F.array())
    probes = settled.join(wanted, on).groupBy("level", "n_keys", *on, "blocks", place("probe_id", "cells").alias("cell")).agg(F.concat(F.collect_list("probe_id"), nameless).alias("probes"))
    probes = probes.select("level", "n_keys", *on, "cell", each("blocks").alias("block"), "probes").select("level", "n_keys", *at, slices("probes", 256))

    def found(probes: DataFrame) -> DataFrame:
        # A merge join hands on the 32768 rows of a pair of slices at a time; a hash join would hold those of many pairs.
        met = probes.repartition(tasks, *at).join(users.hint("merge"), at)
        return met.select(F.explode("probes").alias("probe_id"), "users", "level").select("probe_id", F.explode("users").alias("user_id"), "level")

    # Only a probe that is repeated with other keys has several at its level, whose owners may be the same.
    return found(probes.where("n_keys = 1")).unionByName(found(probes.where("n_keys > 1")).distinct())


def resolve_identity(probes: DataFrame, keys: DataFrame, provider: str, policy: str = "fallthrough") -> DataFrame:
    """(probe_id, user_id, level) of the probes that resolve; see user_keys for keys.

    policy says what an ambiguous member name means: `fallthrough` goes on to the e-mail (login), `none` gives up (notices:
    only member levels are tried), `all` takes every match (logout: member levels, no deduplication)."""
    if policy not in ("fallthrough", "none", "all"):
        raise ValueError(f"unknown policy {policy}")
    asked = probe_keys(probes, provider)
    if policy != "fallthrough":
        asked = asked.where(F.col("level").isin(list(MEMBER_LEVELS)))
    if policy == "all":
        return _all_owners(asked, keys.where(F.col("kind").isin("member", "username", f"identity:{provider}")))
    owners = keys.select("kind", "key", "user_id").distinct().groupBy("kind", "key").agg(F.count("*").alias("n"), F.min("user_id").alias("user_id"))
    # Dealt by probe once; what follows needs no other order.
    asked = maybe_known(asked, owners, ["kind", "key"])
    hits = asked.join(owners, ["kind", "key"]).select("probe_id", "level", "n", "user_id").repartition("probe_id").distinct()
    # A probe that is repeated with other keys may have several rows at a level.
    counted = hits.groupBy("probe_id", "level").agg(F.greatest(F.max("n"), F.count("*")).alias("n"), F.min("user_id").alias("user_id"))
    of_probe = Window.partitionBy("probe_id")
    many = F.max((F.col("level") == MEMBER) & (F.col("n") > 1)).over(of_probe)
    stopped = F.col("many") & F.col("level").isin(list(MEMBER_LEVELS))
    open_levels = counted.withColumn("many", many).where(~stopped & (F.col("n") == 1))
    rank = F.row_number().over(of_probe.orderBy("level"))
    return open_levels.withColumn("rank", rank).where("rank = 1").select("probe_id", "user_id", "level")


def unique_or_nothing(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) for keys with exactly one row; empty and null keys never match."""
    found = df.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).groupBy(key)
    return found.agg(F.count("*").alias("n"), F.min(value).alias(value)).where("n = 1").select(key, value)


def first_match(left: DataFrame, right: DataFrame, on: list[str], order: list[str]) -> DataFrame:
    """left with the first row of right for its key, nulls where there is none; order breaks ties."""
    rank = F.row_number().over(Window.partitionBy(*on).orderBy(*order))
    first = right.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
    return left.join(first, on, "left")


def by_source_priority(ids: DataFrame, sources: list[tuple[str, DataFrame]], on: str) -> DataFrame:
    """ids with matched_source and the value of the first source that has the id. Each source has `on` and value."""
    from concord.operators.delta import union_all

    ranked = union_all([df.select(on, F.lit(k).alias("rank"), F.lit(name).alias("matched_source"), F.col("value")) for k, (name, df) in enumerate(sources)])
    best = ranked.groupBy(on).agg(F.min(F.struct("rank", "matched_source", "value")).alias("best"))
    return ids.join(best, on, "left").select(*ids.columns, "best.matched_source", "best.value")


def unknown(entities: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    return entities.join(known, on, "left_anti")


def members_of(user_roles: DataFrame, users: DataFrame, role: str) -> DataFrame:
    return user_roles.where(F.col("role") == role).join(users, "user_id")


def roles_of(users: DataFrame, user_roles: DataFrame) -> DataFrame:
    """Roles of the given users; users without roles have a null one."""
    return users.join(user_roles, "user_id", "left")


def roles_asked_for(asked: DataFrame, users: DataFrame, user_roles: DataFrame) -> DataFrame:
    """(user_id, role, error) of the users asked for: a row for each role, one with a null role for a user without roles, and an error for one that is not there."""
    known = asked.select("user_id").distinct().join(users.select("user_id", F.lit(True).alias("known")).distinct(), "user_id", "left")
    held = user_roles.select("user_id", "role").distinct()
    met = known.join(held, "user_id", "left")
    return met.select("user_id", F.when(F.col("known"), F.col("role")).alias("role"), F.when(F.col("known").isNull(), "user not found").alias("error")).distinct()
