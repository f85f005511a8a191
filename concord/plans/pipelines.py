"""Whole reconciliations: users, groups, logins, notices, logouts and command-line batches.

Each takes and returns DataFrames and does all its work in batches; nothing is written here. Writers are in concord.sources."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.config import Config
from concord.functions import codec
from concord.functions.names import BITS, LEVELS, RANGE, blocks_of, range_blocks
from concord.functions.times import is_expired
from concord.functions.values import or_else
from concord.operators import apply, delta, groups, notices, overlay, report, resolve
from concord.session import cut_lineage
from concord.sources import schemas, snapshots


class UserSync:
    """What sync_users finds; each result is planned, and the guarded rows computed, once it is asked for."""

    def __init__(self, users: DataFrame, user_roles: DataFrame, requests: DataFrame, profiles: DataFrame, config: Config):
        self._users, self._user_roles, self._config = users, user_roles, config
        one = one_profile(profiles).withColumnRenamed("status", "fetched")
        row = F.struct("username", "email", "active", "preferences", "user_profile")
        met = requests.select("user_id").distinct().join(one, "user_id", "left").join(users.select("user_id", row.alias("old")), "user_id", "left")
        #: user_id of every request, with the remote profile, how it was fetched, and the user's row
        self._asked = met
        self._synced = met.where("old IS NOT NULL AND fetched = 'ok'")

    @cached_property
    def rows(self) -> DataFrame:
        """user_id, old (the row before), and the new row of each user that is synced."""
        config = self._config
        new = self._synced.select("user_id", "old", *overlay.overlaid(F.col("old.preferences"), F.col("old.user_profile"), F.col("profile"), config.member_field))
        asks = new.withColumnsRenamed({"username": "new_username", "email": "new_email"})
        settled = overlay.unique_guard(self._users, asks, ["username", "email"])
        changed = ~F.col("email").eqNullSafe(F.col("old.email"))
        kept = overlay.keep_old_email(F.col("user_profile"), F.col("old.email"), changed, config.old_email_field)
        return cut_lineage(settled.select("user_id", "old", "username", "email", "active", "preferences", kept.alias("user_profile")))

    @cached_property
    def users(self) -> DataFrame:
        return apply.upsert(self._users, self.rows.drop("old"), ["user_id"])

    @cached_property
    def changes(self) -> DataFrame:
        """(id, path, new_value) of the fields that change."""
        flat = lambda side: _flat(lambda c: F.col(f"{side}.{c}" if side else c), self._config)
        return delta.diff_of_pairs(self.rows.select(F.col("user_id").alias("id"), flat("").alias("u"), flat("old").alias("o"), F.lit(True).alias("known")))

    @cached_property
    def memberships(self) -> DataFrame:
        """(user_id, role, change) of the users that are synced."""
        remote = self._synced.select("user_id", "profile.groups", "profile.is_superadmin")
        grants = remote.select("user_id", F.explode("groups").alias("g")).select("user_id", F.col("g.id").alias("group_id"), "g.role")
        granted = delta.remote_roles(grants, self._config.provider, remote.where("is_superadmin").select("user_id"), self._config.superadmin_roles)
        return delta.membership_delta(self._user_roles.join(remote.select("user_id"), "user_id", "left_semi"), granted, self._config.provider)

    @cached_property
    def user_roles(self) -> DataFrame:
        # What a delta says of a local role is what becomes of it, so the local roles themselves are not needed again.
        others = self._user_roles.join(self._synced.select("user_id"), "user_id", "left_anti").select("user_id", "role")
        return others.union(self.memberships.where("change <> 'dropped'").select("user_id", "role")).distinct()

    @cached_property
    def outcomes(self) -> DataFrame:
        """(user_id, bucket) of every request."""
        some = self.changes.select(F.col("id").alias("user_id")).union(self.memberships.where("change <> 'unchanged'").select("user_id"))
        judged = self._asked.join(some.groupBy("user_id").agg(F.count("*").alias("n")), "user_id", "left")
        bucket = report.bucket(F.col("old").isNotNull(), F.coalesce("fetched", F.lit("not_found")), F.coalesce("n", F.lit(0)))
        return judged.select("user_id", bucket.alias("bucket"))


def one_profile(profiles: DataFrame) -> DataFrame:
    """(user_id, profile, status), one row a user: a profile that was read before others, then the first by its status and JSON text."""
    rank = F.struct(F.coalesce(F.col("status") != "ok", F.lit(True)), "status", F.to_json("profile"))
    return profiles.groupBy("user_id").agg(F.min_by(F.struct("profile", "status"), rank).alias("first")).select("user_id", "first.profile", "first.status")


def sync_users(users: DataFrame, user_roles: DataFrame, requests: DataFrame, profiles: DataFrame, config: Config) -> UserSync:
    """New states of users and roles from remote profiles, what changed, and an outcome for each request.

    users: see schemas.USERS, one row a user. requests: user_id. profiles: user_id, profile, status; of several for a user one_profile says which counts. Fields and memberships of one batch
    belong to one new state each, so a user never has one without the other once both are written."""
    return UserSync(users, user_roles, requests, profiles, config)


def _flat(column, config: Config) -> Column:
    """A user's row as a struct of the fields a diff looks at, maps as structs, so that paths are fixed."""
    fields = ("full_name", "name_parts", config.member_field, "affiliations", "identifier_orcid")
    profile = F.struct(*[F.try_element_at(column("user_profile"), F.lit(f)).alias(f) for f in fields])
    shown = F.struct(*[F.try_element_at(column("preferences"), F.lit(f)).alias(f) for f in ("visibility", "email_visibility")])
    return F.struct(*[column(c).alias(c) for c in ("username", "email", "active")], shown.alias("preferences"), profile.alias("user_profile"))


def sync_groups(documents: DataFrame, metadata: DataFrame, instance: str) -> tuple[DataFrame, DataFrame]:
    """The updated documents of groups with exactly one active document, and for each group what was done. metadata: group_id, raw, status."""
    ok = metadata.where("status = 'ok'")
    found = groups.find_documents(documents, instance, ok.select("group_id"), include_deleted=True)
    actions = groups.split_active(found)
    active = found.where(~F.col("is_deleted")).join(actions.where("action = 'update'"), "group_id", "left_semi")
    return overlay.document_overlay(active, ok), metadata.select("group_id", "status").join(actions, "group_id", "left")


def delete_groups(documents: DataFrame, roles: DataFrame, group_ids: DataFrame, instance: str, config: Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents without the groups' active ones marked as theirs, roles without the groups' roles, and the summary of each group."""
    summary = groups.deletion_summary(documents, roles, group_ids, instance, config.provider)
    gone = groups.roles_of_groups(roles, group_ids, config.provider).select("id")
    theirs = groups.find_documents(documents, instance, group_ids).select("id").withColumn("disowned", F.lit(True))
    kept = documents.join(theirs, "id", "left").withColumn("group_id", F.when(F.col("disowned"), F.lit(None)).otherwise(F.col("group_id"))).drop("disowned")
    return kept, apply.delete_roles(roles, gone)[0], summary


@dataclass
class NoticeBatch:
    items: DataFrame
    status: DataFrame


def receive_notices(raw: DataFrame, users: DataFrame, identities: DataFrame, config: Config) -> NoticeBatch:
    """Items and the status of each request. raw: request_id, raw. users: as resolve.user_keys takes them.

    Only an item that is enqueued has a route: none has of a request that is broken, and a request whose body names no known sender has no items."""
    spark: SparkSession = raw.sparkSession
    items = notices.expand_judged(notices.with_sender(raw.select("request_id", "raw"), spark, config), config)
    judged = cut_lineage(items.withColumn("item_id", F.monotonically_increasing_id()))  # numbers that all that follows agrees on
    item = F.col("entity_type").isin("users", "associations")
    member = F.when(F.col("entity_type") == "associations", F.col("kc_id")).otherwise(F.col("id"))
    none = F.lit(None).cast("string")
    probes = judged.where(item & F.col("allowed") & ~F.col("broken")).select(
        F.col("item_id").alias("probe_id"), F.col("auth_method").alias("external_method"), none.alias("external_id"), none.alias("orcid"), member.alias("member_name"), none.alias("email")
    )
    found = resolve.resolve_identity(probes, resolve.user_keys(users, identities, config.member_field), config.provider, "none").select(F.col("probe_id").alias("item_id"), "user_id")
    linked = resolve.first_match(found.join(judged.select("item_id", F.col("auth_method").alias("method")), "item_id"), identities.select("user_id", "method", F.col("id").alias("oauth_id")), ["user_id", "method"], ["oauth_id"])
    met = judged.join(linked.select("item_id", "user_id", "oauth_id"), "item_id", "left").withColumn("known", ~item | F.col("user_id").isNotNull())
    met = cut_lineage(met)  # both results follow from it
    routed = met.withColumn("route", F.when(F.col("allowed") & F.col("known") & ~F.col("broken"), notices.route(F.col("entity_type"), F.col("event"))))
    status = notices.batch_status(met)
    answered = raw.select("request_id").distinct().join(status, "request_id", "left").fillna({"status": 400, "n_enqueued": 0, "n_rejected": 0, "n_unknown": 0})
    return NoticeBatch(routed, answered)


def task_summaries(sync: UserSync, tasks: DataFrame) -> DataFrame:
    """(user_id, bucket, summary): a JSON row for each user task that was run. tasks: user_id, idp, remote_id, kc_username, one row a user.

    The summary has the task's own fields, the user it was completed for (null where nobody was), the roles held afterwards, role changes
    by kind and changed fields by path. A user that was asked for without a task has null fields of it."""
    texts = lambda c: F.array_sort(F.collect_list(c))
    kinds = [texts(F.when(F.col("change") == k, F.col("role"))).alias(k) for k in ("added", "dropped", "unchanged")]
    of_roles = sync.memberships.groupBy("user_id").agg(*kinds)
    of_fields = sync.changes.groupBy(F.col("id").alias("user_id")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("path", "new_value")))).alias("fields"))
    held = sync.user_roles.join(sync.outcomes.select("user_id"), "user_id", "left_semi").groupBy("user_id").agg(texts("role").alias("groups"))
    met = sync.outcomes
    for side in (tasks, of_roles, of_fields, held):
        met = met.join(side, "user_id", "left")
    completed = F.when(F.col("bucket").isin("success", "unchanged"), F.col("user_id"))
    none = F.array().cast("array<string>")
    group_changes = F.struct(*[F.coalesce(k, none).alias(k) for k in ("added", "dropped", "unchanged")])
    fields = F.coalesce("fields", F.create_map().cast("map<string,string>"))
    summary = F.struct("user_id", "idp", "remote_id", "kc_username", completed.alias("completed_user_id"), F.coalesce("groups", none).alias("groups"), group_changes.alias("group_changes"), fields.alias("user_field_changes"))
    return met.select("user_id", "bucket", F.to_json(summary, {"ignoreNullFields": "false"}).alias("summary"))


def associate(requests: DataFrame, identities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New identities and the status of each association request (method, id, user_id)."""
    return apply.link_identities(identities, requests), apply.guarded_links(requests, identities)


@dataclass
class Associations:
    identities: DataFrame
    sync: UserSync
    status: DataFrame


def associate_users(requests: DataFrame, users: DataFrame, user_roles: DataFrame, identities: DataFrame, profiles: DataFrame, config: Config) -> Associations:
    """Links the requested identities to users and syncs the users that were linked or were so already.

    requests: method, id, user_id. users, user_roles and profiles: as sync_users takes them. status: method, id, user_id, status (associated or error) and
    reason (user not found, or identity of another user; else null)."""
    known = requests.select("method", "id", "user_id").join(users.select("user_id", F.lit(True).alias("known")), "user_id", "left")
    links, judged = associate(known.where("known").select("method", "id", "user_id"), identities)
    judged = cut_lineage(judged)
    linked = judged.where("status <> 'error'").select("user_id").distinct()
    owned = judged.withColumn("reason", F.when(F.col("status") == "error", "identity of another user")).withColumn("status", F.when(F.col("status") == "error", "error").otherwise("associated"))
    lost = known.where("known IS NULL").select("method", "id", "user_id", F.lit("error").alias("status"), F.lit("user not found").alias("reason")).distinct()
    return Associations(links, sync_users(users, user_roles, linked, profiles, config), owned.select("method", "id", "user_id", "status", "reason").unionByName(lost))


def broker_login(tokens: DataFrame, secret: str, nonces: DataFrame, users: DataFrame, identities: DataFrame, now, config: Config, method: str | None = None) -> DataFrame:
    """(login_id, status, user_id, level, sub) of sealed tokens (login_id, token): bad_token, expired, bad_nonce, new_user or ok."""
    # The secret comes as a subquery's value, not as a literal, so that neither it nor the key made of it stands in a plan.
    key = tokens.sparkSession.createDataFrame([(secret,)], "secret string").scalar()
    opened = tokens.withColumn("raw", codec.unseal(F.col("token"), key)).withColumn("t", F.from_json("raw", schemas.TOKEN))
    read = opened.select("login_id", "t.*", F.get_json_object("raw", "$.exp").alias("exp_text"))
    good_nonce = nonces.select("nonce").distinct().withColumn("issued", F.lit(True))
    status = F.when(F.col("userinfo").isNull(), "bad_token").when(F.coalesce(is_expired(F.col("exp_text"), F.lit(now)), F.lit(True)), "expired").when(F.col("issued").isNull(), "bad_nonce")
    judged = read.join(good_nonce, "nonce", "left").select(
        "login_id",
        status.alias("status"),
        F.col("userinfo.sub").alias("external_id"),
        F.col("userinfo.orcid").alias("orcid"),
        F.col("kc_username").alias("member_name"),
        or_else(F.col("primary_email"), F.col("userinfo.email")).alias("email"),
    )
    judged = cut_lineage(judged)  # tokens are opened once; what is kept of them is the keys alone
    keys = ("external_id", "orcid", "member_name", "email")
    probes = judged.where("status IS NULL").select(F.col("login_id").alias("probe_id"), F.lit(method or config.aliases[0]).alias("external_method"), *keys)
    found = resolve.resolve_identity(probes, resolve.user_keys(users, identities, config.member_field), config.provider, "fallthrough").withColumnRenamed("probe_id", "login_id")
    status = F.coalesce("status", F.when(F.col("user_id").isNull(), "new_user").otherwise("ok"))
    return judged.join(found, "login_id", "left").select("login_id", status.alias("status"), "user_id", "level", F.col("external_id").alias("sub"))


@dataclass
class Logins:
    users: DataFrame
    identities: DataFrame
    sync: UserSync
    outcomes: DataFrame


def complete_logins(logins: DataFrame, profiles: DataFrame, users: DataFrame, user_roles: DataFrame, identities: DataFrame, config: Config, method: str | None = None) -> Logins:
    """What follows a login that was let in: unknown users are created from their profile, the subject is linked, and the user is synced.

    logins: as broker_login returns them. profiles: sub, profile, status, one row a subject. users: see schemas.USERS.
    outcomes: login_id, user_id and outcome: that of the token where it was refused; created or logged_in; else, for an unknown user
    without a profile, timeout or failure. A sync that fails does not stop a known user's login. A subject that another user owns stays with
    that user. Of several new subjects with one e-mail all become one user, and the first by name of the subject is linked if one link is free."""
    method = method or config.aliases[0]
    logins = cut_lineage(logins.select("login_id", "status", "user_id", "sub"))  # what is let in and what is refused follow from it
    let_in = cut_lineage(logins.where("status IN ('ok', 'new_user')").join(profiles.select("sub", "profile", F.col("status").alias("fetched")), "sub", "left"))
    wanted = let_in.where("status = 'new_user' AND fetched = 'ok'").select("profile.username", "profile.email").distinct()
    created, _ = apply.create_users(users, wanted)
    created = cut_lineage(created)
    fresh = {"preferences": F.create_map().cast("map<string,string>"), "user_profile": F.create_map().cast("map<string,string>")}
    known = users.unionByName(created.withColumns(fresh), allowMissingColumns=True)
    joined = let_in.join(created.select(F.col("email").alias("new_email"), F.col("user_id").alias("new_id")), (F.col("status") == "new_user") & (F.col("fetched") == "ok") & (F.col("profile.email") == F.col("new_email")), "left")
    settled = cut_lineage(joined.withColumn("user_id", F.coalesce("user_id", "new_id")))
    of_user = settled.where("user_id IS NOT NULL AND sub IS NOT NULL")
    links = apply.link_identities(identities, of_user.select(F.lit(method).alias("method"), F.col("sub").alias("id"), "user_id").distinct())
    # A user who comes with several subjects is synced from the first of them that could be read.
    first = F.row_number().over(Window.partitionBy("user_id").orderBy(F.coalesce(F.col("fetched") != "ok", F.lit(True)), "sub"))
    fetched = of_user.select("user_id", "sub", "profile", F.coalesce("fetched", F.lit("not_found")).alias("fetched")).withColumn("n", first).where("n = 1")
    sync = sync_users(known, user_roles, of_user.select("user_id"), fetched.select("user_id", "profile", F.col("fetched").alias("status")), config)
    outcome = F.when(F.col("new_id").isNotNull(), "created").when(F.col("user_id").isNotNull(), "logged_in").when(F.col("fetched") == "timeout", "timeout").otherwise("failure")
    refused = logins.where("status NOT IN ('ok', 'new_user')").select("login_id", F.lit(None).cast("long").alias("user_id"), F.col("status").alias("outcome"))
    return Logins(sync.users, links, sync, settled.select("login_id", "user_id", outcome.alias("outcome")).unionByName(refused))


def logout(requests: DataFrame, users: DataFrame, identities: DataFrame, sessions: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """Sessions that remain, and for each request (request_id, user_name) its status (200 or 404) and the sessions it ended."""
    none = F.lit(None).cast("string")
    probes = requests.select(F.col("request_id").alias("probe_id"), F.lit(config.aliases[0]).alias("external_method"), none.alias("external_id"), none.alias("orcid"), F.col("user_name").alias("member_name"), none.alias("email"))
    found = resolve.resolve_identity(probes, resolve.user_keys(users, identities, config.member_field), config.provider, "all").withColumnRenamed("probe_id", "request_id")
    open_sessions = sessions.groupBy("user_id").agg(F.count("session_id").alias("open"))
    ended = found.join(open_sessions, "user_id", "left").groupBy("request_id").agg(F.coalesce(F.sum("open"), F.lit(0)).alias("n_sessions"))
    status = requests.join(ended, "request_id", "left").select("request_id", F.when(F.col("n_sessions").isNull(), 404).otherwise(200).alias("status"), F.coalesce("n_sessions", F.lit(0)).alias("n_sessions"))
    return sessions.join(found.select("user_id").distinct(), "user_id", "left_anti"), status


def batch_update_ids(items: DataFrame) -> DataFrame:
    """Distinct ids of command-line items (column item) as text: a-b is every number from a to b, all else is itself.

    A range is taken apart level by level, 256 blocks to a block, so that no row holds more than a few thousand numbers however wide it is."""
    none = F.array().cast("array<struct<level:int,block:bigint>>")
    blocks = _ranges(items).select(F.explode("blocks").alias("b")).select("b.level", "b.block").distinct()
    for level in range(LEVELS - 1, 0, -1):
        inner = F.transform(F.sequence(F.lit(0), F.lit((1 << BITS) - 1)), lambda n: F.struct((F.col("level") - 1).alias("level"), (F.shiftleft("block", BITS) + n).alias("block")))
        own = F.array(F.struct("level", "block"))
        blocks = blocks.select(F.explode(F.when(F.col("level") == level, inner).otherwise(F.coalesce(own, none))).alias("b")).select("b.level", "b.block")
    return _single(items).unionByName(blocks.select(F.col("block").cast("string").alias("id"))).distinct()


def _ranges(items: DataFrame) -> DataFrame:
    return items.where(F.col("item").rlike(RANGE)).select(range_blocks(F.col("item")).alias("blocks"))


def _single(items: DataFrame) -> DataFrame:
    return items.where(~F.col("item").rlike(RANGE)).select(F.col("item").alias("id"))


def ids_in_items(ids: DataFrame, items: DataFrame) -> DataFrame:
    """The ids (column id, text) that command-line items ask for. Ranges are not expanded: an id meets the few blocks that hold it."""
    blocks = _ranges(items).select(F.explode("blocks").alias("b")).select("b.level", "b.block").distinct()
    number = F.when(F.col("id").rlike(r"^(0|[1-9]\d{0,17})$"), F.col("id").try_cast("bigint"))
    met = ids.select("id").distinct().select("id", F.explode(blocks_of(number)).alias("b")).select("id", "b.level", "b.block").where("block IS NOT NULL")
    in_range = met.join(blocks, ["level", "block"], "left_semi").select("id")
    return in_range.union(ids.select("id").join(_single(items), "id", "left_semi")).distinct()


def batch_update_targets(ids: DataFrame, identities: DataFrame, sources: list[str], by: str = "user_id") -> DataFrame:
    """ids (id) with the first source that knows them and the user there; by is user_id or external (the identity's own id)."""
    key = F.col("user_id").cast("string") if by == "user_id" else F.col("id")
    tables = [(s, identities.where(F.col("method") == s).select(key.alias("id"), F.struct("user_id", F.col("id").alias("external_id")).alias("value"))) for s in sources]
    return resolve.by_source_priority(ids.select("id"), tables, "id").select("id", "matched_source", "value.user_id", "value.external_id")


def batch_update(items: DataFrame, users: DataFrame, user_roles: DataFrame, identities: DataFrame, profiles: DataFrame, sources: list[str], config: Config, by: str = "user_id", list_missing: bool = True) -> tuple[UserSync, DataFrame]:
    """The sync of the users that command-line items mean, and (id, matched_source, user_id, bucket) of every id.

    items: item. profiles: as sync_users takes them. An id without an identity in any source is not_found_local; the others are in the bucket of their user's sync. Without
    list_missing such ids of ranges are left out, so that the work follows the identities and not the width of the ranges."""
    key = F.col("user_id").cast("string") if by == "user_id" else F.col("id")
    ids = batch_update_ids(items) if list_missing else ids_in_items(identities.where(F.col("method").isin(sources)).select(key.alias("id")), items).union(_single(items)).distinct()
    targets = cut_lineage(batch_update_targets(ids, identities, sources, by))
    sync = sync_users(users, user_roles, targets.where("user_id IS NOT NULL").select("user_id").distinct(), profiles, config)
    met = targets.join(sync.outcomes, "user_id", "left")
    return sync, met.select("id", "matched_source", "user_id", F.coalesce("bucket", F.lit("not_found_local")).alias("bucket"))
