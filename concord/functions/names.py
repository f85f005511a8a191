"""Role names, prefixed user names, lock keys, headers and number ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concord.functions.values import let

SEPARATOR = "---"


def role_name(provider: str, group_id: Column, role: Column) -> Column:
    return F.concat(F.lit(provider + SEPARATOR), group_id.cast("string"), F.lit("|"), role)


def role_parts(name: Column) -> tuple[Column, Column, Column]:
    """Provider, group id and role of a role name; null where the name has another form."""
    part = lambda k: F.nullif(F.regexp_extract(name, r"^(.*?)---([^|]*)\|(.*)$", k), F.lit(""))
    return part(1), part(2), part(3)


def is_managed(name: Column, provider: str) -> Column:
    """Whether the text before the separator is the provider; a bare provider name counts."""
    return F.split(name, SEPARATOR, -1)[0] == provider


def of_group(name: Column, provider: str, group_id: Column) -> Column:
    """Whether a role belongs to a group, whatever the role; the text is taken literally."""
    return name.contains(F.concat(F.lit(provider + SEPARATOR), group_id.cast("string"), F.lit("|")))


def strip_provider(user: Column, provider: str) -> Column:
    """The user name without the provider's name, in any case; what stood around it stays."""
    return F.regexp_replace(user, "(?i)" + quoted(provider), "")


def quoted(text: str) -> str:
    """A pattern that matches the text itself."""
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def groups_named(name: Column, provider: str) -> Column:
    """Every group id that a role's name may mean: what stands between the provider's name with the separator, anywhere in it, and any `|` after that."""
    start = provider + SEPARATOR
    parts = F.split(name, quoted(start), -1)
    tails = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k + 1, F.size(parts)), start))
    ends = lambda tail: let(F.split(tail, r"\|", -1), lambda p: F.transform(F.sequence(F.lit(1), F.size(p)), lambda m: F.when(m < F.size(p), F.array_join(F.slice(p, 1, m), "|"))))
    return F.array_distinct(F.array_compact(F.flatten(F.transform(tails, ends))))


def lock_key(*parts: Column) -> Column:
    return F.concat_ws(":", *parts)


def bearer(header: Column) -> Column:
    """The token of an authorization header, null where there is none."""
    return F.nullif(F.trim(F.regexp_extract(header, r"^\s*Bearer\s+(.*)$", 1)), F.lit(""))


def number_range(item: Column) -> Column:
    """The ids an item stands for, in one array: a-b is every number from a to b, all else is itself. An empty range has none. For ranges of any width see range_blocks."""
    low, high = (F.regexp_extract(item, r"^(\d+)-(\d+)$", k).try_cast("bigint") for k in (1, 2))
    numbers = F.when(low <= high, F.transform(F.sequence(low, high), lambda n: n.cast("string"))).otherwise(F.array().cast("array<string>"))
    return F.when(item.rlike(r"^\d+-\d+$"), numbers).otherwise(F.array(item))


RANGE = r"^(\d{1,18})-(\d{1,18})$"
#: Blocks of 256 ** level numbers, so that eight levels hold every number of 18 digits.
BITS, LEVELS = 8, 8


def range_blocks(item: Column) -> Column:
    """The blocks (level, block) that make up the range a-b: some thousand at most, however wide it is. Null for an item that is no range, none for an empty one."""
    low, end = F.regexp_extract(item, RANGE, 1).try_cast("bigint"), F.regexp_extract(item, RANGE, 2).try_cast("bigint") + 1
    first = [F.shiftright(low + ((1 << BITS * k) - 1), BITS * k) for k in range(LEVELS)]  # the first block that starts in the range
    stop = [F.shiftright(end, BITS * k) for k in range(LEVELS)]  # the first that doesn't end in it
    found = []
    for k in range(LEVELS):
        blocks = lambda a, b, k=k: F.when(a < b, F.transform(F.sequence(a, b - 1), lambda n: F.struct(F.lit(k).alias("level"), n.alias("block"))))
        if k + 1 == LEVELS:
            found.append(blocks(first[k], stop[k]))
            continue
        # What blocks of the next level hold is left to them.
        inner = first[k + 1] < stop[k + 1]
        held, behind = F.when(inner, F.shiftleft(first[k + 1], BITS)).otherwise(stop[k]), F.when(inner, F.shiftleft(stop[k + 1], BITS)).otherwise(stop[k])
        found += [blocks(first[k], held), blocks(behind, stop[k])]
    none = F.array().cast("array<struct<level:int,block:bigint>>")
    return F.when(item.rlike(RANGE), F.concat(*[F.coalesce(f, none) for f in found]))


def blocks_of(number: Column) -> Column:
    """The blocks (level, block) that hold a number."""
    return F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(number, BITS * k).alias("block")) for k in range(LEVELS)])
