"""A bitmap of keys that all tasks hold, which tells rows whose key is surely in no other table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mark_maybe(asked: DataFrame, owners: DataFrame, on: list[str], name: str, maps: int = 256) -> DataFrame:
    """asked with a flag `name`: false only where no row of owners has the key, and true for few others as long as owners has far fewer keys than the maps have bits.

    The bitmap of the keys' hashes is `maps` rows of 32768 bits each (1 MB by default, whatever owners holds)."""
    place = F.pmod(F.xxhash64(*on), F.lit(maps * 32768))
    at, bit = F.shiftright(place, 15).cast("int"), place.bitwiseAND(F.lit(32767)).cast("int")
    built = owners.select(at.alias("__at"), bit.alias("__bit")).groupBy("__at").agg(F.bitmap_construct_agg("__bit").alias("__map"))
    byte = F.conv(F.hex(F.substring("__map", F.shiftright("__bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
    shift = F.col("__bit").bitwiseAND(F.lit(7))
    met = asked.withColumns({"__at": at, "__bit": bit}).join(F.broadcast(built), "__at", "left")
    found = F.coalesce(F.call_function("shiftright", byte, shift).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return met.select(*asked.columns, found.alias(name))
