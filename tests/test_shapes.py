"""Differences and merges of JSON of any shape, against the rules applied to Python objects."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from concord.functions.values import symmetric_difference
from concord.operators import shapes


def same(a, b):
    return json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True)


def lacking(some, other):
    return [x for x in some if not any(same(x, y) for y in other)]


def diff(old, new):
    if not old:
        return new
    out = {}
    for k, v in new.items():
        o = old.get(k)
        if isinstance(v, dict):
            out[k] = diff(o if isinstance(o, dict) else {}, v)
        elif isinstance(v, list):
            o = o if isinstance(o, list) else []
            out[k] = lacking(v, o) + lacking(o, v)
        elif not same(o, v):
            out[k] = v
    return {k: v for k, v in out.items() if v}


def merge(base, extra):
    out = dict(base)
    for k, v in extra.items():
        o = out.get(k)
        if isinstance(v, dict):
            out[k] = merge(o, v) if isinstance(o, dict) else (v if v or k not in out else o)
        elif isinstance(v, list):
            out[k] = (o if isinstance(o, list) else []) + v
        else:
            out[k] = v
    return out


def leaves(value, path=()):
    if isinstance(value, dict) and (value or not path):
        return [x for k, v in value.items() for x in leaves(v, (*path, k))]
    return [(path, json.dumps(value, sort_keys=True, separators=(",", ":")))]


def anything(rng, depth):
    kind = rng.random()
    if depth and kind < 0.4:
        return {rng.choice(["a", "b", "c d", 'q"x', "e.f"]): anything(rng, depth - 1) for _ in range(rng.randrange(4))}
    if depth and kind < 0.55:
        return [anything(rng, min(1, depth - 1)) for _ in range(rng.randrange(4))]
    return rng.choice([None, "", 0, False, True, 1, 2, "x", "y", "5", 1.5])


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(4)
    made = [({k: anything(rng, 3) for k in "xyz"[: rng.randrange(4)]}, {k: anything(rng, 3) for k in "xyz"}) for _ in range(150)]
    return [*made, ({}, {}), ({"a": {"b": {"c": {"d": {"e": 1}}}}}, {"a": {"b": {"c": {"d": {"e": 2, "f": []}}}}})]


def frames(spark, pairs):
    return [spark.createDataFrame([(i, json.dumps(p[side])) for i, p in enumerate(pairs)], "id long, body string") for side in (0, 1)]


def test_diff_of_any_shape(spark, pairs):
    old, new = frames(spark, pairs)
    found = shapes.shape_diff(old, new, "id", "body").collect()
    wanted = [(i, *leaf) for i, (o, n) in enumerate(pairs) for leaf in leaves(diff(o, n))]
    assert sorted((r["id"], tuple(r["path"]), r["new_value"]) for r in found) == sorted(wanted)


def test_merge_of_any_shape(spark, pairs):
    base, extra = frames(spark, pairs)
    merged = shapes.shape_merge(base, extra, "id", "body")
    wanted = {i: merge(b, e) for i, (b, e) in enumerate(pairs)}
    assert sorted((r["id"], tuple(r["path"]), r["value"]) for r in merged.collect()) == sorted((i, *leaf) for i, v in wanted.items() for leaf in leaves(v))
    rebuilt = {r["id"]: json.loads(r["value"]) for r in shapes.rebuild(merged, "value").collect()}
    assert rebuilt == {i: v for i, v in wanted.items() if v}


def test_odd_sides(spark):
    df = lambda *rows: spark.createDataFrame(list(rows), "id long, body string")
    old = df((1, None), (2, "no json"), (3, '{"a": 1, "a": 2}'), (4, '{"a": 1}'), (5, '{"a": 1, "b": 2}'))
    new = df((1, '{"a": null}'), (2, '{"a": 0}'), (3, '{"a": {}}'), (4, "[1]"), (5, '{"a": null, "b": 2.0}'), (6, '{"n": []}'), (7, None))
    found = lambda **kw: sorted((r["id"], r["path"][0], r["new_value"]) for r in shapes.shape_diff(old, new, "id", "body", **kw).collect())
    assert found() == [(1, "a", "null"), (2, "a", "0"), (3, "a", "{}"), (6, "n", "[]")]
    assert found(keep_falsy=True) == [(1, "a", "null"), (2, "a", "0"), (3, "a", "{}"), (5, "a", "null"), (6, "n", "[]")]
    assert shapes.shape_diff(old.limit(0), new.limit(0), "id", "body").count() == 0
    assert sorted(r["id"] for r in shapes.shape_merge(old, new, "id", "body").collect()) == [1, 2, 3, 4, 5, 5, 6]
    assert shapes.rebuild(shapes.shape_merge(old.limit(0), new.limit(0), "id", "body"), "value").count() == 0


def test_long_lists(spark):
    """Lists of 100 000 elements; with repeats the order and the repeats stay."""
    row = spark.range(1).select(F.expr("transform(sequence(1, 100000), x -> cast(x as string))").alias("u"), F.expr("transform(sequence(100000, 2, -1), x -> cast(x as string))").alias("o"))
    assert row.select(symmetric_difference(F.col("u"), F.col("o"))).first()[0] == ["1"]
    few = row.select(F.concat("u", F.array(F.lit("new"), F.lit("new"))).alias("u"), F.concat("o", F.array(F.lit("7"))).alias("o"))
    assert few.select(symmetric_difference(F.col("u"), F.col("o"))).first()[0] == ["1", "new", "new"]
    odd = spark.sql("SELECT array('b', 'a', null, 'b', 'c') AS u, array('c', 'd', 'd', null) AS o")
    assert odd.select(symmetric_difference(F.col("u"), F.col("o"))).first()[0] == ["b", "a", "b", "d", "d"]


def test_numbers_nulls_and_repeats(spark):
    """Numbers in their shortest form at every depth; null and repeated ids; keys of any text."""
    df = lambda *rows: spark.createDataFrame(list(rows), "id long, body string")
    old = df((1, '{"a": {"x": 1e2, "y": 1.50, "z": 1e10}}'), (2, '{"a": [1.0, {"b": 1e2, "c": null}, null]}'), (2, '{"a": 5}'), (None, '{"a": 1}'), (4, '{"a\'b\\"c]": {"": 0}}'))
    new = df((1, '{"a": {"x": 100, "y": 1.5, "z": 1.0E10, "n": null, "e": 1E400}}'), (2, '{"a": [{"c": null, "b": 100.0}, null, 2]}'), (None, '{"a": 2}'), (None, '{"b": {"c": -0.0, "d": 100.0}}'), (4, '{"a\'b\\"c]": {"": {"": 2e0}}}'))
    found = sorted((str(r["id"]), "/".join(r["path"]), r["new_value"]) for r in shapes.shape_diff(old, new, "id", "body").collect())
    assert found == [("1", "a/e", '"Infinity"'), ("2", "a", '[2,1]'), ("2", "a", '[{"b":100,"c":null},null,2]'), ("4", "a'b\"c]//", "2"), ("None", "a", "2"), ("None", "b/c", "0"), ("None", "b/d", "100")]


def test_rows_of_a_large_object_hold_their_own_values_alone(spark):
    """Neither the maps nor the texts of an object go with each of its members."""
    body = lambda n: spark.range(n).select(F.lit(1).alias("id"), F.concat(F.lit("k"), "id").alias("k"), F.to_json(F.struct(F.col("id").alias("x"))).alias("v"))
    whole = lambda n: body(n).groupBy("id").agg(F.concat(F.lit("{"), F.array_join(F.collect_list(F.concat(F.lit('"'), "k", F.lit('":'), "v")), ","), F.lit("}")).alias("body"))
    pairs = shapes._sides(whole(20), whole(30), "id", "body", "body", "left")
    plan = shapes._opened(pairs, True)._jdf.queryExecution().optimizedPlan().toString()
    (generate,) = [line for line in plan.splitlines() if "Generate" in line]
    assert "map_zip_with" in generate and "map_keys" not in plan
    assert shapes.shape_diff(whole(10), whole(20), "id", "body").count() == 10
