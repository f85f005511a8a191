from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from concord.functions import codec, names, times, urls, values


def one(spark, column, **row):
    kinds = ", ".join(f"{k} {kind}" for k, (_, kind) in row.items()) or "x int"
    data = [tuple(v for v, _ in row.values()) or (1,)]
    return spark.createDataFrame(data, kinds).select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(("first", "second", "out"), [("a", "b", "a"), ("", "b", "b"), (None, "b", "b"), ("", None, None)])
def test_or_else(spark, first, second, out):
    assert one(spark, values.or_else(F.col("a"), F.col("b")), a=(first, "string"), b=(second, "string")) == out


@pytest.mark.parametrize(("raw", "out"), [('{"orcid": null}', True), ('{"x": 1}', False), ("no json", False), (None, False)])
def test_has_key(spark, raw, out):
    assert one(spark, values.has_key(F.col("raw"), "orcid"), raw=(raw, "string")) is out


@pytest.mark.parametrize(
    ("value", "kind", "out"),
    [("", "string", False), ("0", "string", True), (0, "int", False), (2, "int", True), (False, "boolean", False), ([], "array<int>", False), ([0], "array<int>", True), (None, "double", False)],
)
def test_truthy(spark, value, kind, out):
    assert one(spark, values.truthy(F.col("v"), kind), v=(value, kind)) is out


def test_symmetric_difference_keeps_order_and_repeats(spark):
    out = one(spark, values.symmetric_difference(F.col("u"), F.col("o")), u=(["a", "b", "b", None, "c"], "array<string>"), o=(["c", "d", "d"], "array<string>"))
    assert out == ["a", "b", "b", "d", "d"]


def test_role_names(spark):
    assert one(spark, names.role_name("p", F.col("g"), F.lit("admin")), g=("1000576", "string")) == "p---1000576|admin"
    provider, group, role = (one(spark, c, n=("p---1000576|admin", "string")) for c in names.role_parts(F.col("n")))
    assert (provider, group, role) == ("p", "1000576", "admin")


@pytest.mark.parametrize(("role", "out"), [("p---1|member", True), ("p", True), ("pq---1|member", False), ("admin", False)])
def test_managed_roles(spark, role, out):
    assert one(spark, names.is_managed(F.col("r"), "p"), r=(role, "string")) is out


def test_group_search_is_literal(spark):
    assert one(spark, names.of_group(F.col("r"), "p", F.lit("1_0")), r=("p---1_0|member", "string")) is True
    assert one(spark, names.of_group(F.col("r"), "p", F.lit("1_0")), r=("p---110|member", "string")) is False


def test_strip_provider_leaves_the_dash(spark):
    assert one(spark, names.strip_provider(F.col("u"), "pRovider"), u=("Provider-alice", "string")) == "-alice"


@pytest.mark.parametrize(("item", "out"), [("3-5", ["3", "4", "5"]), ("7", ["7"]), ("5-3", []), ("1-2-3", ["1-2-3"]), ("bob", ["bob"])])
def test_number_range(spark, item, out):
    assert one(spark, names.number_range(F.col("i")), i=(item, "string")) == out


@pytest.mark.parametrize(("header", "out"), [("Bearer abc", "abc"), ("  Bearer  a b ", "a b"), ("Bearer ", None), ("Basic x", None), (None, None)])
def test_bearer(spark, header, out):
    assert one(spark, names.bearer(F.col("h")), h=(header, "string")) == out


@pytest.mark.parametrize(("exp", "now", "out"), [("12.7", "12", False), ("11.9", "12", True), ("12", "12.9", False), ("x", "12", None), (None, "12", None)])
def test_expiry_truncates(spark, exp, now, out):
    assert one(spark, times.is_expired(F.col("e"), F.col("n")), e=(exp, "string"), n=(now, "string")) is out


@pytest.mark.parametrize(("cookie", "out"), [("100", True), ("701.5", False), ("700.9", True), ("x", True), (None, True)])
def test_cookie(spark, cookie, out):
    assert one(spark, times.is_ready(F.col("c"), F.lit("1000"), 300), c=(cookie, "string")) is out


@pytest.mark.parametrize(
    ("target", "referrer", "out"),
    [
        ("https://ok.org/a?b=c#d", None, "https://ok.org/a?b=c#d"),
        ("https://evil.org/a?b=c#d", None, "/a?b=c#d"),
        ("//evil.org/p", None, "/p"),
        ("https://evil.org", "https://ok.org/x", "https://ok.org/x"),
        (None, None, "/"),
        ("ht tp://bad url", None, "/"),
    ],
)
def test_safe_redirect(spark, target, referrer, out):
    assert one(spark, urls.safe_redirect(F.col("t"), F.col("r"), ("ok.org",)), t=(target, "string"), r=(referrer, "string")) == out


def test_safe_redirect_without_hosts(spark):
    assert one(spark, urls.safe_redirect(F.col("t"), F.col("t"), ()), t=("https://ok.org/a", "string")) == "/"


@pytest.mark.parametrize(("path", "mount", "out"), [("/api/x", "", True), ("/api/", None, True), ("/records", "/api", True), ("/records", "", False), ("/a/sso/cb", None, True), (None, None, False)])
def test_excluded(spark, path, mount, out):
    assert one(spark, urls.is_excluded(F.col("p"), F.col("m"), ("/api/",), "/api", "/sso/cb"), p=(path, "string"), m=(mount, "string")) is out


def test_with_query(spark):
    assert one(spark, urls.with_query(F.lit("/x"), a=F.lit("b c"), d=F.lit(None).cast("string"), e=F.lit("&"))) == "/x?a=b+c&e=%26"


def test_codec_round_trip_and_wrong_key(spark):
    sealed = codec.seal(F.col("t"), F.lit("secret"))
    assert one(spark, codec.unseal(sealed, F.lit("secret")), t=("grüße", "string")) == "grüße"
    assert one(spark, codec.unseal(sealed, F.lit("other")), t=("grüße", "string")) is None
    assert one(spark, codec.unseal(F.lit("!! no token"), F.lit("secret"))) is None
    assert not set(one(spark, sealed, t=("x" * 200, "string"))) & set("+/\r\n")


def test_codec_reads_a_token_of_another_tool(spark):
    """Made with openssl: AES-256-CBC under the SHA-256 of 'a secret', the initial vector 00 01 … 0f in front."""
    assert one(spark, codec.unseal(F.lit("AAECAwQFBgcICQoLDA0ODwcvyV92ovhw_i3-TnBvHjI="), F.lit("a secret"))) == '{"sub": "ann"}'


@pytest.mark.parametrize("low, high", [(0, 0), (5, 4), (1, 300), (255, 256), (256, 65_791), (70_000, 70_000), (1, 70_123), (123_456, 9_876_543)])
def test_range_blocks_hold_the_range(spark, low, high):
    """Each number once, and no other: blocks don't overlap, and hold as many numbers as the range."""
    blocks = sorted((b["block"] << 8 * b["level"], 1 << 8 * b["level"]) for b in one(spark, names.range_blocks(F.col("i")), i=(f"{low}-{high}", "string")))
    at = low
    for start, width in blocks:
        assert start == at
        at += width
    assert at == max(high + 1, low)


def test_wide_ranges_have_few_blocks(spark):
    assert len(one(spark, names.range_blocks(F.col("i")), i=("1-999999999999999999", "string"))) < 4000
    assert one(spark, names.range_blocks(F.col("i")), i=("1-x", "string")) is None
    held = {(b["level"], b["block"]) for b in one(spark, names.blocks_of(F.col("n")), n=(66_000, "long"))}
    assert held & {(b["level"], b["block"]) for b in one(spark, names.range_blocks(F.col("i")), i=("1-3000000000", "string"))} and len(held) == 8


def test_groups_that_a_name_may_mean(spark):
    of = lambda name: sorted(one(spark, names.groups_named(F.col("n"), "p.q"), n=(name, "string")))
    assert of("p.q---1|a") == ["1"] and of("x p.q---1|see p.q---2|b") == sorted(["1", "1|see p.q---2", "2"])
    assert of("pxq---1|a") == of("p.q---1") == of("") == []


@pytest.mark.parametrize(
    "target, out",
    [("https://evil.org//evil.com/p", "/evil.com/p"), ("https://evil.org/\\evil.com", "/"), ("HTTP://OK.ORG/a", "HTTP://OK.ORG/a"), ("data:text/html,x", "/"), ("https://x.org/\n/evil.com", "/evil.com"), ("///evil.com/", "/evil.com/"), ("https://ok.org@evil.com/q", "/q")],
)
def test_redirects_stay_here(spark, target, out):
    assert one(spark, urls.safe_redirect(F.col("t"), F.lit(None).cast("string"), ("ok.org",)), t=(target, "string")) == out


def test_query_goes_before_the_fragment(spark):
    assert one(spark, urls.with_query(F.lit("https://x/#f?next=b"), a=F.lit("c"))) == "https://x/?a=c#f?next=b"


def test_provider_is_no_pattern(spark):
    assert one(spark, names.strip_provider(F.col("u"), "a.b"), u=("axb A.B", "string")) == "axb "
