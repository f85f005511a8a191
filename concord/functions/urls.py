"""Redirect safety, path exclusion and link building."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concord.functions.values import filled


def url_part(url: Column, part: str) -> Column:
    return F.try_parse_url(url, F.lit(part))


def local_part(url: Column) -> Column:
    """Path, query and fragment only. Slashes and backslashes before the path become one slash, as browsers take two for the beginning of a host."""
    query, fragment = url_part(url, "QUERY"), url_part(url, "REF")
    return F.concat(
        F.regexp_replace(url_part(url, "PATH"), r"^[/\\]+", "/"),
        F.when(filled(query), F.concat(F.lit("?"), query)).otherwise(""),
        F.when(filled(fragment), F.concat(F.lit("#"), fragment)).otherwise(""),
    )


def _safe(given: Column, hosts: tuple[str, ...]) -> Column:
    url = F.regexp_replace(given, r"[\x00-\x20\x7F]+", "")  # browsers pass over these, wherever they stand
    host, scheme = F.lower(url_part(url, "HOST")), F.lower(F.coalesce(url_part(url, "PROTOCOL"), F.lit("https")))
    web = scheme.isin("http", "https")
    return F.when(filled(url) & web & host.isin([h.lower() for h in hosts]), url).when(filled(url) & web & filled(url_part(url, "PATH")), local_part(url))


def safe_redirect(target: Column, referrer: Column, hosts: tuple[str, ...]) -> Column:
    """target, else referrer: whole where its host is allowed (in any case), its local part otherwise, `/` where neither serves. Addresses of other schemes than http and https don't."""
    return F.coalesce(_safe(target, hosts), _safe(referrer, hosts), F.lit("/")) if hosts else F.lit("/")


def is_excluded(path: Column, mount: Column, prefixes: tuple[str, ...], excluded_mount: str, suffix: str) -> Column:
    starts = [path.startswith(p) for p in prefixes]
    out = (F.rtrim(path, F.lit("/")) == excluded_mount) | (F.coalesce(mount, F.lit("")) == excluded_mount) | path.endswith(suffix)
    for s in starts:
        out = out | s
    return F.coalesce(out, F.lit(False))


def with_query(base: Column, **params: Column) -> Column:
    """base with url-encoded parameters, in the order given, behind the query that it has and before its fragment; null ones are left out."""
    pairs = [F.concat(F.lit(k + "="), F.url_encode(v)) for k, v in params.items()]
    query = F.concat_ws("&", *pairs)
    page, fragment = F.regexp_extract(base, r"^([^#]*)", 1), F.regexp_extract(base, r"^[^#]*((?:#[\s\S]*)?)$", 1)
    joint = F.when(page.rlike(r"[?&]$"), "").when(page.contains("?"), "&").otherwise("?")
    return F.when(query == "", base).otherwise(F.concat(page, joint, query, fragment))
