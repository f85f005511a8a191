"""URL allow and block lists as a broadcast trie (operator 7).

Each list entry is a host and a path. Entries live in one trie: first the host's labels from the right, then
the path's segments. A url walks its own labels and segments down the trie once, and the deepest entry met decides,
whether it allows or blocks: more host labels win first, then a longer path. The lists are configuration, so the trie
is small; building it refuses more than `most_rules` entries, which bounds what is broadcast. Lists of any length are judged as a table, by
`judge_by_table`: the same walk as two equality joins over distinct urls, first from each suffix of the host to the lengths of the paths that entries of that host have, then
from host and that much of the path to the entry.

An entry fits its host and all subdomains when the url's path starts with the entry's path, in characters: the last
part of an entry's path may end inside a segment (`/en` fits `/english`, `/en/` does not fit `/en`).

Cases: a null url, or one without `://`, has an empty host and path, fits no entry and gets the default verdict. Repeated
rows are judged alike. A very long url is walked as deep as the trie goes. Of entries that fit, none tie: the longest host and then the longest path decide. An empty table gives an empty result. Columns other than the id and the url are ignored. An entry
given twice must have one verdict.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


class UrlTrie:
    """Nodes are dictionaries; "labels" and "segments" lead on, "path" leads from a host to its paths, "starts" has what entries end with."""

    def __init__(self, rules: Iterable[tuple[str, str, str]], most_rules: int = 200_000):
        self.root: dict = {}
        for n, (host, path, verdict) in enumerate(rules, 1):
            if n > most_rules:
                raise ValueError(f"more than {most_rules} entries: give them as a table to judge_by_table")
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            node = node.setdefault("path", {})
            *whole, last = path.split("/")
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            node["longest"] = max(node.get("longest", 0), len(last))
            old = node.setdefault("starts", {}).setdefault(last, (host + path, verdict))
            if old != (host + path, verdict):
                raise ValueError(f"entry {host + path} has two verdicts")

    @staticmethod
    def _longest_path(node: dict, path: str) -> tuple[str, str] | None:
        best, segments = None, path.split("/")
        for i, segment in enumerate(segments):
            starts = node.get("starts", {})
            fits = next((segment[:k] for k in range(min(len(segment), node.get("longest", 0)), -1, -1) if segment[:k] in starts), None)
            best = best if fits is None else starts[fits]
            if i == len(segments) - 1 or (node := node.get("segments", {}).get(segment)) is None:
                break
        return best

    def judge(self, host: str, path: str) -> tuple[str, str] | None:
        """Rule text and verdict of the longest entry that fits, or None."""
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            if "path" in node and (found := self._longest_path(node["path"], path)):
                best = found
        return best


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased and path, by the position of `://`, `/`, `?` and `#`; empty where there is no `://`."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule (null where none fits) and verdict of every row."""
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        known = trie.value
        for hosts, paths in parts:
            found = [known.judge(h, p) or (None, default) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(found, columns=["rule", "verdict"])

    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    return split.withColumn("found", judge("host", "path")).select("page_id", "host", "path", "found.rule", "found.verdict")


def judge_by_table(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """As judge_urls, for rules as a table (host, path, verdict) of any size; nothing of it goes to the driver or to all tasks."""
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    two = F.raise_error(F.concat(F.lit("entry has two verdicts: "), "rule_host", "rule_path"))
    entries = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict").groupBy("rule_host", "rule_path")
    entries = entries.agg(F.min("verdict").alias("verdict"), F.max("verdict").alias("other")).withColumn("verdict", F.when(F.col("verdict") != F.col("other"), two).otherwise(F.col("verdict"))).drop("other")
    lengths = entries.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.struct(F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("rule_host"), (F.size(labels) - k).alias("depth")))
    urls = split.select("host", "path").distinct()
    met = urls.select("host", "path", F.explode(suffixes).alias("s")).select("host", "path", "s.rule_host", "s.depth").join(lengths, "rule_host")
    asked = met.select("host", "path", "rule_host", "depth", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n")).withColumn("rule_path", F.expr("substring(path, 1, n)"))
    fits = asked.join(entries, ["rule_host", "rule_path"]).groupBy("host", "path").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), F.struct("depth", "n")).alias("best"))
    return split.join(fits, ["host", "path"], "left").select("page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op7_url_trie(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES)


ORACLE = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), judged AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/' END AS rule
  FROM split
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM judged
"""
