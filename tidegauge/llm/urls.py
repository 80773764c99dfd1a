"""URL rules in a trie over reversed host labels and path segments.

A rule is a host, a path and a verdict. It fits a URL whose host is the rule's
host or a subdomain of it and whose path starts with the rule's path. Among the
fitting rules the longest (host and path together) wins; of two as long, that of
the longer host; of two with the same host and path, the block entry. URLs that
no rule fits get the default verdict.

Up to ``MOST_RULES`` rules go to every task as a trie. More rules, or rules in a table,
are joined: a URL's host endings and path beginnings are looked up as keys, which gives
the same verdicts.

Null URLs and those without ``://`` have an empty host and path and so fit only
rules without a host. URLs of any length are judged whole. Repeated rows give one row
each; an empty table gives none. A column ``url_verdict`` of the input is replaced; all
others are kept.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

ALLOW, BLOCK = "allow", "block"
#: Rules of the trie, which goes to every executor; this many take some hundred MB.
MOST_RULES = 1_000_000

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``; A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


class RuleTrie:
    """Host labels from the right, then whole path segments, then the start of one.

    A node is a dict of its children; ``None`` holds what ends or goes on there:
    under a host node the root of its paths, under a path node the list of
    (start of the next segment, rule).
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")) if rule.host else ():
                node = node.setdefault(label, {})
            node = node.setdefault(None, {})
            *whole, start = rule.path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            node.setdefault(None, []).append((start, rule))

    def match(self, host: str, path: str) -> Rule | None:
        best, rank = None, None
        segments = path.split("/")
        node = self.root
        labels = iter(reversed(host.split("."))) if host else iter(())
        while node is not None:
            at = node.get(None)
            for segment in segments:
                if at is None:
                    break
                for start, rule in at.get(None, ()):
                    key = (len(rule.host) + len(rule.path), len(rule.host), rule.verdict == BLOCK)
                    if segment.startswith(start) and (rank is None or key > rank):
                        best, rank = rule, key
                at = at.get(segment)
            label = next(labels, None)
            node = node.get(label) if label is not None else None
        return best


def judge_urls(
    pages: DataFrame, rules: list[Rule] | DataFrame, url_col: str = "url", default: str = ALLOW, most_rules: int = MOST_RULES
) -> DataFrame:
    """``pages`` with a struct ``url_verdict`` (host, path, rule, verdict) added.

    ``rules`` is a list, or a table with ``verdict``, ``host`` and ``path``.
    """
    if isinstance(rules, DataFrame):
        return _judge_by_join(pages, rules, url_col, default)
    if len(rules) > most_rules:
        table = pages.sparkSession.createDataFrame(rules, "verdict string, host string, path string")
        return _judge_by_join(pages, table, url_col, default)
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [trie.value.match(h, p) for h, p in zip(hosts, paths)]
        return pd.DataFrame(
            {
                "rule": [r and r.host + r.path for r in found],
                "verdict": [r.verdict if r else default for r in found],
            },
            dtype=object,
        )

    url = F.col(url_col)
    host, path = host_of(url), path_of(url)
    judged = judge(host, path)
    return pages.withColumn(
        "url_verdict",
        F.struct(host.alias("host"), path.alias("path"), judged["rule"].alias("rule"), judged["verdict"].alias("verdict")),
    )


def _judge_by_join(pages: DataFrame, rules: DataFrame, url_col: str, default: str) -> DataFrame:
    pages = pages.drop("url_verdict")
    table = rules.select("verdict", *[F.coalesce(c, F.lit("")).alias(c) for c in ("host", "path")])
    table = table.groupBy("host", "path").agg(F.max(F.col("verdict") == BLOCK).alias("block"))
    # No more numbers than the longest path has characters.
    lengths = sorted(r[0] for r in table.select(F.char_length("path")).distinct().collect())
    url = F.col(url_col)
    rows = pages.select(F.struct("*").alias("page"), host_of(url).alias("url_host"), path_of(url).alias("url_path"))
    # Equal URLs are looked up once.
    labels = F.split("url_host", r"\.")
    endings = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    begun = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.char_length("url_path"))
    keys = rows.select("url_host", "url_path").distinct()
    keys = keys.select("*", F.explode(F.array_distinct(F.concat(endings, F.array(F.lit(""))))).alias("host"))
    keys = keys.select("*", F.explode(F.transform(begun, lambda n: F.substring(F.col("url_path"), F.lit(1), n))).alias("path"))
    size = F.char_length("host") + F.char_length("path")
    best = F.max(F.struct(size, F.char_length("host"), "host", "path", "block")).alias("best")
    found = keys.join(table, ["host", "path"]).groupBy("url_host", "url_path").agg(best)
    joined = rows.join(found, ["url_host", "url_path"], "left")
    verdict = F.when(F.col("best").isNull(), default).when(F.col("best.block"), BLOCK).otherwise(ALLOW)
    judged = F.struct(
        F.col("url_host").alias("host"), F.col("url_path").alias("path"),
        F.concat("best.host", "best.path").alias("rule"), verdict.alias("verdict"),
    )
    return joined.select("page.*", judged.alias("url_verdict"))
