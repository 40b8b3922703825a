"""URL filters by a trie over reversed host labels and path segments (operator 6).

A rule is a verdict with a host and a path that starts with a slash. It fits a url whose host is the rule's or a subdomain of
it and whose path starts with the rule's. Hosts are walked label by label from the last one; at the rule's host a second
walk goes over the segments of the path, where a rule's last segment may be the beginning of the url's. Of all fitting rules
the longest wins: the deepest host, then the longest path; of two rules for the same host and path the block entry.

The rules (the operator's argument) are the only thing broadcast; more than ``MAX_RULES`` raise. The walk costs the length
of the url, not the number of rules.

Cases: a null url, or one without ``://``, has an empty host and path and no rule; verdicts without a rule are ``default``;
repeated rows get equal results; long urls are read whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

MAX_RULES = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)


class _Node:
    __slots__ = ("labels", "paths")

    def __init__(self):
        self.labels: dict[str, _Node] = {}
        self.paths: _Path | None = None


class _Path:
    """A place between two segments: ``last`` holds the rules that end here, by their last (perhaps empty) segment."""

    __slots__ = ("last", "segments")

    def __init__(self):
        self.segments: dict[str, _Path] = {}
        self.last: dict[str, tuple[str, str]] = {}


class RuleTrie:
    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        """rules: (verdict, host, path)."""
        self.root = _Node()
        for n, (verdict, host, path) in enumerate(rules):
            if n >= MAX_RULES:
                raise ValueError(f"more than {MAX_RULES} rules")
            if verdict not in ("allow", "block") or not host or not path.startswith("/"):
                raise ValueError(f"bad rule: {(verdict, host, path)}")
            host = host.translate(_FOLD)
            node = self.root
            for label in reversed(host.split(".")):
                node = node.labels.setdefault(label, _Node())
            at = node.paths = node.paths or _Path()
            *inner, last = path[1:].split("/")
            for s in inner:
                at = at.segments.setdefault(s, _Path())
            if at.last.get(last, ("", ""))[1] != "block":
                at.last[last] = (host + path, verdict)

    @staticmethod
    def _under(at: _Path, path: str) -> tuple[str, str] | None:
        """The rule with the longest path that the url's path starts with."""
        found = None
        if not path.startswith("/"):
            return None
        for s in path[1:].split("/"):
            if at.last:
                found = next((at.last[s[:n]] for n in range(len(s), -1, -1) if s[:n] in at.last), found)
            at = at.segments.get(s)
            if at is None:
                break
        return found

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits."""
        node, found = self.root, None
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            if node.paths:
                found = self._under(node.paths, path) or found
        return found


def split_url(url) -> tuple:
    """Column expressions for a url's host and path."""
    rest = F.when(F.locate("://", url) > 0, F.substring_index(F.regexp_replace(url, r"(?s)^.*?://", ""), "#", 1)).otherwise(F.lit(""))
    rest = F.coalesce(F.substring_index(rest, "?", 1), F.lit(""))
    host = F.substring_index(rest, "/", 1)
    return F.translate(host, _UPPER, _LOWER), F.substring(rest, F.char_length(host) + 1, F.lit(2**31 - 1))


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    spark = pages.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(RuleTrie(list(rules)))

    def matched(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = sent.value
        for hosts, paths in batches:
            got = [trie.match(h, p) or (None, default) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(got, columns=["rule", "verdict"])

    matched.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    host, path = split_url(F.col("url"))
    d = pages.select("page_id", host.alias("host"), path.alias("path"))
    d = d.withColumn("m", F.pandas_udf(matched, "rule string, verdict string")("host", "path"))
    return d.select("page_id", "host", "path", "m.rule", "m.verdict")
