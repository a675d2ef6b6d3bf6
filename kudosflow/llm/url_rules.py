"""URL filter: a trie over reversed host labels and path segments, sent to every task."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from kudosflow.llm.common import fresh, with_answers

_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}

#: The most that the rules may hold, as text; more is refused, since every task gets them.
MAX_BYTES = 256 << 20


class UrlRule(NamedTuple):
    verdict: str
    host: str
    path: str = ""


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    _, sign, rest = (url or "").partition("://")
    if not sign:
        return "", ""
    ends = [at for at in map(rest.find, "/?#") if at >= 0]
    end = min(ends, default=len(rest))
    path = rest[end:]
    for sign in "?#":
        path = path.partition(sign)[0]
    return rest[:end].translate(_LOWER), path


class UrlTrie:
    """Rules by host labels from the right, then by whole path segments.

    A host node holds its children, and for the rules that end there a path tree,
    whose nodes hold children by whole segment and the last, possibly partial,
    segments of the rules that end there.
    """

    def __init__(self, rules: Iterable[UrlRule]) -> None:
        self.root: dict = {}
        for rule in rules:
            if rule.verdict not in ("allow", "block"):
                raise ValueError(f"neither allow nor block: {rule.verdict}")
            node = self.root
            for label in reversed(rule.host.translate(_LOWER).split(".") if rule.host else []):
                node = node.setdefault("labels", {}).setdefault(label, {})
            node = node.setdefault("paths", {})
            *whole, last = rule.path.split("/")
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            ends = node.setdefault("ends", {})
            if ends.get(last, ("allow",))[0] == "allow":  # a rule listed as both blocks
                host = rule.host.translate(_LOWER)
                ends[last] = (rule.verdict, host + rule.path, len(host))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """Verdict and text of the longest rule that fits; of equals, that of the longer host."""
        best, segments = None, path.split("/")
        node, labels = self.root, reversed(host.split("."))
        while node is not None:
            if "paths" in node:
                for end in self._ends(node["paths"], segments):
                    if best is None or (len(end[1]), end[2]) > (len(best[1]), best[2]):
                        best = end
            label = next(labels, None)
            node = node.get("labels", {}).get(label) if label is not None else None
        return best and best[:2]

    @staticmethod
    def _ends(node: dict, segments: list[str]) -> Iterator[tuple]:
        for segment in segments:
            ends = node.get("ends", {})
            if ends:
                most = max(map(len, ends))
                for n in range(min(most, len(segment)) + 1):
                    if segment[:n] in ends:
                        yield ends[segment[:n]]
            node = node.get("segments", {}).get(segment)
            if node is None:
                return


def filter_urls(
    df: DataFrame, rules: Iterable[UrlRule], url: str = "url", default: str = "allow"
) -> DataFrame:
    """Judge every URL by the longest rule that fits its host or a parent, and its path.

    Adds ``host``, ``path``, ``rule`` (None where no rule fits) and ``verdict``, under
    these names or, where the table has them, close ones. A missing or malformed URL
    has an empty host and path and gets the default, unless a rule has no host. The
    URLs are judged where they are read.
    """
    rules = list(rules)
    if (size := sum(len(json.dumps(rule)) for rule in rules)) > MAX_BYTES:
        raise ValueError(f"{size} bytes of rules are too many to send to every task")
    sent = df.sparkSession.sparkContext.broadcast([tuple(rule) for rule in rules])
    new = [fresh(df, name) for name in ("host", "path", "rule", "verdict")]

    def judge():
        trie = UrlTrie(UrlRule(*rule) for rule in sent.value)

        def answers(urls: list[str | None]) -> list[list]:
            parts = [split_url(value) for value in urls]
            found = [trie.find(*part) for part in parts]
            return [
                [part[0] for part in parts],
                [part[1] for part in parts],
                pa.array([hit and hit[1] for hit in found], "string"),
                [hit[0] if hit else default for hit in found],
            ]

        return answers

    return with_answers(df, url, judge, 4096, **dict.fromkeys(new, "string"))


#: The rules of the registered query.
PAGE_RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)

#: The registered query in DuckDB.
ORACLE_SQL = r"""
WITH rests AS (
  SELECT page_id, CASE WHEN contains(url, '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM rests),
rules(verdict, rule_host, rule_path) AS (VALUES
  ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(rules.verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""
