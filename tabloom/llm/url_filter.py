"""Allow and block lists over hosts and paths as one broadcast trie."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.common import table

ALLOW, BLOCK = "allow", "block"
MOST_RULES = 1_000_000
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@dataclass
class Node:
    """Children by host label or path segment, and the rules that end here by what is left of their path."""

    children: dict = field(default_factory=dict)
    ends: dict = field(default_factory=dict)


class RuleTrie:
    """Rules (host, path, verdict): a rule fits its host and all subdomains when the path starts with its path.

    The trie goes down the reversed host labels, then the path segments that a
    slash closes. Of all rules that fit, the one with more host labels wins,
    then the longer path; of two equal rules, block.
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]], most: int = MOST_RULES):
        self.root = Node()
        for count, (host, path, verdict) in enumerate(rules, 1):
            if count > most:
                raise ValueError(f"more than {most} rules for one broadcast trie; raise `most` if memory allows")
            if verdict not in (ALLOW, BLOCK):
                raise ValueError(f"unknown verdict {verdict!r}")
            host = host.translate(_LOWER)
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.children.setdefault(("h", label), Node())
            *closed, tail = path.split("/")
            for segment in closed:
                node = node.children.setdefault(("p", segment), Node())
            if node.ends.get(tail, (None, ALLOW))[1] == ALLOW:
                node.ends[tail] = (host + path, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits, or None."""
        hosts, node = [self.root], self.root
        for label in reversed(host.split(".")) if host else ():
            node = node.children.get(("h", label))
            if node is None:
                break
            hosts.append(node)
        segments = path.split("/")
        for node in reversed(hosts):
            best = None
            for k in range(len(segments)):
                left = None
                for tail, found in node.ends.items():
                    if (left is None or len(tail) > len(left)) and "/".join(segments[k:]).startswith(tail):
                        left, best = tail, found
                node = node.children.get(("p", segments[k])) if k < len(segments) - 1 else None
                if node is None:
                    break
            if best:
                return best
        return None


def split_url(url: str | None) -> tuple[str, str]:
    """Host after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; then the path up to `?`, `#` or the end."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    for stop in "?#":
        rest = rest.partition(stop)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def judge_urls(
    pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = ALLOW, id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """(page_id, host, path, rule, verdict): one row per input row, without a shuffle.

    `default` is the verdict where no rule fits; then rule is null. A null url
    or one without `://` has empty host and path, which only rules of empty
    host and path fit. Equal rows give equal rows, an empty table no rows,
    other columns are not looked at. The trie is broadcast; its size is bound
    by `MOST_RULES`, which is checked when it is built.
    """
    shipped = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = shipped.value
        for frame in frames:
            rows = []
            for url in frame["url"]:
                host, path = split_url(url)
                rule, verdict = trie.find(host, path) or (None, default)
                rows.append((host, path, rule, verdict))
            done = pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype=object)
            done.insert(0, "page_id", frame["page_id"].to_numpy())
            yield done

    kind = pages.schema[id_column].dataType.simpleString()
    wanted = pages.select(pages[id_column].alias("page_id"), pages[url_column].cast("string").alias("url"))
    return wanted.mapInPandas(run, f"page_id {kind}, host string, path string, rule string, verdict string")


RULES = [
    ("com", "/", ALLOW),
    ("example.com", "/en/", BLOCK),
    ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK),
    ("net", "/fr/", BLOCK),
]


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), RULES)


QUERIES = {"op8_url_filter": op8_url_filter}

SQL = {
    "op8_url_filter": """
        WITH r(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
               ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        f AS (SELECT page_id, arg_max(r.host || r.path, length(r.host) * 1000 + length(r.path)) AS rule,
                     arg_max(r.verdict, length(r.host) * 1000 + length(r.path)) AS verdict
              FROM s JOIN r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path) GROUP BY page_id)
        SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM s LEFT JOIN f USING (page_id)"""
}
