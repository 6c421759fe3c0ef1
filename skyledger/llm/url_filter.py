"""URL verdicts from a trie over reversed host labels and path segments.

Rules are (host, path, verdict). The trie's upper levels are host labels from
the last one on, its lower levels path segments; a rule's last segment is a
prefix of the page's. One walk down the labels of a host, with one walk down
the path at each label that has rules, meets every rule that fits. Of these the
longest wins, whatever its verdict; where none fits, the default holds.

The trie travels to the tasks as a broadcast of at most ``block_chars``
characters of rules. A longer list is cut into blocks, whose tries are applied
one after another, each pass keeping the longest rule so far.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.inputs import pick, stored

ALLOW, BLOCK = "allow", "block"
BLOCK_CHARS = 8_000_000


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# fixed values: the rules of the registered query
RULES = (
    Rule("org", "/", ALLOW),
    Rule("example.org", "/es/", BLOCK),
    Rule("example.org", "/en/1", BLOCK),
    Rule("com", "/fr/", ALLOW),
    Rule("com", "/de/", BLOCK),
)


@dataclass
class Node:
    """A host label or a path segment: what follows it, and the rules whose last segment begins below it."""

    labels: dict[str, Node] = field(default_factory=dict)
    segments: dict[str, Node] = field(default_factory=dict)
    endings: dict[str, int] = field(default_factory=dict)
    lengths: tuple[int, ...] = ()


class Trie:
    """Rules by number; a repeated rule keeps its first number, and of rules of one length the one with the longer host is better."""

    def __init__(self, rules: Iterable[Rule]):
        self.root = Node()
        self.weights: list[tuple[int, int]] = []
        for number, rule in enumerate(rules):
            self.weights.append((len(rule.text), len(rule.host)))
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.labels.setdefault(label, Node())
            *whole, last = rule.path.split("/")
            for segment in whole:
                node = node.segments.setdefault(segment, Node())
            node.endings.setdefault(last, number)
            node.lengths = tuple(sorted({*node.lengths, len(last)}))

    def best(self, host: str, path: str) -> int:
        """Number of the longest rule that fits, -1 if none does."""
        found, node, segments = -1, self.root, None
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            if node.segments or node.endings:
                segments = path.split("/") if segments is None else segments
                found = self._down(node, segments, found)
        return found

    def _down(self, node: Node, segments: list[str], found: int) -> int:
        for segment in segments:
            for length in node.lengths:
                number = node.endings.get(segment[:length]) if length <= len(segment) else None
                if number is not None and (found < 0 or self.weights[number] > self.weights[found]):
                    found = number
            node = node.segments.get(segment)
            if node is None:
                break
        return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path as they stand in a url; both empty without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_blocks(rules: Iterable[Rule], block_chars: int = BLOCK_CHARS) -> Iterator[tuple[int, list[Rule]]]:
    """(number of the first rule, rules) with at most ``block_chars`` characters together, one rule at least."""
    first, block, held = 0, [], 0
    for number, rule in enumerate(rules):
        if block and held + len(rule.text) > block_chars:
            yield first, block
            first, block, held = number, [], 0
        block.append(rule)
        held += len(rule.text)
    if block:
        yield first, block


def judge(pages: DataFrame, rules: Iterable[Rule] = RULES, default: str = ALLOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per page: page_id, host, path, rule (host and path of the longest rule that fits, else null), verdict.

    A rule fits its host and all subdomains if the page's path starts with the
    rule's; a rule with an empty path fits every path. The longest rule (in
    characters) wins; of two that are as long, the one with the longer host, and
    of repeated rules the first. Ports and user names are part of a host as they
    stand. A null url, or one without ``://``, has an empty host and path, which
    no rule with a host fits. Repeated rows and null ids stay as they are, other
    columns are left out, an empty table gives no rows, and without rules every
    page has the default verdict.
    """
    rules = [Rule(*rule) for rule in rules]
    if bad := {default, *(rule.verdict for rule in rules)} - {ALLOW, BLOCK}:
        raise ValueError(f"verdicts must be {ALLOW!r} or {BLOCK!r}, not {sorted(bad)}")
    host, path = host_and_path(F.coalesce("url", F.lit("")))
    rows = pick(pages, page_id="long", url="string").select("page_id", host.alias("host"), path.alias("path"))
    nothing = F.lit(None).cast("string")
    rows = rows.select("*", nothing.alias("rule"), nothing.alias("verdict"), F.lit(0).alias("weight"), F.lit(0).alias("host_weight"))
    for first, block in rule_blocks(rules, block_chars):
        rows = _longest(stored(rows) if first else rows, block)
    return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _longest(rows: DataFrame, block: list[Rule]) -> DataFrame:
    """Rows with the longer of the rule they have and the one that the block's trie finds."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((Trie(block), block))

    @F.pandas_udf("rule string, verdict string, weight int, host_weight int")
    def found(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        trie, known = shared.value
        none = (None, None, 0, 0)
        each = [(known[n].text, known[n].verdict, *trie.weights[n]) for n in range(len(known))]
        numbers = [trie.best(h, p) for h, p in zip(host, path)]
        return pd.DataFrame([each[n] if n >= 0 else none for n in numbers], columns=["rule", "verdict", "weight", "host_weight"])

    new = F.struct("found.weight", "found.host_weight") > F.struct("weight", "host_weight")
    columns = ["rule", "verdict", "weight", "host_weight"]
    return rows.withColumn("found", found("host", "path")).select(
        "page_id", "host", "path", *[F.when(new, F.col(f"found.{c}")).otherwise(F.col(c)).alias(c) for c in columns])


URL_SQL = r"""
WITH rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), rests AS (
  SELECT row_number() OVER () AS place, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), hosts AS (
  SELECT place, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests
), urls AS (
  SELECT place, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts
), fitting AS (
  SELECT place, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY place
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN fitting USING (place)
"""
