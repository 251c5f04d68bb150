"""Allow and block rules over URLs: a trie of reversed host labels, then path segments.

A rule is (host, path, verdict). It fits a URL whose host is the rule's or lies below it, and whose
path starts with the rule's. Of several, the one with most host labels wins, then the longest path;
of an allow and a block entry for the same host and path, the block entry.

Cases: a null URL, or one without `://`, has an empty host and path, fits no rule and gets the
default verdict; so does a URL whose path is empty, as every rule's path starts with `/`. Repeated
rows are judged alike and all kept; an empty table gives an empty result; other columns of the
input, whatever their names, are ignored. A URL of any length costs one walk over its parts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALLOW, BLOCK = "allow", "block"
# rule text beyond this is joined instead of sent to every executor
MAX_TRIE_CHARS = 8 << 20


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path; both empty without `://`."""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    for end in "?#":
        rest = rest.partition(end)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


class _Node:
    """`below` leads on by a whole label or segment; `tails` end a path inside a segment."""

    __slots__ = ("below", "root", "tails")

    def __init__(self) -> None:
        self.below: dict[str, _Node] = {}
        self.root: _Node | None = None  # of the paths under this host
        self.tails: dict[str, tuple[str, str]] = {}  # start of the next segment: rule, verdict

    def step(self, key: str) -> _Node:
        return self.below.setdefault(key, _Node())


def build_trie(rules: Iterable[Rule]) -> _Node:
    top = _Node()
    for rule in rules:
        if not rule.path.startswith("/") or rule.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"not a rule: {rule}")
        node = top
        for label in reversed(rule.host.translate(_LOWER).split(".")):
            node = node.step(label)
        node.root = node.root or _Node()
        node = node.root
        *whole, tail = rule.path[1:].split("/")
        for segment in whole:
            node = node.step(segment)
        if node.tails.get(tail, ("", ALLOW))[1] != BLOCK:
            node.tails[tail] = (rule.text, rule.verdict)
    return top


def _longest_path(node: _Node, path: str) -> tuple[str, str] | None:
    found = None
    for segment in path[1:].split("/"):
        starts = [tail for tail in node.tails if segment.startswith(tail)]
        if starts:
            found = node.tails[max(starts, key=len)]
        node = node.below.get(segment)
        if node is None:
            break
    return found


def longest_match(top: _Node, host: str, path: str) -> tuple[str, str] | None:
    """Rule and verdict of the longest rule that fits, if any."""
    if not host or not path:
        return None
    found, node = None, top
    for label in reversed(host.split(".")):
        node = node.below.get(label)
        if node is None:
            break
        if node.root is not None:
            found = _longest_path(node.root, path) or found
    return found


def judge_urls(
    pages: DataFrame,
    rules: Iterable[Rule],
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = ALLOW,
    max_trie_chars: int = MAX_TRIE_CHARS,
) -> DataFrame:
    """Columns id, host, path, rule (null if none fits) and verdict, one row per row of `pages`.

    The trie is sent to every executor while the rules' text has at most `max_trie_chars`
    characters; a longer list is joined with the URLs' own host suffixes and path starts.
    """
    rules = list(rules)
    rows = pages.select(F.col(id_column), F.col(url_column).alias("url"))
    if sum(len(rule.text) for rule in rules) > max_trie_chars:
        return _judge_by_join(rows, rules, id_column, default)
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))
    layout = T.StructType([
        rows.schema[id_column],
        T.StructField("host", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ])

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = trie.value
        for batch in batches:
            parts = [split_url(url) for url in batch["url"]]
            found = [longest_match(top, *part) for part in parts]
            yield pd.DataFrame({
                id_column: batch[id_column],
                "host": [host for host, _ in parts],
                "path": [path for _, path in parts],
                "rule": [hit[0] if hit else None for hit in found],
                "verdict": [hit[1] if hit else default for hit in found],
            })

    return rows.mapInPandas(judge, layout)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The two parts of `split_url` as columns."""
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    rest = F.coalesce(F.regexp_extract(rest, r"(?s)^([^?#]*)", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), F.regexp_extract(rest, r"(?s)^[^/]*(.*)", 1)


def _judge_by_join(
    rows: DataFrame, rules: list[Rule], id_column: str, default: str
) -> DataFrame:
    spark = rows.sparkSession
    lengths = sorted({len(rule.path) for rule in rules})
    table = (
        spark.createDataFrame(
            [(r.host.translate(_LOWER), r.path, r.text, r.verdict) for r in rules],
            "suffix string, start string, rule string, rule_verdict string",
        )
        .groupBy("suffix", "start")
        # of both verdicts the greater one is block
        .agg(F.max_by("rule", "rule_verdict").alias("rule"), F.max("rule_verdict").alias("rule_verdict"))
    )
    host, path = host_and_path(F.col("url"))
    urls = rows.select("url").distinct().select("url", host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    starts = F.transform(
        F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path")),
        lambda n: F.substr(F.col("path"), F.lit(1), n),
    )
    best = (
        urls.filter((F.col("host") != "") & (F.col("path") != ""))
        .select("url", F.explode(suffixes).alias("suffix"), starts.alias("starts"))
        .select("url", "suffix", F.explode("starts").alias("start"))
        .join(table, ["suffix", "start"])
        .groupBy("url")
        .agg(
            F.max_by(
                F.struct("rule", "rule_verdict"),
                F.struct(F.size(F.split("suffix", r"\.", -1)), F.length("start")),
            ).alias("hit")
        )
    )
    found = urls.join(best, "url", "left").withColumnRenamed("url", "known_url")
    return rows.join(found, F.col("url").eqNullSafe(F.col("known_url")), "left").select(
        id_column,
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.rule_verdict", F.lit(default)).alias("verdict"),
    )
