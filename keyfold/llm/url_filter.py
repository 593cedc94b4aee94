"""URL allow and block rules: a trie over reversed host labels and path segments.

A rule is a host with a path prefix, such as ``example.org/es/``. It fits its
host and every subdomain, when the URL's path starts with the rule's path. The
longest fitting rule (characters of host and path; then the longer host; then
block over allow) gives the verdict, else ``default``.

The trie is broadcast while the rules are few enough (``max_broadcast_rules``);
beyond that the rules are joined by host suffix.

Cases: a null URL or one without ``://`` has an empty host and path and gets
the default verdict; repeated rows and rows of null ids are judged one by one;
an empty table gives an empty result; other columns pass through, and a column
of the table named like an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

URL_PARTS = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class PathNode:
    """Below one path segment: complete next segments, and rules that end inside the next one."""

    kids: dict[str, PathNode] = field(default_factory=dict)
    ends: dict[str, str] = field(default_factory=dict)

    def add(self, segments: list[str], verdict: str) -> None:
        node = self
        for segment in segments[:-1]:
            node = node.kids.setdefault(segment, PathNode())
        if node.ends.get(segments[-1]) != "block":
            node.ends[segments[-1]] = verdict

    def longest(self, segments: list[str]) -> tuple[str, str] | None:
        """The longest rule path that starts this path, with its verdict."""
        node, above, best = self, [], None
        for depth, segment in enumerate(segments):
            fits = [e for e in node.ends if segment.startswith(e)]
            if fits:
                end = max(fits, key=len)
                best = "/".join([*above, end]), node.ends[end]
            if depth + 1 == len(segments) or segment not in node.kids:
                break
            above.append(segment)
            node = node.kids[segment]
        return best


@dataclass
class HostNode:
    """One host label, read from the right."""

    kids: dict[str, HostNode] = field(default_factory=dict)
    paths: PathNode | None = None


def build_trie(rules: Iterable[tuple[str, str, str]]) -> HostNode:
    """``rules``: (verdict, host, path)."""
    root = HostNode()
    for verdict, host, path in rules:
        node = root
        for label in reversed(host.split(".")):
            node = node.kids.setdefault(label, HostNode())
        node.paths = node.paths or PathNode()
        node.paths.add(path.split("/"), verdict)
    return root


def judge(root: HostNode, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest fitting rule."""
    segments, labels = path.split("/"), host.split(".")
    node, best, best_len = root, None, (-1, -1)
    for depth, label in enumerate(reversed(labels), 1):
        node = node.kids.get(label)
        if node is None:
            break
        found = node.paths.longest(segments) if node.paths else None
        if found:
            rule_host = ".".join(labels[-depth:])
            length = (len(rule_host) + len(found[0]), len(rule_host))
            if length > best_len:
                best, best_len = (rule_host + found[0], found[1]), length
    return best


def split_rule(pattern: str) -> tuple[str, str]:
    host, slash, rest = pattern.partition("/")
    return host.lower(), slash + rest


def with_url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    return df.withColumns({
        "host": F.translate(F.regexp_extract(text, URL_PARTS, 1), _UPPER, _LOWER),
        "path": F.regexp_extract(text, URL_PARTS, 2),
    })


def filter_urls(df: DataFrame, rules: list[tuple[str, str]], *, url: str = "url", default: str = "allow",
                max_broadcast_rules: int = 200_000) -> DataFrame:
    """Add host, path, rule and verdict. ``rules``: (allow or block, pattern)."""
    parsed = [(verdict, *split_rule(pattern)) for verdict, pattern in rules]
    parts = with_url_parts(df.drop("rule", "verdict", "host", "path") if url not in ("host", "path") else df, url)
    if len(parsed) > max_broadcast_rules:
        return _joined(parts, parsed, default)
    trie = df.sparkSession.sparkContext.broadcast(build_trie(parsed))

    @F.pandas_udf("rule string, verdict string")
    def decide(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [judge(trie.value, h, p) for h, p in zip(host, path)]
        return pd.DataFrame({"rule": [f[0] if f else None for f in found],
                             "verdict": [f[1] if f else default for f in found]})

    return parts.withColumn("_found", decide("host", "path")).select(
        *[parts[c] for c in parts.columns], F.col("_found.rule").alias("rule"), F.col("_found.verdict").alias("verdict"))


def _joined(parts: DataFrame, parsed: list[tuple[str, str, str]], default: str) -> DataFrame:
    """The same by joins, for rule sets too large to broadcast: every host suffix meets the rules of that host."""
    spark = parts.sparkSession
    rules = spark.createDataFrame(parsed, "rule_verdict string, rule_host string, rule_path string")
    keys = parts.select("host", "path").distinct()
    suffixes = F.expr("transform(sequence(1, size(split(host, '[.]'))), i -> "
                      "array_join(slice(split(host, '[.]'), i, size(split(host, '[.]'))), '.'))")
    fits = (keys.withColumn("rule_host", F.explode(suffixes)).join(rules, "rule_host")
            .where(F.expr("startswith(path, rule_path)")))
    order = Window.partitionBy("host", "path").orderBy(
        (F.length("rule_host") + F.length("rule_path")).desc(), F.length("rule_host").desc(), F.col("rule_verdict").desc())
    best = (fits.withColumn("_n", F.row_number().over(order)).where("_n = 1")
            .select("host", "path", F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict"))
    return (parts.join(best, ["host", "path"], "left").withColumn("verdict", F.coalesce("rule_verdict", F.lit(default)))
            .drop("rule_verdict"))
