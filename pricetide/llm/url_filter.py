"""Allow and block rules for URLs: a trie over reversed host labels and path segments."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
# A broadcast trie holds this many rules at most; longer lists are refused.
MAX_RULES = 1_000_000


class _Node:
    """Host node: subdomains by label, rules by path. Path node: segments, rules by prefix."""

    __slots__ = ("children", "paths", "bare", "prefixes", "longest")

    def __init__(self):
        self.children: dict[str, _Node] = {}
        self.paths: _Node | None = None
        self.bare: tuple[str, str] | None = None
        self.prefixes: dict[str, tuple[str, str]] = {}
        self.longest = 0


class UrlTrie:
    """Rules ``(verdict, "host/path")``; a rule without a slash fits every path.

    A rule fits its host and all subdomains if the path starts with the rule's path. Of the
    fitting rules the one with the longest text wins; of equal texts, block.
    """

    def __init__(self, rules: list[tuple[str, str]]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules")
        self.root = _Node()
        for verdict, rule in rules:
            if verdict not in (ALLOW, BLOCK):
                raise ValueError(f"unknown verdict {verdict!r}")
            self._add(verdict, rule)

    def _add(self, verdict: str, rule: str) -> None:
        host, slash, path = rule.partition("/")
        node = self.root
        for label in reversed(host.split(".")):
            node = node.children.setdefault(label, _Node())
        if not slash:
            if node.bare is None or verdict == BLOCK:
                node.bare = (rule, verdict)
            return
        if node.paths is None:
            node.paths = _Node()
        at = node.paths
        *segments, prefix = path.split("/")
        for segment in segments:
            at = at.children.setdefault(segment, _Node())
        if prefix not in at.prefixes or verdict == BLOCK:
            at.prefixes[prefix] = (rule, verdict)
        at.longest = max(at.longest, len(prefix))

    @staticmethod
    def _best_path(at: _Node, path: str) -> tuple[str, str] | None:
        best = None
        for segment in path[1:].split("/"):
            for size in range(min(at.longest, len(segment)), -1, -1):
                if found := at.prefixes.get(segment[:size]):
                    best = found
                    break
            if (at := at.children.get(segment)) is None:
                break
        return best

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest fitting rule."""
        best, node = None, self.root
        for label in reversed(host.split(".")):
            if (node := node.children.get(label)) is None:
                break
            found = [node.bare] if node.bare else []
            if node.paths is not None and path and (deep := self._best_path(node.paths, path)):
                found.append(deep)
            for rule in found:
                if best is None or len(rule[0]) >= len(best[0]):
                    best = rule
        return best


_UPPER = {c: c + 32 for c in range(0x41, 0x5B)}


def split_url(url: str | None) -> tuple[str, str]:
    """(host with A-Z in lower case, path); both empty without ``://`` or for null."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return host.translate(_UPPER), rest[:end]


def judge_urls(
    df: DataFrame, rules: list[tuple[str, str]], url: str = "url", default: str = ALLOW
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict``; without a rule, ``default``.

    The trie is broadcast (``MAX_RULES`` bounds it). Columns of these names are replaced.
    A null, empty or relative url has an empty host and fits no rule.
    """
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            rows = []
            for text in urls:
                host, path = split_url(text if isinstance(text, str) else None)
                rule, verdict = trie.value.match(host, path) or (None, default)
                rows.append((host, path, rule, verdict))
            yield pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    named = ["host", "path", "rule", "verdict"]
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in named]
    return df.select(*kept, judge(F.col(f"`{url}`")).alias("_judged")).select(
        *kept, *(F.col(f"_judged.{n}").alias(n) for n in named)
    )
