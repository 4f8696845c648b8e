"""URL filters: a trie over reversed host labels and path segments.

``UrlTrie`` is built on the driver from the rule list (its size is the rule
list's), broadcast, and walked once per url inside Arrow batches.  The walk
goes down the host labels from the right; at every host node that carries
rules it goes on along the path segments.  The longest fitting rule decides,
longest meaning: most host labels, then longest path; of equal rules block
wins.

Defined cases: a NULL url, or one without ``://``, has empty host and path and
gets the default verdict; an empty host fits no rule; repeated rules count
once; NULL hosts or paths in the rule list are dropped.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
_UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
_URL = re.compile(r"(?s).*?://([^/?#]*)([^?#]*)")


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def split_url(url) -> tuple[str, str]:
    """(host, path) of a url; both empty for NULL or without ``://``."""
    m = _URL.match(url) if isinstance(url, str) else None
    return (m[1].translate(_UPPER), m[2]) if m else ("", "")


class UrlTrie:
    """Nodes are dicts: host labels below ``hosts``, path segments below ``paths``.

    A rule's path is a plain prefix: all segments but the last must be equal,
    the last one is a prefix of the url's segment, so it is kept in the node's
    ``ends`` list, longest first.
    """

    def __init__(self, rules):
        self.root = self._node()
        for r in rules:
            if r.host is None or r.path is None:
                continue
            node = self.root
            for label in reversed(r.host.translate(_UPPER).split(".")):
                node = node["hosts"].setdefault(label, self._node())
            *whole, last = r.path.split("/")
            for seg in whole:
                node = node["paths"].setdefault(seg, self._node())
            ends = node["ends"]
            if ends.get(last) != BLOCK:
                ends[last] = r.verdict
        self._freeze(self.root)

    @staticmethod
    def _node():
        return {"hosts": {}, "paths": {}, "ends": {}}

    def _freeze(self, root):
        todo = [root]
        while todo:
            node = todo.pop()
            node["ends"] = sorted(node["ends"].items(), key=lambda x: -len(x[0]))
            todo += [*node["hosts"].values(), *node["paths"].values()]

    @staticmethod
    def _along_path(node, segments):
        """(rule path, verdict) of the longest path rule below a host node."""
        best, walked = None, []
        for k, seg in enumerate(segments):
            for last, verdict in node["ends"]:
                if seg.startswith(last):
                    best = "/".join([*segments[:k], last]), verdict
                    break
            node = node["paths"].get(seg)
            if node is None:
                break
        return best

    def match(self, host: str, path: str):
        """(rule as text, verdict) of the longest fitting rule, else None."""
        if not host:
            return None
        node, labels, best, segments = self.root, host.split("."), None, path.split("/")
        for k in range(len(labels) - 1, -1, -1):
            node = node["hosts"].get(labels[k])
            if node is None:
                break
            found = self._along_path(node, segments)
            if found:
                best = ".".join(labels[k:]) + found[0], found[1]
        return best


def filter_urls(df: DataFrame, rules, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """Adds host, path, rule and verdict to each row of ``df``.

    Columns of ``df`` with those names are replaced.  Rows are neither moved
    nor collected; the trie is broadcast (its size is the rule list's).
    """
    if default not in (ALLOW, BLOCK):
        raise ValueError(f"default must be {ALLOW} or {BLOCK}")
    trie = df.sparkSession.sparkContext.broadcast(UrlTrie(list(rules)))

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judge(urls: pd.Series) -> pd.DataFrame:
        t, rows = trie.value, []
        for u in urls:
            host, path = split_url(u)
            hit = t.match(host, path)
            rows.append((host, path, *(hit or (None, default))))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype=object)

    return df.withColumn("__judged", judge(F.col(url_col))).withColumns(
        {c: F.col("__judged")[c] for c in ("host", "path", "rule", "verdict")}).drop("__judged")
