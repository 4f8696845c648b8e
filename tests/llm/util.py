"""Small inputs and brute-force answers for the training-data operators."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SMALL = "/root/testdata/sf0.001"


def docs_df(spark, rows):
    """rows: (doc_id, text[, lang, source])"""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def component_ids(ids, links):
    """Least id reachable by links, for every id."""
    root = {i: i for i in ids}

    def find(v):
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)}


def similar_pairs(sets, num, den):
    at = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            at[x].append(d)
    both = Counter((a, b) for ds in at.values() for i, b in enumerate(ds) for a in ds[:i])
    return [p for p, n in both.items() if den * n >= num * (len(sets[p[0]]) + len(sets[p[1]]) - n)]


def repeated_bytes(raws, size):
    """doc -> list of flags, true where the byte is covered by a repeated string of ``size`` bytes."""
    seen = Counter(r[i:i + size] for r in raws.values() for i in range(len(r) - size + 1))
    out = {}
    for d, r in raws.items():
        gone = [False] * len(r)
        for i in range(len(r) - size + 1):
            if seen[r[i:i + size]] > 1:
                gone[i:i + size] = [True] * size
        out[d] = gone
    return out


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    """Plain regular expressions of the base entities, checks applied afterwards."""
    text, out = text or "", []
    only = lambda m: re.sub("[^0-9]", "", m[0])
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(only(m)) <= 19 and _luhn(only(m)):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(only(m)) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out
