"""Small tables with the cases every operator has to take, and plain versions to compare with."""

from __future__ import annotations

import re
from collections import defaultdict

SPACE = r"[\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, slot string, row string, rest string, n int, component_id string, _text_key string, key string, leaf string"


def prose(n: int, seed: int = 1) -> str:
    out, x = [], seed
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("w" + str(x % 997))
    return " ".join(out)


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, a repeated doc_id with another text."""
    long_text = prose(30_000, 9)
    near = prose(400, 3).split()
    texts = [(1, prose(60, 1)), (2, prose(60, 1)), (3, prose(60, 1) + " tail"), (4, None), (5, ""), (6, " \t\n "), (7, "one two"), (8, "ONE  two"), (9, "one two three"),
             (10, long_text), (11, long_text + " end"), (11, long_text + " end"), (12, " ".join(near)), (13, " ".join(near[:390] + ["x"] * 3)), (14, " ".join(near[200:])),
             (14, prose(80, 5)), (15, prose(80, 5)), (None, prose(60, 1)), (None, None), (16, "Licensed under the Apache License, Version 2.0.\n" + prose(30, 8)), (17, "a  b \n c d\n\n"), (18, "Ünïcode wörds  ÀÉ")]
    return [(d, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"src{i % 3}", None, None, "x", "y", None, i, "z", "k", "k", None) for i, (d, t) in enumerate(texts)]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None, lower: bool = True) -> list[str]:
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text: str | None, k: int = 5) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def near_components(rows: list[tuple], percent: int = 75) -> dict:
    """doc_id -> smallest doc_id reachable, by comparing every two texts that share a shingle."""
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    places = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for g in s:
            places[g].append(i)
    for i, (d, s) in enumerate(sets):
        for j in {j for g in s for j in places[g] if j < i}:
            both = len(s & sets[j][1])
            if 100 * both >= percent * (len(s) + len(sets[j][1]) - both):
                a, b = find(d), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return {d: find(d) for d in parent}
