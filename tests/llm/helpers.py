"""Brute-force versions the operators are compared with, and awkward rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from loomkit.llm.common import read

SF = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]")


def texts(spark, sf=SF):
    return [(r.doc_id, r.text) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]


def odd_documents(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns whose names clash with helper columns."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    rows = [(1, "", "en", 5), (2, None, None, None), (3, long, "en", 1), (4, long, "en", 2), (5, "  \t\n", "fr", 3), (5, "  \t\n", "fr", 3),
            (None, "a lonely text without an id", "en", 4), (6, "AbC d e F g", "de", 5), (7, "abc D E f G", "de", 6), (8, "one two", None, 7),
            (9, "é" * 700, "fr", 8), (10, "12345 67890 !!", "en", 9)]
    return spark.createDataFrame([(*r, r[0], r[0]) for r in rows],
                                 "doc_id long, text string, lang string, n long, rid long, `row` long")


def empty_documents(spark):
    return odd_documents(spark).limit(0)


def exact_groups(rows):
    """{doc_id: (keep_id, group_size, kept, sha)} for distinct ids."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), i == min(g)[1], hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, i in g}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_groups(rows):
    """{doc_id: (n_shingles, component_id, kept)}: every pair of sets is compared."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def without_repeats(all_texts, length=400):
    """[(n_bytes, n_removed, n_spans, sha of the rest)]."""
    raw = [(t or "").encode() for t in all_texts]
    seen = Counter(b[p:p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out
