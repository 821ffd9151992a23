"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def order(doc_id):
    return -(1 << 63) if doc_id is None else doc_id


def line_dedup(docs, min_chars=20, min_docs=3):
    """[(id, text)] to [(id, lines, dropped, text)]."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(order(i))
    last = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(key(x), order(i)) == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept) if len(kept) < len(lines) else text))
    return out


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def near(docs, threshold=0.8):
    """[(id, text)] to [(id, class, links)]."""
    sets = [shingles(t) for _, t in docs]
    parent, degree = list(range(len(docs))), Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both >= threshold * len(sets[a] | sets[b]) - 1e-9:
                    degree[a] += 1
                    degree[b] += 1
                    parent[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(docs):
        least[find(a)] = min(least.get(find(a), order(i)), order(i))
    back = lambda i: None if i == order(None) else i
    return [(i, back(least[find(a)]), degree[a]) for a, (i, _) in enumerate(docs)]


def substring_dedup(docs, window=13):
    """[(id, text)] to [(id, words, removed, text)]."""
    first = {}
    for i, text in docs:
        w = words(text)
        for at in range(len(w) - window + 1):
            key = tuple(w[at : at + window])
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for i, text in docs:
        w = words(text)
        gone = set()
        for at in range(len(w) - window + 1):
            if first[tuple(w[at : at + window])] < order(i):
                gone.update(range(at, at + window))
        kept = [x for n, x in enumerate(w) if n not in gone]
        out.append((i, len(w), len(gone), " ".join(kept) if gone else text))
    return out


def pieces(docs, tokenizer, length=4096):
    """[(id, text)] to [(id, piece, start, length, crc)]."""
    out = []
    for i, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), length)):
            part = ids[at : at + length]
            out.append((i, n, at, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))))
    return out


def top_k(vectors, is_query, k):
    """[(id, [int])] to [(query, rank, id, score)]."""
    out = []
    for q, a in vectors:
        if is_query(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in vectors if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out
