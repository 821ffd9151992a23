"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a window of a text's words, as long as the template and ``slack`` words more,
wherever lines break. Tokens are ordered by their document frequency over the whole
corpus, rarest first. A window whose containment of a template (shared distinct tokens /
template tokens) reaches the threshold must share one of the template's first
``n - ceil(t * n) + 1`` tokens in that order (prefix filter). The words around a place of
such a token must have at least ``ceil(t * n)`` template tokens (length filter), and
enough of them must come after it in the order (positional filter). Every window around
what passes is verified exactly, so nothing is missed. Of windows that overlap, the one
with the most shared tokens is reported, then the shortest, then the first. The templates
are a parameter; only their tokens are counted, so what is broadcast is bounded by them
and not by the corpus.

Defined cases: a null text is an empty one; documents without a hit get empty labels
and score 0; repeated ids and rows each get their own result row; an empty table gives
an empty result; only the id and text columns are read.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.store import id_and_text
from tallymark.llm.words import text_slices

#: Phrases that name a license, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Public license notices, in lower case without punctuation.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

THRESHOLD = 0.9

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of 0-9, a-z and characters beyond ASCII, A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


@dataclass
class Matcher:
    """Templates in one token order, with an index of their prefixes."""

    ranks: dict[bytes, int]
    templates: list[tuple[str, list[int], int, int]]  # label, ranks ascending, tokens needed, words of a window
    index: dict[int, list[tuple[int, int]]]  # rank -> (template, place in it)

    @classmethod
    def build(cls, templates, threshold: float, frequency: dict[bytes, int]) -> Matcher:
        tokens = {t for _, text in templates for t in words_of(text)}
        ranks = {t: i for i, t in enumerate(sorted(tokens, key=lambda t: (frequency.get(t, 0), t)))}
        ready, index = [], {}
        for label, text in templates:
            ordered = sorted({ranks[t] for t in words_of(text)})
            need = max(1, math.ceil(threshold * len(ordered) - 1e-9))
            for place in range(len(ordered) - need + 1):
                index.setdefault(ordered[place], []).append((len(ready), place))
            length = len(words_of(text))
            ready.append((label, ordered, need, length + slack(length)))
        return cls(ranks, ready, index)

    def prefix_tokens(self) -> set[bytes]:
        return {t for t, r in self.ranks.items() if r in self.index}

    def passages(self, words: list[bytes]) -> list[tuple[int, str, float]]:
        """Places where a window that contains a template begins, its label and containment."""
        ranks = self.ranks
        places = [i for i, w in enumerate(words) if w in ranks]
        held = [ranks[words[i]] for i in places]
        near: dict[int, list[tuple[int, int]]] = {}  # template -> stretches of places to verify
        for at, rank in enumerate(held):
            for number, place in self.index.get(rank, ()):
                _, ordered, need, width = self.templates[number]
                begin, end = bisect_right(places, places[at] - width), bisect_left(places, places[at] + width)
                if end - begin < need:
                    continue
                shared = set(held[begin:end]).intersection(ordered)
                if len(shared) < need or 1 + min(len(ordered) - place - 1, sum(r > rank for r in shared)) < need:
                    continue
                stretches = near.setdefault(number, [])
                if stretches and begin <= stretches[-1][1]:
                    stretches[-1] = (stretches[-1][0], max(end, stretches[-1][1]))
                else:
                    stretches.append((begin, end))
        out = []
        for number, stretches in near.items():
            label, ordered, need, width = self.templates[number]
            for begin, end in stretches:
                out += [(p, label, n / len(ordered)) for p, n in _best_windows(places[begin:end], held[begin:end], set(ordered), need, width)]
        return out


def slack(length: int) -> int:
    """Words that a window has more than its template of some words."""
    return max(4, length // 4)


def _best_windows(places: list[int], held: list[int], wanted: set[int], need: int, width: int) -> list[tuple[int, int]]:
    """First word and shared tokens of windows that reach ``need``; none overlap."""
    own = [(p, r) for p, r in zip(places, held, strict=True) if r in wanted]
    count: Counter[int] = Counter()
    hits, left = [], 0
    for place, rank in own:
        count[rank] += 1
        while place - own[left][0] >= width or count[own[left][1]] > 1:
            first = own[left][1]
            count[first] -= 1
            if not count[first]:
                del count[first]
            left += 1
        if len(count) >= need:
            hits.append((-len(count), place - own[left][0], own[left][0]))
    begins: list[int] = []
    chosen: dict[int, tuple[int, int]] = {}  # first word -> last word, shared tokens
    for negative, span, begin in sorted(hits):
        at = bisect_right(begins, begin)
        if at and chosen[begins[at - 1]][0] >= begin or at < len(begins) and begins[at] <= begin + span:
            continue
        begins.insert(at, begin)
        chosen[begin] = (begin + span, -negative)
    return [(b, chosen[b][1]) for b in begins]


def _place_finder(phrases: dict[str, str]):
    parts = [(tuple(p.encode().split()), label) for p, label in phrases.items()]
    last = {p[-1] for p, _ in parts}

    def places(words: list[bytes]) -> list[tuple[int, str]]:
        out = []
        if last.isdisjoint(words):
            return out
        for phrase, label in parts:
            at, first = -1, phrase[0]
            try:
                while True:
                    at = words.index(first, at + 1)
                    if tuple(words[at : at + len(phrase)]) == phrase:
                        out.append((at, label))
            except ValueError:
                pass
        return out

    return places


def token_counts(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> dict[bytes, int]:
    """Documents that hold each template token, over all documents.

    One row per template token comes back; sums are taken in the tasks first.
    """
    wanted = frozenset(t for _, text in templates for t in words_of(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in text_slices(batches):
            for text in batch.column("__text").to_pylist():
                total.update(wanted.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array([t.decode() for t in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["token", "n"])

    rows = id_and_text(docs, id_col, text_col).mapInArrow(count, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"].encode(): r["n"] for r in rows.collect()}


def scan(docs: DataFrame, templates=TEMPLATES, phrases=None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: words, places of phrases, and every window that holds a template.

    Columns: the id, ``n_words``, ``places`` (array of word, label) and ``blocks``
    (array of line where the window begins, label, best containment there).
    """
    phrases = PHRASES if phrases is None else phrases
    matcher = Matcher.build(templates, threshold, token_counts(docs, templates, id_col, text_col))
    rare = frozenset(matcher.prefix_tokens())
    place = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    block = pa.list_(pa.struct([("line", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _place_finder(phrases)
        for batch in text_slices(batches):
            counts, places, blocks = [], [], []
            for text in batch.column("__text").to_pylist():
                words = words_of(text)
                counts.append(len(words))
                places.append([{"word": w, "label": label} for w, label in sorted(find(words))])
                blocks.append([])
                found = [] if rare.isdisjoint(words) else matcher.passages(words)
                if found:
                    ends = list(accumulate(len(words_of(line)) for line in text.split("\n")))
                    best: dict[tuple[int, str], float] = {}
                    for word, label, share in found:
                        key = bisect_right(ends, word), label
                        best[key] = max(best.get(key, 0.0), share)
                    blocks[-1] += [{"line": at, "label": k, "containment": v} for (at, k), v in sorted(best.items())]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(counts, pa.int64()), pa.array(places, place), pa.array(blocks, block)], names=["__id", "n_words", "places", "blocks"])

    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["__id"].dataType.simpleString()
    out = rows.mapInArrow(look, f"__id {kind}, n_words bigint, places array<struct<word: bigint, label: string>>, blocks array<struct<line: bigint, label: string, containment: double>>")
    return out.withColumnRenamed("__id", id_col)
