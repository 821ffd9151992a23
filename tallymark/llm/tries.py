"""Filter interaction audit: what each filter removes, in every order of the filters.

Every document is judged once by all filters and becomes a mask of failure bits. Four
filters look at one text alone; the fifth asks whether an earlier document has the same
text, and is answered by radix tries over whole texts:

1. A bounded sample of texts gives ranges of about equal size, told apart by prefixes
   as short as tell them apart. A range that one long prefix fills is dealt further by
   a checksum of the whole text, so no range grows with the corpus.
2. Each task judges its documents and puts their texts into a compressed trie whose terminals
   hold the least id. A document that meets its own text with a smaller id is decided there, so
   a text that a third of all rows hold leaves a task once each time its trie is full.
3. Undecided texts travel whole to the trie of their range. Rows stream through it; when
   it is traversed, the least id of each terminal is free of the flag.

The masks then meet the labels and are reduced to counts per part and mask, of which all
orders are read off: a step of an order removes what fails its filter and none before.

Defined cases: a null text is empty, and empty texts are texts like others; a null id is
neither a copy nor makes one; rows that repeat an id with one text are not copies of each
other and count each; a null part is the empty one; of labels that repeat an id, any that says so counts;
a document without a label is neither good nor toxic; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.store import pieces_of
from tallymark.llm.words import text_slices

FILTERS = "ABCDE"
COPY = 16
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT, MARKS = 200, 50, 3, b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

PREFIX = 256
RANGE_BYTES = 1 << 24
TRIE_BYTES = 1 << 24
#: Ranges told apart by prefixes, sampled rows, and partitions, at most.
MOST_RANGES, MOST_SAMPLED, MOST_PARTITIONS = 4096, 100_000, 1 << 16


def own_failures(text: bytes, chars: int) -> int:
    """The bits of the filters that look at one text alone."""
    words = text.split()
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * (len(text) - len(text.translate(None, CAPITALS))) > CAPITALS_PERCENT * chars) << 2
        | (len(text.translate(None, MARKS)) < len(text)) << 3
    )


class Terminal:
    """The least id of a text so far, with how many rows of each part have it, and the text's mask."""

    __slots__ = ("least", "mask", "parts")

    def __init__(self, least: int, mask: int, part: str, count: int):
        self.least, self.mask, self.parts = least, mask, {part: count}


class Node:
    __slots__ = ("children", "label", "terminal")

    def __init__(self, label: bytes):
        self.label, self.children, self.terminal = label, {}, None


def _agree(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of ``label`` stand in ``text`` from ``at`` on."""
    begin, size, most = 0, 32, min(len(label), len(text) - at)
    while begin < most:
        size = min(size, most - begin)
        if label[begin : begin + size] == text[at + begin : at + begin + size]:
            begin, size = begin + size, size * 2
        elif size == 1:
            break
        else:
            size //= 2
    return begin


class Trie:
    """Whole texts by their shared beginnings; ``size`` counts the bytes its labels hold."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def node(self, text: bytes) -> Node:
        """The node at which the text ends, made if there is none."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.size += len(child.label) + 200
                return child
            if not text.startswith(child.label, at):
                shared = _agree(child.label, text, at)
                fork = node.children[text[at]] = Node(child.label[:shared])
                child.label = child.label[shared:]
                fork.children[child.label[0]] = child
                self.size += 200
                child = fork
            node, at = child, at + len(child.label)
        return node

    def add(self, text: bytes, doc_id: int, part: str, mask: int, count: int) -> list[tuple[int, str, int, int]]:
        """Put a document in; the rows that are now known to be copies."""
        node = self.node(text)
        held = node.terminal
        if held is None:
            node.terminal = Terminal(doc_id, mask, part, count)
            return []
        if doc_id > held.least:
            return [(doc_id, part, mask | COPY, count)]
        if doc_id == held.least:
            held.parts[part] = held.parts.get(part, 0) + count
            return []
        node.terminal = Terminal(doc_id, mask, part, count)
        return [(held.least, p, mask | COPY, n) for p, n in held.parts.items()]

    def walk(self) -> Iterator[tuple[bytes, Terminal]]:
        """Every text with its terminal, in order of the texts."""
        stack = [(self.root, b"")]
        while stack:
            node, before = stack.pop()
            text = before + node.label
            if node.terminal is not None:
                yield text, node.terminal
            stack += [(node.children[first], text) for first in sorted(node.children, reverse=True)]


class Ranges:
    """Which deal a text belongs to; a range may hold several, told apart by checksums."""

    def __init__(self, bounds: list[bytes], deals: list[int]):
        self.bounds, self.deals = bounds, deals
        self.first = [0, *accumulate(deals)][:-1]

    @property
    def count(self) -> int:
        return self.first[-1] + self.deals[-1]

    def deal(self, text: bytes) -> int:
        at = bisect_right(self.bounds, text[:PREFIX])
        return self.first[at] + (zlib.crc32(text) % self.deals[at] if self.deals[at] > 1 else 0)


def cut_ranges(sampled: list[tuple[bytes, int]], total: int) -> Ranges:
    """Ranges of about ``RANGE_BYTES`` from prefixes and sizes of sampled texts."""
    wanted = min(pieces_of(total, RANGE_BYTES), MOST_RANGES)
    whole = max(sum(size for _, size in sampled), 1)
    bounds: list[bytes] = []
    weights, passed, before = [0], 0, None
    for prefix, size in sorted(sampled):
        if before is not None and prefix != before and passed * wanted // whole > (passed - weights[-1]) * wanted // whole:
            bounds.append(prefix[: _agree(before, prefix, 0) + 1])
            weights.append(0)
        weights[-1] += size
        passed += size
        before = prefix
    return Ranges(bounds, [pieces_of(w * total // whole, 2 * RANGE_BYTES) for w in weights])


def ranges_of(rows: DataFrame) -> Ranges:
    """Sample the texts, each text once; the sample is bounded and only deals the work."""
    known = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("__text")).alias("b")).first()
    wanted = min(64 * pieces_of(known["b"], RANGE_BYTES), MOST_SAMPLED)
    few = rows.sample(min(1.0, wanted / max(known["n"], 1)), seed=7) if known["n"] > wanted else rows
    picked = few.select(F.substring(F.col("__text").cast("binary"), 1, PREFIX).alias("p"), F.octet_length("__text").alias("s"), F.xxhash64("__text").alias("h"))
    found = {r["h"]: (bytes(r["p"]), r["s"] + 1) for r in picked.limit(2 * MOST_SAMPLED).collect()}
    return cut_ranges(list(found.values()), known["b"] or 0)


_ROW = "id bigint, part string, fails int, n bigint"


def _emit(rows: list[tuple], deals: list[int] | None = None, texts: list[bytes | None] | None = None) -> pa.RecordBatch:
    ids, parts, fails, counts = zip(*rows, strict=True) if rows else ([], [], [], [])
    columns = [pa.array(ids, pa.int64()), pa.array(parts, pa.string()), pa.array(fails, pa.int32()), pa.array(counts, pa.int64())]
    names = ["id", "part", "fails", "n"]
    if deals is not None:
        columns += [pa.array(deals, pa.int32()), pa.array(texts, pa.binary())]
        names += ["deal", "text"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _judge(ranges: Ranges):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()

        def flush() -> Iterator[pa.RecordBatch]:
            rows, deals, texts, size = [], [], [], 0
            for text, held in trie.walk():
                deal = ranges.deal(text)
                for part, count in held.parts.items():
                    rows.append((held.least, part, held.mask, count))
                    deals.append(deal)
                    texts.append(text)
                    size += len(text)
                if size > 1 << 22:
                    yield _emit(rows, deals, texts)
                    rows, deals, texts, size = [], [], [], 0
            yield _emit(rows, deals, texts)

        for batch in text_slices(batches):
            done = []
            column = batch.column("__text")
            chars = pc.utf8_length(column).to_pylist()
            texts = column.cast(pa.binary()).to_pylist()
            for doc_id, part, text, count in zip(batch.column("__id").to_pylist(), batch.column("__part").to_pylist(), texts, chars, strict=True):
                mask = own_failures(text, count)
                if doc_id is None:
                    done.append((None, part, mask, 1))
                else:
                    done += trie.add(text, doc_id, part, mask, 1)
            # What is decided travels without its text, to any deal.
            yield _emit(done, [at % ranges.count for at in range(len(done))], [None] * len(done))
            if trie.size > TRIE_BYTES:
                yield from flush()
                trie.__init__()
        yield from flush()

    return judge


def _settle_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one deal after another, each through the deal's trie."""
    trie, current = Trie(), None
    for batch in text_slices(batches, "text"):
        out = []
        for doc_id, part, mask, count, deal, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if deal != current:
                out += [(t.least, p, t.mask, n) for _, t in trie.walk() for p, n in t.parts.items()]
                trie, current = Trie(), deal
            out += [(doc_id, part, mask, count)] if text is None else trie.add(text, doc_id, part, mask, count)
        yield _emit(out)
    yield _emit([(t.least, p, t.mask, n) for _, t in trie.walk() for p, n in t.parts.items()])


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``id``, ``part``, ``fails`` (bits in the order of ``FILTERS``) and ``n``, how many rows are so."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("__id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("__part"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    ranges = ranges_of(rows)
    partitions = min(ranges.count, MOST_PARTITIONS)
    judged = rows.mapInArrow(_judge(ranges), f"{_ROW}, deal int, text binary")
    dealt = judged.repartitionById(partitions, F.col("deal") % F.lit(partitions)).sortWithinPartitions("deal")
    return dealt.mapInArrow(_settle_copies, _ROW)


def masks(fails: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``part``, ``fails`` and the numbers of documents, of good and of toxic ones with this mask."""
    says = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).cast("int").alias(f"__{c}")
    known = labels.groupBy(F.col(f"`{id_col}`").cast("long").alias("__labelled")).agg(says("quality"), says("toxic"))
    # Summed per id first: rows that share one id, or have none, are then few.
    each = fails.groupBy("id", "part", "fails").agg(F.sum("n").alias("n"))
    both = each.join(known, F.col("id") == F.col("__labelled"), "left")
    marked = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0)))
    return both.groupBy("part", "fails").agg(F.sum("n").alias("n"), marked("__quality").alias("good"), marked("__toxic").alias("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; reads what ``masks`` returns."""
    size = len(FILTERS)
    orders = ["".join(p) for p in permutations(FILTERS)]
    held = counts.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("__m"))
    steps = held.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders)))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(size))))
    bits = F.lit(0)
    for at, letter in enumerate(FILTERS):
        bits = bits + F.when(F.instr(F.substring("filter_order", F.lit(1), F.col("step") - 1), letter) > 0, 1 << at).otherwise(0)
    own = F.coalesce(*[F.when(F.substring("filter_order", F.col("step"), F.lit(1)) == letter, 1 << at) for at, letter in enumerate(FILTERS)])
    steps = steps.withColumn("__before", bits).withColumn("__own", own)

    def total(field: str, wanted) -> Column:
        return F.aggregate("__m", F.lit(0).cast("long"), lambda sum_, m: sum_ + F.when(wanted(m["fails"]), m[field]).otherwise(F.lit(0)).cast("long"))

    fails_now = lambda m: m.bitwiseAND(F.col("__own")) != 0
    left = lambda m: m.bitwiseAND(F.col("__before")) == 0
    # A document is removed by a filter in every order in which it stands first of those it fails.
    share = F.aggregate("__m", F.lit(0).cast("long"), lambda sum_, m: sum_ + F.when(fails_now(m["fails"]), m["n"] * F.floor(F.lit(len(orders)) / F.bit_count(m["fails"]))).otherwise(F.lit(0)).cast("long"))
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        total("n", lambda m: left(m) & ~fails_now(m)).alias("kept"),
        total("n", lambda m: left(m) & fails_now(m)).alias("removed"),
        total("n", lambda m: ~left(m) & fails_now(m)).alias("redundant"),
        total("n", lambda m: m == F.col("__own")).alias("unique_fails"),
        total("good", lambda m: left(m) & fails_now(m)).alias("good_lost"),
        total("toxic", lambda m: left(m) & fails_now(m)).alias("toxic_lost"),
        share.alias("shapley"),
    )
