"""Pack tokenised documents into as few sequences of bounded length as possible.

Pieces are dealt into groups of about ``group_tokens`` tokens. Each group is packed
best-fit first and then improved by local search: documents move, or are exchanged one
for one, two for one and one for two, from emptier bins to fuller ones. Every step
raises the sum of squared fills, until bins become empty and drop out. Bins that stay
below ``full`` are opened again and packed together with those of other groups, until
one group holds what is left. Only lengths and numbers travel; the text never does.

Defined cases: a null or empty text is a document of the end id alone; a document longer
than a sequence is cut into whole pieces and a last, shorter one; repeated ids and rows
are packed each for itself; ties in length go by row number, so a repeated run gives the
same packing; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.bpe import WordEncoder, bare_units, remembered
from tallymark.llm.store import id_and_text, pieces_of, settle
from tallymark.llm.words import text_slices

LENGTH = 4096
#: Words that a worker remembers between its tasks; no other table lies beside them.
KEEP_WORDS = 800_000


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``__id``, ``piece``, ``start``, ``length``, ``ids_crc32``."""
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path, bare_units, fold=True, keep=KEEP_WORDS, memory=remembered(path, "bare_units, folded"))
        for batch in text_slices(batches):
            rows, at = [], []
            for row, packed in enumerate(encoder(batch.column("__text").to_pylist())):
                packed += end
                for number, begin in enumerate(range(0, len(packed), 4 * length)):
                    part = packed[begin : begin + 4 * length]
                    rows.append((number, begin // 4, len(part) // 4, zlib.crc32(part)))
                    at.append(row)
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id").take(pa.array(at, pa.int64())), pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                names=["__id", "piece", "start", "length", "ids_crc32"],
            )

    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(cut, f"__id {rows.schema['__id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint")


class Bins:
    """Bins of one group: which items each holds and how full it is."""

    def __init__(self, sizes: list[int], room: int):
        self.sizes, self.room = sizes, room
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        self._best_fit()

    def _best_fit(self) -> None:
        """Longest first, each into the fullest bin that has room."""
        free: list[tuple[int, int]] = []  # (room left, bin), ascending
        for item in sorted(range(len(self.sizes)), key=lambda i: (-self.sizes[i], i)):
            size = self.sizes[item]
            at = bisect.bisect_left(free, (size, -1))
            if at < len(free):
                left, number = free.pop(at)
            else:
                left, number = self.room, len(self.items)
                self.items.append([])
                self.fill.append(0)
            self.items[number].append(item)
            self.fill[number] += size
            if left > size:
                bisect.insort(free, (left - size, number))

    def improve(self) -> None:
        """Empty the emptiest bins, one after another, as long as that succeeds."""
        while True:
            open_bins = sorted((b for b in range(len(self.items)) if 0 < self.fill[b] < self.room), key=lambda b: (self.fill[b], b))
            spare = sum(self.room - self.fill[b] for b in open_bins)
            if len(open_bins) < 2 or spare < self.room or not self._drain(open_bins[0], open_bins[1:]):
                return

    def _drain(self, giver: int, takers: list[int]) -> bool:
        """Shift length from one bin to fuller ones; true once it is empty.

        Each exchange makes a fuller bin fuller still, so squared fill rises and the
        search ends. What it has shifted stays, whether or not the bin becomes empty.
        """
        moved = True
        while moved and self.items[giver]:
            moved = False
            for taker in reversed(takers):
                if self.room > self.fill[taker] >= self.fill[giver] and self._shift(giver, taker):
                    moved = True
                    if not self.items[giver]:
                        return True
        return not self.items[giver]

    def _shift(self, giver: int, taker: int) -> bool:
        """The best single exchange between two bins, if any adds to the taker."""
        sizes, free = self.sizes, self.room - self.fill[taker]
        gives = sorted((sizes[i], i) for i in self.items[giver])
        ours = [g[0] for g in gives]
        best, gain = None, 0

        def offer(out: tuple[int, ...], lost: int) -> None:
            """One or two items in for what goes out; the most that fits."""
            nonlocal best, gain
            most = lost + free
            at = bisect.bisect_right(ours, most) - 1
            if at >= 0 and ours[at] - lost > gain:
                best, gain = (out, (gives[at][1],)), ours[at] - lost
            if len(out) == 1:
                low, high = 0, len(ours) - 1
                while low < high:
                    both = ours[low] + ours[high]
                    if both > most:
                        high -= 1
                        continue
                    if both - lost > gain:
                        best, gain = (out, (gives[low][1], gives[high][1])), both - lost
                    low += 1

        offer((), 0)
        held = self.items[taker]
        for i in held:
            if gain == free:
                break
            offer((i,), sizes[i])
        for a in range(len(held)):
            if gain == free:
                break
            for b in range(a + 1, len(held)):
                offer((held[a], held[b]), sizes[held[a]] + sizes[held[b]])
        if best is None:
            return False
        out, into = best
        self.items[taker] = [i for i in held if i not in out] + list(into)
        self.items[giver] = [i for i in self.items[giver] if i not in into] + list(out)
        self.fill[taker] += gain
        self.fill[giver] -= gain
        return True


def pack_group(sizes: list[int], room: int) -> tuple[list[int], list[int], list[int]]:
    """Per item: its bin, its offset in the bin, and the bin's fill."""
    bins = Bins(sizes, room)
    bins.improve()
    number, offset, fill = [0] * len(sizes), [0] * len(sizes), [0] * len(sizes)
    for b, items in enumerate(bins.items):
        at = 0
        for i in items:
            number[i], offset[i], fill[i] = b, at, bins.fill[b]
            at += sizes[i]
    return number, offset, fill


def pack(cut: DataFrame, length: int = LENGTH, group_tokens: int = 1 << 20, full: float = 0.995) -> DataFrame:
    """All columns of ``cut`` (with a ``length``), and ``sequence_id`` and ``offset``."""
    rows = settle(cut.withColumn("__row", F.monotonically_increasing_id()))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("__row", kind="stable")
        number, offset, fill = pack_group(frame["length"].tolist(), length)
        first = frame["__row"].to_numpy()
        # A sequence is named by the row that begins it: no two sequences share one.
        name = np.zeros(max(number, default=-1) + 1, dtype=np.int64)
        for row, b, at in zip(first, number, offset, strict=True):
            if at == 0:
                name[b] = row
        return pd.DataFrame({"__row": first, "length": frame["length"].to_numpy(), "sequence_id": name[number] if len(frame) else name, "offset": offset, "fill": fill})

    left, done = rows.select("__row", "length"), None
    while True:
        total = left.agg(F.sum("length").alias("t")).first()["t"]
        groups = pieces_of(total, group_tokens)
        packed = settle(
            left.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
            .groupBy("__group")
            .applyInPandas(place, "__row bigint, length bigint, sequence_id bigint, offset bigint, fill bigint")
        )
        if groups > 1:
            keep, left = packed.where(F.col("fill") >= full * length), packed.where(F.col("fill") < full * length).select("__row", "length")
            again = pieces_of(left.agg(F.sum("length").alias("t")).first()["t"], group_tokens)
        if groups == 1 or again >= groups:
            keep, left = packed, None
        done = keep if done is None else done.unionByName(keep)
        if left is None:
            break
    found = done.select("__row", "sequence_id", "offset")
    return rows.join(found, "__row").drop("__row")
