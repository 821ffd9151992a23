"""Words of texts and their hashes, a batch of texts at a time.

A word is a run of characters other than space and the controls 9 to 13. Hashes are
64 bits and depend on the word's UTF-8 bytes alone, so they agree between processes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD6E8FEB86659FD93 | 1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of a base and of its inverse, grown when a longer batch comes."""

    def __init__(self, base: np.uint64):
        self.base, self.up, self.down = base, _powers(base, 0), _powers(_inverse(base), 0)

    def need(self, count: int) -> None:
        if len(self.up) <= count:
            count = max(count + count // 4, 1 << 16)
            self.up, self.down = _powers(self.base, count), _powers(_inverse(self.base), count)


_BYTES, _WORDS = Powers(_BASE), Powers(_STEP)


@dataclass
class Spans:
    """Words of some texts in one buffer: where they start and end, and their hashes.

    ``begins`` says for each text which word is its first, with one more at the end.
    """

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    begins: np.ndarray
    sums: np.ndarray

    def gram(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes from each place."""
        return (self.sums[at + size] - self.sums[at]) * _BYTES.down[at]


def word_spans(texts: list[str | None]) -> Spans:
    parts = [(t or "").encode("utf-8", "replace") for t in texts]
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    buffer = np.frombuffer(b" " + b" ".join(parts) + b" ", dtype=np.uint8)
    space = _SPACE[buffer]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    _BYTES.need(len(buffer))
    sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum(buffer.astype(np.uint64) * _BYTES.up[: len(buffer)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _BYTES.down[starts] + (ends - starts).astype(np.uint64))
    begins = np.searchsorted(starts, np.concatenate(([1], 1 + np.cumsum(lengths + 1))))
    return Spans(starts, ends, hashes, begins, sums)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text where its words begin; one more at the end."""
    spans = word_spans(texts)
    return spans.hashes, spans.begins


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words; element i starts at word i.

    Grams that run over a text's end are hashed too; the caller leaves them out.
    """
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    _WORDS.need(len(hashes))
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _WORDS.up[: len(hashes)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * _WORDS.down[:count])


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "__text", most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most_bytes`` of text; a longer text stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for at, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield batch.slice(begin, at - begin)
                begin, held = at, 0
            held += int(size) + 64
        if begin < batch.num_rows:
            yield batch.slice(begin)


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return values.view(np.int64)
