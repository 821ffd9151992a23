"""SentencePiece ids of whole texts by vectorised merge rounds, and back.

A model of the byte-pair kind merges, of all neighbouring symbols that join to a piece,
those of the best score first, the leftmost first among equals. The words of a batch
lie in one flat numpy array of symbols. In each round every word finds the least rank
among its pairs (a segmented minimum), all its pairs of that rank merge at once, from the
left and without overlap, and the array is compacted, until no pair remains.

Two properties of the vocabulary are worked out when it is loaded, so that this gives
the library's ids for any vocabulary:

* Merging at once is merging one by one only if no merge yields a pair of the same or a
  better rank. Pieces that can (``early``) merge at one place a round, the leftmost.
* Two characters that no piece holds side by side are never merged across. Words are cut
  there, and a text is cut into words there: before a space mark, and around line breaks.

A segment of more than ``LONG`` symbols would take too many rounds; the same order is
then kept by a heap. Words of up to ``REMEMBERED`` characters are remembered between batches and
tasks, up to a bounded number; longer ones are encoded where they stand.

Limits: models of the byte-pair kind with byte fallback, without user-defined pieces, whose
normaliser is the identity with a space put in front; others are refused.

Defined cases: a null or empty text has no ids; characters outside the vocabulary become
their UTF-8 bytes; rows that repeat an id each get their own result; an empty table gives
an empty result; encoding reads only id and text, decoding carries all columns along.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tallymark.llm.store import id_and_text
from tallymark.llm.words import text_slices

SPACE = "▁"
LONG = 256
REMEMBERED = 64
KEEP_WORDS = 200_000
NONE = np.int32(2**31 - 1)

_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_UNITS_AND_BREAKS = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


class Vocabulary:
    """Ids, ranks of pairs and cuts of one model."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        self.is_byte = np.array([model.is_byte(i) for i in range(size)])
        self.is_control = np.array([model.is_control(i) for i in range(size)])
        self.unknown = {i for i in range(size) if model.is_unknown(i)}
        self.surface = {i: model.decode([i]) for i in self.unknown}
        probe = "Ａﬁ  a "
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE) or self.is_byte.sum() != 256:
            raise ValueError("only models with byte fallback and the identity as normaliser, with a space in front")
        self.bytes_id = np.zeros(256, dtype=np.int32)
        for i in np.flatnonzero(self.is_byte).tolist():
            self.bytes_id[int(self.pieces[i][3:5], 16)] = i
        ids = {p: i for i, p in enumerate(self.pieces) if not special[i] and not self.is_byte[i]}
        scores = np.array([model.get_score(i) for i in range(size)])
        rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.of_char = np.full(0x110000, -1, dtype=np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        self.size = size
        beside = {(p[i], p[i + 1]) for p in ids for i in range(len(p) - 1)}
        self.beside = np.unique(np.array([ord(a) << 21 | ord(b) for a, b in beside], dtype=np.int64))
        self.words_begin = all(a == SPACE or b != SPACE for a, b in beside)
        self.breaks = not any("\n" in pair for pair in beside)
        # Every way to make a piece of two others, by the pair's number.
        made = [(ids[p[:i]] * size + ids[p[i:]], at) for p, at in ids.items() for i in range(1, len(p)) if p[:i] in ids and p[i:] in ids]
        pairs = np.array(made, dtype=np.int64).reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0])]
        self.pair, self.merged = pairs[:, 0].copy(), pairs[:, 1].astype(np.int32)
        self.rank = rank[self.merged]
        # Symbols after whose making a pair of the same or a better rank may stand.
        self.early = np.zeros(size, dtype=bool)
        for side in (self.pair // size, self.pair % size):
            self.early[side[self.rank <= rank[side]]] = True

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``NONE``: they do not join) and the symbol it makes."""
        known = (left >= 0) & (right >= 0)
        key = np.where(known, left.astype(np.int64) * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.pair, key), max(len(self.pair) - 1, 0))
        found = self.pair[at] == key if len(self.pair) else np.zeros(len(key), bool)
        return np.where(found, self.rank[at], NONE), np.where(found, self.merged[at], -1)

    def units(self, text: str) -> list[str]:
        """A text's words, with the space marks before them; joined they are the text."""
        marked = SPACE + text.replace(" ", SPACE)
        if not self.words_begin:
            return [marked]
        if not self.breaks:
            return _UNITS.findall(marked)
        if SPACE + SPACE in marked or SPACE + "\n" in marked or "\0" in marked:
            return _UNITS_AND_BREAKS.findall(marked)
        return marked.replace(SPACE, "\0" + SPACE).replace("\n", "\0\n\0").split("\0")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=1)
def remembered(path: str) -> dict[str, bytes]:
    """Words and ids that a worker carries from one task to its next."""
    return {}


def _starts(owner: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, np.int64)


def _from_the_left(hit: np.ndarray) -> np.ndarray:
    """Of hits in a row every second one, the first included: merges that do not overlap."""
    at = np.flatnonzero(hit)
    first = np.concatenate(([True], at[1:] != at[:-1] + 1))
    begin = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
    out = np.zeros(len(hit), dtype=bool)
    out[at[(np.arange(len(at)) - begin) % 2 == 0]] = True
    return out


def merge_rounds(symbols: np.ndarray, owner: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Symbols left of each segment, and the place where each began; ``owner`` names segments."""
    place = np.arange(len(symbols))
    out = np.full(len(symbols), NONE, dtype=np.int64)
    rank, made = vocab.look_up(symbols, np.append(symbols[1:], -1))
    rank[np.append(owner[1:] != owner[:-1], True)[: len(rank)]] = NONE
    while len(symbols):
        begins = _starts(owner)
        sizes = np.diff(np.append(begins, len(owner)))
        least = np.minimum.reduceat(rank, begins)
        going = np.repeat(least < NONE, sizes)
        out[place[~going]] = symbols[~going]
        symbols, owner, place, rank, made = (x[going] for x in (symbols, owner, place, rank, made))
        if not len(symbols):
            break
        sizes, least = sizes[least < NONE], least[least < NONE]
        hit = rank == np.repeat(least, sizes)
        begins = np.cumsum(sizes) - sizes
        single = np.logical_or.reduceat(hit & vocab.early[made], begins)
        if single.any():
            nth = np.cumsum(hit)
            before = np.repeat(nth[begins] - hit[begins], sizes)
            hit &= ~np.repeat(single, sizes) | (nth - before == 1)
        hit = _from_the_left(hit)
        symbols[hit] = made[hit]
        keep = ~np.concatenate(([False], hit[:-1]))
        changed = (hit | np.append(hit[1:], False) | np.append(np.append(hit[2:], False), False)[: len(hit)])[keep]
        symbols, owner, place, rank, made = (x[keep] for x in (symbols, owner, place, rank, made))
        at = np.flatnonzero(changed)
        after = np.minimum(at + 1, len(symbols) - 1)
        joined = (at + 1 < len(symbols)) & (owner[at] == owner[after])
        new_rank, new_made = vocab.look_up(symbols[at], symbols[after])
        rank[at], made[at] = np.where(joined, new_rank, NONE), np.where(joined, new_made, -1)
    left = np.flatnonzero(out != NONE)
    return out[left], left


def merge_by_heap(symbols: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The same for one long segment: pairs in order of rank and place."""
    count = len(symbols)
    held: list[int | None] = symbols.tolist()
    following, before = list(range(1, count + 1)), list(range(-1, count - 1))
    rank, made = vocab.look_up(symbols[:-1], symbols[1:])
    heap = [(r, i, i + 1, a, b, m) for i, (r, a, b, m) in enumerate(zip(rank.tolist(), held, held[1:], made.tolist(), strict=False)) if r < NONE]
    heapq.heapify(heap)
    keys: dict[tuple[int, int], tuple[int, int]] = {}

    def offer(left: int, right: int) -> None:
        if left < 0 or right >= count:
            return
        pair = (held[left], held[right])
        if pair not in keys:
            r, m = vocab.look_up(np.array(pair[:1]), np.array(pair[1:]))
            keys[pair] = (int(r[0]), int(m[0]))
        r, m = keys[pair]
        if r < NONE:
            heapq.heappush(heap, (r, left, right, *pair, m))

    while heap:
        _, left, right, a, b, m = heapq.heappop(heap)
        if held[left] != a or held[right] != b or following[left] != right:
            continue
        held[left], held[right] = m, None
        following[left] = following[right]
        if following[right] < count:
            before[following[right]] = left
        offer(before[left], left)
        offer(left, following[left])
    left = np.array([i for i, s in enumerate(held) if s is not None])
    return np.array([held[i] for i in left.tolist()], dtype=np.int64), left


def encode_words(words: list[str], vocab: Vocabulary) -> list[bytes]:
    """Ids of each word, as little-endian 32-bit numbers."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    chars = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    if not len(chars):
        return [b""] * len(words)
    symbols = vocab.of_char[chars]
    cut = np.zeros(len(chars), dtype=bool)
    begins = np.cumsum(lengths) - lengths
    cut[begins[lengths > 0]] = True
    key = chars[:-1] << 21 | chars[1:]
    at = np.minimum(np.searchsorted(vocab.beside, key), max(len(vocab.beside) - 1, 0))
    cut[1:] |= (vocab.beside[at] != key) if len(vocab.beside) else True
    owner = np.cumsum(cut)
    # Characters without a symbol are named by their code, below -1.
    symbols = np.where(symbols < 0, -2 - chars, symbols)
    sizes = np.diff(np.append(np.flatnonzero(cut), len(chars)))
    long = np.repeat(sizes > LONG, sizes)
    found, place = merge_rounds(symbols[~long], owner[~long], vocab)
    place = np.flatnonzero(~long)[place]
    if long.any():
        parts = [(found, place)]
        for begin, size in zip(np.flatnonzero(cut)[sizes > LONG].tolist(), sizes[sizes > LONG].tolist(), strict=True):
            merged, at = merge_by_heap(symbols[begin : begin + size], vocab)
            parts.append((merged, at + begin))
        found, place = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(place)
        found, place = found[order], place[order]
    ids, count = _with_bytes(found, vocab)
    ends = np.append(0, np.cumsum(count))[np.searchsorted(place, np.append(begins, len(chars)))] * 4
    packed = ids.astype("<u4").tobytes()
    return [packed[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _with_bytes(symbols: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of symbols, with the bytes of characters that have none, and how many each gave."""
    count = np.ones(len(symbols), dtype=np.int64)
    unknown = np.flatnonzero(symbols < 0)
    if not len(unknown):
        return symbols, count
    names, which = np.unique(-2 - symbols[unknown], return_inverse=True)
    spelled = [chr(c).encode("utf-8") for c in names.tolist()]
    table = np.zeros((len(names), 4), dtype=np.int64)
    for row, letters in enumerate(spelled):
        table[row, : len(letters)] = vocab.bytes_id[list(letters)]
    count[unknown] = np.array([len(s) for s in spelled])[which]
    out = np.repeat(symbols, count)
    first = (np.cumsum(count) - count)[unknown]
    for nth in range(4):
        has = count[unknown] > nth
        out[first[has] + nth] = table[which[has], nth]
    return out, count


class SymbolEncoder:
    """Ids of texts; words met before are looked up."""

    def __init__(self, path: str, memory: dict[str, bytes] | None = None, keep: int = KEEP_WORDS):
        self.vocab, self.keep = vocabulary(path), keep
        self.memory = {} if memory is None else memory

    def __call__(self, texts: Iterable[str | None]) -> list[bytes]:
        parted = [self.vocab.units(t) if t else [] for t in texts]
        memory = self.memory
        new = list(set().union(*parted).difference(memory))
        if len(memory) + len(new) > self.keep:  # the older half stays, which holds the common ones
            older = list(islice(memory.items(), self.keep // 2))
            memory.clear()
            memory.update(older)
            new = list(set().union(*parted).difference(memory))
        short = [w for w in new if len(w) <= REMEMBERED]
        memory.update(zip(short, encode_words(short, self.vocab), strict=True))
        if len(short) < len(new):
            long = [w for w in new if len(w) > REMEMBERED]
            once = dict(zip(long, encode_words(long, self.vocab), strict=True))
            return [b"".join([memory[w] if len(w) <= REMEMBERED else once[w] for w in words]) for words in parted]
        get = memory.__getitem__
        return [b"".join(map(get, words)) for words in parted]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``ids``, the whole text's token ids as an array."""

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = SymbolEncoder(path, remembered(path))
        for batch in text_slices(batches):
            packed = encoder(batch.column("__text").to_pylist())
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
            values = np.frombuffer(b"".join(packed), dtype="<i4")
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=["__id", "ids"])

    rows = id_and_text(docs, id_col, text_col)
    out = rows.mapInArrow(ids, f"__id {rows.schema['__id'].dataType.simpleString()}, ids array<int>")
    return out.withColumnRenamed("__id", id_col)


def _read_bytes(run: bytes) -> str:
    """Bytes as text; each byte that begins no character is replaced for itself."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at : at + size].decode("utf-8"))
            except UnicodeDecodeError:
                continue
            at += size
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


class SymbolDecoder:
    """Texts of ids, as the library gives them."""

    def __init__(self, path: str):
        self.vocab = vocab = vocabulary(path)
        self.spelled = [p.replace(SPACE, " ").encode("utf-8") for p in vocab.pieces]
        for i in np.flatnonzero(vocab.is_byte).tolist():
            self.spelled[i] = bytes([int(vocab.pieces[i][3:5], 16)])
        for i in np.flatnonzero(vocab.is_control).tolist():
            self.spelled[i] = b""
        for i, surface in vocab.surface.items():
            self.spelled[i] = surface.encode("utf-8")
        self.leads = {i for i, p in enumerate(vocab.pieces) if p.startswith(SPACE)}
        self.controls = frozenset(np.flatnonzero(vocab.is_control).tolist())

    def __call__(self, ids: list[int]) -> str:
        if ids and (min(ids) < 0 or max(ids) >= len(self.spelled)):
            raise ValueError("an id outside the vocabulary")
        whole = b"".join(map(self.spelled.__getitem__, ids))
        first = next((i for i in ids if i not in self.controls), None)
        skip = 1 if first in self.leads else 0
        if not self.controls.isdisjoint(ids):
            return self._by_runs(ids, skip)
        try:
            return whole[skip:].decode("utf-8")
        except UnicodeDecodeError:
            return self._by_runs(ids, skip)

    def _by_runs(self, ids: list[int], skip: int) -> str:
        """Bytes join only to bytes beside them."""
        out, run = [], b""
        for i in ids:
            if self.vocab.is_byte[i]:
                run += self.spelled[i]
                continue
            out += (_read_bytes(run), self.spelled[i].decode("utf-8"))
            run = b""
        return ("".join(out) + _read_bytes(run))[skip:]


def decode(coded: DataFrame, path: str, ids_col: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns and the text of the ids; null ids give an empty text."""
    place = coded.columns.index(ids_col)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = SymbolDecoder(path)
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                column = batch.column(place)
                ends = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).cumsum().tolist()
                flat = column.flatten().to_numpy(zero_copy_only=False)
                out = [read(flat[a:b].tolist()) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, text])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)
    return coded.mapInArrow(texts, f"{fields}, `{text}` string")
