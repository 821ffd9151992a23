"""Repeated-phrase automata: remove passages that an earlier document already holds.

A window is ``WINDOW`` consecutive words of one document. A word goes when a window
covers it whose words also start in a document with a smaller id; windows are judged on
the input. The work in four steps, each spread over all tasks:

1. Every window of every document is hashed, and short codes of the hashes are dealt into
   shards. Documents are taken in blocks of ``BLOCK`` neighbouring ids; a block sends a
   code once, so a passage that a third of the documents hold is combined first.
2. A shard finds the codes that several blocks hold. Codes only nominate: the first
   block is asked for the passage, once for each group of documents that may repeat it.
   (Two windows of a shard share a code of 48 bits with a chance of about one in 10^14
   per pair; only then could a first holder be overlooked.)
3. The asked group confirms by its text: it looks the windows up in its documents, joins
   neighbouring ones to passages, and sends the passages' words.
4. Each group of documents compiles a shard of the automaton, from the passages it was
   sent and the windows its own documents share, and streams all its documents through
   it. A match is of words, so a chance agreement of codes removes nothing.

Steps 3 and 4 read one and the same shuffle of the texts. A shard's and a group's size
are fixed, and their number grows with the corpus.

Defined cases: a null text has no words; texts shorter than a window stay; a text that
loses nothing stays as it is, white space included, and one that does is its kept words
joined by one space; ids are integers, a null id counts as the smallest; rows that repeat
an id are one document for the comparison and keep their rows; an empty table gives an
empty result; all columns pass through, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.store import pieces_of
from tallymark.llm.words import gram_hashes, text_slices, word_hashes

WINDOW = 13
BLOCK = 64
BATCH_BYTES = 1 << 23
SHARD_BYTES = 1 << 23
GROUP_BYTES = 1 << 21
NO_ID = -(1 << 63)
#: Blocks of rows without an id stand before the block of the smallest id.
NO_BLOCK = -(1 << 58)


def _windows(texts: list[str | None], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and first word (within the text) of every window."""
    hashes, begins = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    grams = gram_hashes(hashes, window)
    if not len(grams):
        return grams, owner[:0], owner[:0]
    inside = owner[: len(grams)] == owner[window - 1 :]
    return grams[inside], owner[: len(grams)][inside], (np.arange(len(grams)) - begins[owner[: len(grams)]])[inside]


def _codes(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard, and a code of 48 bits within it."""
    return (hashes % np.uint64(shards)).astype(np.int64), hashes >> np.uint64(16)


def _pack(codes: np.ndarray) -> bytes:
    return np.ascontiguousarray(codes).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).reshape(-1)


def _keys(shard: np.ndarray | int, codes: np.ndarray) -> np.ndarray:
    return codes | np.uint64(shard) << np.uint64(48) if isinstance(shard, int) else codes | shard.astype(np.uint64) << np.uint64(48)


#: Two odd multipliers below the prime, whose products stay within a long.
_PRIME, _SPREAD = (1 << 31) - 1, (1327217885, 741103597)


def _group_of(block: np.ndarray, groups: int) -> np.ndarray:
    """The group of a block of ids, whatever the stride of the ids; the same rule as ``_group``."""
    first = np.mod(block, _PRIME) * _SPREAD[0] % _PRIME
    return (first ^ (first >> 16)) % _PRIME * _SPREAD[1] % _PRIME % groups


def _group(block: Column, groups: int) -> Column:
    first = F.pmod(block, F.lit(_PRIME)) * F.lit(_SPREAD[0]) % F.lit(_PRIME)
    return (first.bitwiseXOR(F.shiftright(first, 16)) % F.lit(_PRIME) * F.lit(_SPREAD[1]) % F.lit(_PRIME) % F.lit(groups)).cast("int")


def _block(key: Column, text: Column) -> Column:
    """Neighbouring ids; rows without an id are dealt by their text, into blocks before all others."""
    return F.when(key.isNull(), F.lit(NO_BLOCK) - F.pmod(F.xxhash64(text), F.lit(1 << 40))).otherwise(F.floor(key / F.lit(BLOCK)).cast("long"))


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).to_numpy(zero_copy_only=False).astype(np.int64)


def window_codes(rows: DataFrame, shards: int, window: int) -> DataFrame:
    """Step 1: per batch and shard, the distinct codes of each block of ids."""

    def emit(blocks_of: list[np.ndarray], texts: list[str | None]) -> Iterator[pa.RecordBatch]:
        block = np.concatenate(blocks_of)
        order = np.argsort(block, kind="stable")
        names, begins = np.unique(block[order], return_index=True)
        found, place = [], []
        for number, members in enumerate(np.split(order, begins[1:])):
            hashes = np.unique(_windows([texts[i] for i in members], window)[0])
            found.append(hashes)
            place.append(np.full(len(hashes), number))
        shard, code = _codes(np.concatenate(found), shards)
        place = np.concatenate(place)
        deal = np.argsort(shard, kind="stable")
        shard, code, place = shard[deal], code[deal], place[deal]
        held, first = np.unique(shard, return_index=True)
        last = np.append(first[1:], len(shard))[: len(first)]
        out = []
        for a, b in zip(first, last, strict=True):
            blocks, counts = np.unique(place[a:b], return_counts=True)
            out.append((names[blocks].tobytes(), counts.astype(np.int32).tobytes(), _pack(code[a:b])))
        columns = list(zip(*out, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], names=["shard", "blocks", "counts", "codes"])

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, texts, size = [], [], 0
        for batch in text_slices(batches):
            blocks.append(_ids(batch.column("__b")))
            texts += batch.column("__text").to_pylist()
            size += batch.column("__text").nbytes
            if size > BATCH_BYTES:
                yield from emit(blocks, texts)
                blocks, texts, size = [], [], 0
        if texts:
            yield from emit(blocks, texts)

    return rows.select("__b", "__text").mapInArrow(codes, "shard int, blocks binary, counts binary, codes binary")


def nominate(codes: DataFrame, groups: int) -> DataFrame:
    """Step 2: which group must show which codes of a block, and to whom."""

    def shared(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        code = np.concatenate([_unpack(c) for c in frame["codes"]])
        counts = np.concatenate([np.frombuffer(c, np.int32) for c in frame["counts"]])
        block = np.repeat(np.concatenate([np.frombuffer(b, np.int64) for b in frame["blocks"]]), counts)
        order = np.lexsort((block, code))
        code, block = code[order], block[order]
        begins = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        first = np.repeat(block[begins], np.diff(np.append(begins, len(code))))
        asks = block != first
        code, first, target = code[asks], first[asks], _group_of(block[asks], groups).astype(np.int32)
        asked = _group_of(first, groups).astype(np.int32)
        order = np.lexsort((target, code, asked))
        code, first, target, asked = code[order], first[order], target[order], asked[order]
        new = np.ones(len(code), dtype=bool)
        new[1:] = (code[1:] != code[:-1]) | (target[1:] != target[:-1]) | (asked[1:] != asked[:-1])
        code, first, target, asked = code[new], first[new], target[new], asked[new]
        names, begins = np.unique(asked, return_index=True)
        ends = np.append(begins[1:], len(asked))[: len(begins)]
        return pd.DataFrame({
            "__g": names, "shard": np.full(len(names), shard),
            "blocks": [first[a:b].tobytes() for a, b in zip(begins, ends, strict=True)],
            "codes": [_pack(code[a:b]) for a, b in zip(begins, ends, strict=True)],
            "targets": [target[a:b].tobytes() for a, b in zip(begins, ends, strict=True)],
        })

    return codes.groupBy("shard").applyInPandas(shared, "__g int, shard int, blocks binary, codes binary, targets binary")


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def _show(shards: int, window: int):
    """Step 3: the passages asked for, as words of the first document that holds them."""
    schema = pa.schema([("__g", pa.int32()), ("owner", pa.int64()), ("passage", pa.binary())])

    def show(docs: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows or not docs.num_rows:
            return schema.empty_table()
        want = {"block": [], "key": [], "target": []}
        for shard, blocks, codes, targets in zip(*(asked.column(c).to_pylist() for c in ("shard", "blocks", "codes", "targets")), strict=True):
            want["block"].append(np.frombuffer(blocks, np.int64))
            want["key"].append(_keys(shard, _unpack(codes)))
            want["target"].append(np.frombuffer(targets, np.int32))
        block, key, target = (np.concatenate(want[c]) for c in ("block", "key", "target"))
        all_ids, all_blocks = _ids(docs.column("__id")), _ids(docs.column("__b"))
        order = np.argsort(all_ids, kind="stable")
        chosen = order[np.isin(all_blocks[order], block)]
        ids, blocks = all_ids[chosen], all_blocks[chosen]
        texts = docs.column("__text").take(pa.array(chosen)).to_pylist()
        hashes, owner, place = _windows(texts, window)
        own = _keys(*_codes(hashes, shards))
        # The first document of a block for each of its windows: texts stand in order of id.
        at = np.flatnonzero(np.isin(own, key))
        order = np.lexsort((at, hashes[at], blocks[owner[at]]))
        ordered = at[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (hashes[ordered][1:] != hashes[ordered][:-1]) | (blocks[owner[ordered]][1:] != blocks[owner[ordered]][:-1])
        at = np.sort(ordered[new])
        frame = pd.DataFrame({"key": own[at], "block": blocks[owner[at]], "text": owner[at], "place": place[at]})
        hit = frame.merge(pd.DataFrame({"key": key, "block": block, "target": target}), on=["key", "block"]).sort_values(["target", "text", "place"])
        if not len(hit):
            return schema.empty_table()
        target, text, place = hit["target"].to_numpy(), hit["text"].to_numpy(), hit["place"].to_numpy()
        begins = np.flatnonzero(np.concatenate(([True], (target[1:] != target[:-1]) | (text[1:] != text[:-1]) | (place[1:] != place[:-1] + 1))))
        ends = np.append(begins[1:], len(place)) - 1
        held: dict[int, list[bytes]] = {}
        passages = []
        for a, b in zip(begins, ends, strict=True):
            words = held.get(text[a])
            if words is None:
                words = held[text[a]] = _words(texts[text[a]])
            passages.append(b" ".join(words[place[a] : place[b] + window]))
        return pa.Table.from_arrays([pa.array(target[begins], pa.int32()), pa.array(ids[text[begins]], pa.int64()), pa.array(passages, pa.binary())], schema=schema)

    return show


def _spelled(codes: np.ndarray, letters: int) -> str:
    """Each word number as two characters; 0 is a word of no pattern.

    A node of the automaton looks through its children one by one, so an alphabet of the
    root of the vocabulary is far faster than one of all words.
    """
    pairs = np.stack([codes // letters, codes % letters], axis=1).reshape(-1) + 1
    return (pairs + 0x800 * (pairs >= 0xD800)).astype("<u4").tobytes().decode("utf-32-le")


def covered_words(ids: np.ndarray, words: list[list[bytes]], passages: list[tuple[int, list[bytes]]], window: int, repeated: np.ndarray, owner: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Step 4 for one group: which words of each document go.

    ``repeated``, ``owner`` and ``place`` name the windows that several of the documents
    share; ``passages`` come from documents with smaller ids outside the group. Words of
    the patterns are numbered, so a text is a string of numbers to the automaton.
    """
    gone = [np.zeros(len(text), dtype=bool) for text in words]
    own: dict[int, list[int]] = {}
    for at in np.flatnonzero(repeated).tolist():
        own.setdefault(int(owner[at]), []).append(int(place[at]))
    numbers: dict[bytes, int] = {}
    sources = [(holder, passage, range(len(passage) - window + 1)) for holder, passage in passages]
    sources += [(int(ids[text]), words[text], sorted(places)) for text, places in own.items()]
    for _, held, places in sources:
        if isinstance(places, range):
            wanted = held
        else:
            mask = np.zeros(len(held) + 1, dtype=np.int64)
            np.add.at(mask, places, 1)
            np.add.at(mask, np.array(places) + window, -1)
            wanted = [held[i] for i in np.flatnonzero(np.cumsum(mask)[:-1]).tolist()]
        for word in wanted:
            if word not in numbers:
                numbers[word] = len(numbers) + 1
    if not numbers:
        return gone
    letters = math.isqrt(len(numbers)) + 1
    number = numbers.get
    spelled = [_spelled(np.fromiter((number(w, 0) for w in text), np.int64, len(text)), letters) for text in words]
    first: dict[str, int] = {}
    texts = list(own)
    for at, (holder, held, places) in enumerate(sources):
        text = _spelled(np.fromiter((number(w, 0) for w in held), np.int64, len(held)), letters) if at < len(passages) else spelled[texts[at - len(passages)]]
        for begin in places:
            key = text[2 * begin : 2 * (begin + window)]
            if first.setdefault(key, holder) > holder:
                first[key] = holder
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    holders = list(first.values())
    for at, key in enumerate(first):
        automaton.add_word(key, at)
    automaton.make_automaton()
    for at, text in enumerate(spelled):
        found = np.array(list(automaton.iter(text)), dtype=np.int64).reshape(-1, 2) if len(text) >= 2 * window else np.zeros((0, 2), np.int64)
        if len(found):
            earlier = np.fromiter((holders[i] < ids[at] for i in found[:, 1].tolist()), bool, len(found))
            ends = found[earlier & (found[:, 0] % 2 == 1), 0] // 2 + 1
            steps = np.zeros(len(words[at]) + 1, dtype=np.int64)
            np.add.at(steps, ends - window, 1)
            np.add.at(steps, ends, -1)
            gone[at] = np.cumsum(steps)[:-1] > 0
    return gone


def _apply(window: int, schema: pa.Schema, text_at: int):
    """Step 4: the rows with their kept text, the number of words and of words removed."""

    def apply(docs: pa.Table, sent: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        ids = _ids(docs.column("__id"))
        texts = docs.column("__text").to_pylist()
        words = [_words(t) for t in texts]
        hashes, owner, place = _windows(texts, window)
        order = np.lexsort((ids[owner], hashes)) if len(hashes) else np.zeros(0, np.int64)
        ordered, holder = hashes[order], ids[owner[order]]
        repeated = np.zeros(len(hashes), dtype=bool)
        if len(order):
            begins = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            several = holder[begins] != holder[np.append(begins[1:], len(order)) - 1]
            repeated[order[begins[several]]] = True  # the one with the smallest id
        passages = list(zip(sent.column("owner").to_pylist(), (p.split(b" ") for p in sent.column("passage").to_pylist()), strict=True))
        gone = covered_words(ids, words, passages, window, repeated, owner, place)
        kept = [b" ".join(w for w, g in zip(held, mask.tolist(), strict=True) if not g).decode("utf-8") if mask.any() else text for text, held, mask in zip(texts, words, gone, strict=True)]
        columns = [pa.array(kept, pa.string()) if i == text_at else docs.column(f"c{i}").combine_chunks() for i in range(len(schema) - 2)]
        columns += [pa.array([len(w) for w in words], pa.int64()), pa.array([int(m.sum()) for m in gone], pa.int64())]
        return pa.Table.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, schema, strict=True)], schema=schema)

    return apply


def drop_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", n_words: str = "__n_words", n_removed: str = "__n_removed") -> DataFrame:
    """All columns of ``docs`` with the text cut, and the two counts under the given names."""
    from pyspark.sql.pandas.types import to_arrow_schema

    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")) + F.lit(64)).alias("b")).first()["b"]
    shards, groups = pieces_of(total, SHARD_BYTES), pieces_of(total, GROUP_BYTES)
    key, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    text_at = docs.columns.index(text_col)
    # The text travels once, as __text; in its own place a null stands for it.
    carried = [F.lit(None).cast("string").alias(f"c{i}") if i == text_at else F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(F.coalesce(key, F.lit(NO_ID)).alias("__id"), _block(key, text).alias("__b"), text.alias("__text"), *carried).withColumn("__g", _group(F.col("__b"), groups))
    asked = nominate(window_codes(rows, shards, window), groups)
    fields = [T.StructField(f"c{i}", T.StringType() if i == text_at else f.dataType) for i, f in enumerate(docs.schema.fields)]
    out = T.StructType([*fields, T.StructField("__w", T.LongType()), T.StructField("__r", T.LongType())])
    by_group = rows.groupBy("__g")
    passages = by_group.cogroup(asked.groupBy("__g")).applyInArrow(_show(shards, window), "__g int, owner bigint, passage binary")
    done = by_group.cogroup(passages.groupBy("__g")).applyInArrow(_apply(window, to_arrow_schema(out), text_at), out)
    names = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return done.select(*names, F.col("__w").alias(n_words), F.col("__r").alias(n_removed))
