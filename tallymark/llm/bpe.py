"""BPE ids of whole texts from a table of distinct words, and back.

A text is split into words that the tokenizer never merges across. Words are counted in
Spark, each distinct word of the table is encoded once, and a text's ids are its words'
ids joined by position. Decoding joins ids with the table of pieces and reads the bytes.

Where the tables go: the table of pieces is as large as the vocabulary. The word table
is broadcast up to a checked bound (``table_bytes``), most frequent words first; a word
beyond the bound is encoded in the task that meets it, so the ids are whole at any size.
Carrying every word occurrence through a shuffle to a table of unbounded size would move
several times the input.

Defined cases: a null or empty text has no ids; special tokens in a text are found before
the words, as the library does by default; repeated ids and rows each get their own
result row; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice, pairwise
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.store import id_and_text, settle
from tallymark.llm.words import text_slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: White space of the tokenizers' patterns (Unicode property White_Space).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A word with the space before it, or a run of white space up to such a space.
SPACED = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: A word alone, for tokenizers that drop white space.
BARE = re.compile(f"[^{WHITE}]+")

_BREAKS = re.compile("(\n+)")
#: Characters that str.split takes for white space and the tokenizers do not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_OTHER_WHITE = "\t\x0b\x0c\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_LETTERS_AND_MARKS = re.compile(r"( ?[^\W_]+)([!-/:-@\[-`{-~]*)").fullmatch

_WHITE_BYTE, _PLAIN_BYTE, _MARK_BYTE = np.zeros((3, 256), dtype=bool)
_WHITE_BYTE[[9, 10, 11, 12, 13, 32]] = True
_PLAIN_BYTE[[b for b in range(128) if chr(b).isalnum()]] = True
_MARK_BYTE[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
#: White space beyond ASCII, as UTF-8.
_LONG_WHITE = re.compile(b"|".join(c.encode() for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") + b"|\xe2\x80[\x80-\x8a]")

#: Bytes of words and counts that a task gathers before it adds them up.
COUNTED_BYTES = 16 << 20
#: Words that a task remembers; beyond it the older half stays, which holds the common ones.
KEEP_WORDS = 400_000
#: The same where a task also holds the shared table.
KEEP_BESIDE = 200_000


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=4)
def specials(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


def spaced_units(text: str) -> list[str]:
    """Words with the space before them and runs of white space, in order."""
    if "  " in text or "\n " in text or " \n" in text or any(c in text for c in _OTHER_WHITE):
        return SPACED.findall(text)
    out: list[str] = []
    parts = _BREAKS.split(text)
    last = len(parts) - 1
    for at, part in enumerate(parts):
        if at % 2:
            if at + 1 == last and not parts[last] or len(part) == 1:
                out.append(part)
            else:
                out += (part[1:], "\n")
        elif part:
            words = part.replace(" ", "\0 ").split("\0") if "\0" not in part else SPACED.findall(part)
            out += words if words[0] else words[1:]
    return out


def spaced_spans(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """Where units start in texts that lie one after another.

    They are those of ``spaced_units``, cut again where an ASCII mark follows a letter or
    digit: a pattern that parts these never merges across, and fewer words are distinct.
    ``offsets`` are the places in ``data`` where the texts begin, and the end of the last.
    """
    size = len(data)
    bytes_ = np.frombuffer(data, dtype=np.uint8)
    white = np.append(_WHITE_BYTE[bytes_], False)
    if not data.isascii():
        for found in _LONG_WHITE.finditer(data):
            white[found.start() : found.end()] = True
    first = np.zeros(size + 1, dtype=bool)
    first[offsets] = True
    # A run of white space is a unit up to its last character, if more follows in the text.
    turns = white[1:] != white[:-1]
    into = np.flatnonzero(turns & white[1:]) + 1
    last = np.flatnonzero(turns & white[:-1] & ~first[1:])
    # Only a space, as the last character, belongs to the word behind it.
    words = last[bytes_[last] != 32] + 1
    for _ in range(2):
        last -= (bytes_[last] & 0xC0) == 0x80
    first[into] = first[last] = first[words] = True
    first[1:size] |= _PLAIN_BYTE[bytes_[:-1]] & _MARK_BYTE[bytes_[1:]]
    return np.flatnonzero(first[:size])


def bare_units(text: str) -> list[str]:
    """Words without white space, in order."""
    return BARE.findall(text) if any(c in text for c in _SEPARATORS) else text.split()


@lru_cache(maxsize=4)
def letters_tokenizer(path: str):
    """The same model for words of ASCII letters, which need no normaliser and no pattern."""
    from tokenizers import Tokenizer, pre_tokenizers

    found = Tokenizer(tokenizer(path).model)
    found.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    return found


@lru_cache(maxsize=4)
def word_ends(path: str) -> np.ndarray | None:
    """Which ids end a word, if the vocabulary marks that."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    suffix = model.get("end_of_word_suffix")
    if not suffix:
        return None
    ends = np.zeros(max(model["vocab"].values()) + 1024, dtype=bool)
    ends[[i for piece, i in model["vocab"].items() if piece.endswith(suffix)]] = True
    return ends


@lru_cache(maxsize=1)
def remembered(path: str, units: str) -> dict[str, bytes]:
    """Words and ids that a worker carries from one task to its next."""
    return {}


def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level files.

    Bytes that print stand for themselves, the others follow from 256 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


_SPELLED = np.array([ord(c) for c in _byte_letters()], dtype="<u2")


def _spelled(words: list[str]) -> list[str]:
    """Words without line breaks as a byte-level vocabulary spells them."""
    data = np.frombuffer("\n".join(words).encode(), dtype=np.uint8)
    return _SPELLED[data].tobytes().decode("utf-16-le").split(chr(_SPELLED[10]))


class WordEncoder:
    """Ids of texts, as little-endian 32-bit numbers, by way of a table of words.

    ``units`` splits a text where the tokenizer never merges. ``fold`` says that the
    tokenizer puts words in lower case, so that their table can.
    """

    def __init__(self, path: str, units: Callable[[str], list[str]] = spaced_units, fold: bool = False, table: dict[str, bytes] | None = None, keep: int = KEEP_WORDS, memory: dict[str, bytes] | None = None):
        self.path, self.units, self.fold, self.keep = path, units, fold, keep
        self.special = specials(path)
        self.names = {n: s for s, n in self.special.items()}
        self.fixed = {s: _packed([n]) for s, n in self.special.items()} | (table or {})
        self.own = {} if memory is None else memory
        self.own.update(self.fixed)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.mark = next(iter(self.special.items()), None)

    def words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words and special tokens of all texts in one row, and where each text's begin; one more at the end."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        _, places, buffer = texts.buffers()
        offsets = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
        low, high = int(offsets[0]), int(offsets[-1])
        buffer = buffer.slice(low, high - low) if high > low else pa.py_buffer(b"")
        offsets = offsets - low
        data = buffer.to_pybytes()
        if self.units is not spaced_units or any(s.encode() in data for s in self.special):
            found = [[w for special, words in self.parts(t) for w in ([self.names[special]] if special is not None else words)] for t in texts.to_pylist()]
            return pa.array([w for words in found for w in words], pa.string()), np.cumsum([0, *map(len, found)])
        starts = spaced_spans(data, offsets)
        places = np.append(starts, len(data)).astype(np.int32)
        return pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), buffer), np.searchsorted(starts, offsets)

    def parts(self, text: str) -> list[tuple[int | None, list[str]]]:
        """Special tokens and, between them, the words."""
        if not any(s in text for s in self.special):
            return [(None, self.units(text))]
        return [(self.special[p], []) if p in self.special else (None, self.units(p)) for p in self.cut(text) if p]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The library's ids of each word, for many words in one call.

        Words are joined where the ids show the joint again: letters alone by a space,
        if the vocabulary marks the ends of words; words without inner white space by a
        line break, which has an id of its own; others by a special token. Letters that
        are spelled by bytes go to the model itself.
        """
        ends = word_ends(self.path)
        if ends is not None:
            kinds = {True: [], False: [], None: []}
            for word in words:
                kinds[word.isascii() and (word.islower() or not self.fold) if word.isalpha() else None].append(word)
            found = self._by_ends(kinds[True], letters_tokenizer(self.path), ends) | self._by_ends(kinds[False], tokenizer(self.path), ends)
            rest = kinds[None]
        else:
            letters, plain, rest = [], [], []
            for word in words:
                bare = word.removeprefix(" ")
                (letters if _LETTERS(word) else rest if not bare or _ANY_WHITE.search(bare) else plain).append(word)
            found = self._by_model(letters) | self._by_break(plain)
        found |= self._by_special([w for w in rest if w not in found])
        left = [w for w in words if w not in found]
        if left:  # a joint did not show: one by one
            found |= {w: _packed(e.ids) for w, e in zip(left, tokenizer(self.path).encode_batch(left, add_special_tokens=False), strict=True)}
        return [found[w] for w in words]

    def _by_ends(self, words: list[str], library, ends: np.ndarray) -> dict[str, bytes]:
        if not words:
            return {}
        ids = _ids(library, " ".join(words))
        last = np.flatnonzero(ends[ids]) + 1
        return _cut(ids, np.append(0, last[:-1]), last, words)

    def _by_model(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters, which no pattern cuts, go to the model as a byte-level file spells them."""
        if not words:
            return {}
        model = tokenizer(self.path).model
        ids = [[t.id for t in model.tokenize(w)] for w in _spelled(words)]
        ends = np.cumsum([0, *map(len, ids)])
        return _cut(np.fromiter(chain.from_iterable(ids), "<u4"), ends[:-1], ends[1:], words)

    def _by_break(self, words: list[str]) -> dict[str, bytes]:
        mark = _ids(tokenizer(self.path), "\n")
        if not words or len(mark) != 1:
            return {}
        ids = _ids(tokenizer(self.path), "\n".join(words) + "\n")
        last = np.flatnonzero(ids == mark[0])
        return _cut(ids, np.append(0, last[:-1] + 1), last, words)

    def _by_special(self, words: list[str]) -> dict[str, bytes]:
        if not words or self.mark is None:
            return {}
        text, number = self.mark
        ids = _ids(tokenizer(self.path), text.join(words) + text)
        last = np.flatnonzero(ids == number)
        return _cut(ids, np.append(0, last[:-1] + 1), last, words)

    def _split(self, words: list[str]) -> list[tuple[str, str]]:
        """Each word as letters and the ASCII marks after them, which never merge, if it is that."""
        found = [(w, "") if w[-1:].isalnum() else m.groups() if (m := _LETTERS_AND_MARKS(w)) else (w, "") for w in words]
        return list(map(self._folded, found, words)) if self.fold else found

    @staticmethod
    def _folded(pair: tuple[str, str], word: str) -> tuple[str, str]:
        letters, marks = pair
        if letters.isascii():
            return (letters.lower(), marks) if letters.isalpha() else pair
        # A letter that normalises to a letter and a mark would join the marks after it.
        return (word, "") if "\u0130" in letters or not is_normalized("NFC", letters) else pair

    def learn(self, words: Iterable[str]) -> None:
        """Put distinct words, and the letters in them, into the task's own table."""
        if len(self.own) > len(self.fixed) + self.keep:
            older = list(islice(self.own.items(), self.keep // 2))
            self.own.clear()
            self.own.update(self.fixed)
            self.own.update(older)
        own = self.own
        new = [w for w in words if w not in own]
        split = self._split(new)
        unknown = list({c for pair in split for c in pair if c}.difference(own))
        for begin in range(0, len(unknown), 4096):
            part = unknown[begin : begin + 4096]
            own.update(zip(part, self.encode_words(part), strict=True))
        own.update((w, own[a] + own[b] if b else own[a]) for w, (a, b) in zip(new, split, strict=True) if b or w != a)

    def __call__(self, texts: Iterable[str | None]) -> list[bytes]:
        parted = [self.parts(t) if t else [] for t in texts]
        self.learn(set().union(*(words for parts in parted for _, words in parts)))
        get = self.own.__getitem__
        return [b"".join(_packed([special]) if special is not None else b"".join(map(get, words)) for special, words in parts) for parts in parted]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one row, and where each text's begin; one more at the end."""
        words, begins = self.words(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(distinct)
        ids = pa.array(list(map(self.own.__getitem__, distinct)), pa.large_binary()).take(coded.indices)
        if not len(ids):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        _, places, buffer = ids.buffers()
        ends = np.frombuffer(places, np.int64)[ids.offset : ids.offset + len(ids) + 1]
        return np.frombuffer(buffer, "<i4", int(ends[-1]) // 4), ends[begins] // 4


_ANY_WHITE = re.compile(f"[{WHITE}]")
#: Letters in every version of Unicode that a library may know.
_LETTERS = re.compile(
    " ?[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u021f\u0400-\u0481\u048a-\u04ce\u05d0-\u05ea\u0621-\u063a\u0641-\u064a"
    "\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]+"
).fullmatch


def _ids(library, text: str) -> np.ndarray:
    return np.array(library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")


def _cut(ids: np.ndarray, begins: np.ndarray, ends: np.ndarray, words: list[str]) -> dict[str, bytes]:
    """The ids between the joints, by word; nothing if there are not as many as words."""
    if len(ends) != len(words):
        return {}
    packed = ids.tobytes()
    return {w: packed[4 * a : 4 * b] for w, a, b in zip(words, begins.tolist(), ends.tolist(), strict=True)}


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def word_table(docs: DataFrame, path: str, units: Callable[[str], list[str]] = spaced_units, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every distinct word and its count over all documents."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path, units)
        special = pa.array(list(encoder.special), pa.string())
        held: list[pa.Table] = []

        def add_up() -> pa.Table:
            return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

        def flush() -> list[pa.RecordBatch]:
            found = add_up()
            held.clear()
            return found.filter(pc.invert(pc.is_in(found.column("word"), special))).combine_chunks().to_batches(max_chunksize=1 << 16)

        for batch in text_slices(batches):
            counts = encoder.words(batch.column("__text"))[0].value_counts()
            held.append(pa.table({"word": counts.field(0), "n": counts.field(1)}))
            if sum(t.nbytes for t in held) > COUNTED_BYTES:
                held[:] = [add_up()]
                if held[0].nbytes > COUNTED_BYTES // 2:
                    yield from flush()
        if held:
            yield from flush()
        pa.default_memory_pool().release_unused()  # a worker goes on with other tasks

    return id_and_text(docs, id_col, text_col).mapInArrow(words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def encoded(table: DataFrame, path: str, units: Callable[[str], list[str]] = spaced_units) -> DataFrame:
    """The words of a table with their ids, each encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path, units)
        for batch in batches:
            found = batch.column("word").to_pylist()
            ids = [i for begin in range(0, len(found), 4096) for i in encoder.encode_words(found[begin : begin + 4096])]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(ids, pa.binary())], names=["word", "ids"])

    return table.select("word").mapInArrow(encode, "word string, ids binary")


def frequent(table: DataFrame, path: str, table_bytes: int, units: Callable[[str], list[str]] = spaced_units) -> dict[str, bytes]:
    """The most frequent words and their ids, up to the bound.

    A least count is found from a histogram by powers of two; only words that occur that
    often are encoded and brought to the driver, and their bytes are known to fit. Words
    that occur once are never shared.
    """
    level = F.floor(F.log2("n")).cast("int")
    held = settle(table.where(F.col("n") > 1).withColumn("level", level))
    levels = held.groupBy("level").agg(F.sum(F.octet_length("word") + F.lit(160)).alias("b")).orderBy(F.desc("level")).collect()
    total, least = 0, None
    for row in levels:
        total += row["b"]
        if total > table_bytes:
            break
        least = row["level"]
    if least is None:
        return {}
    return {r["word"]: bytes(r["ids"]) for r in encoded(held.where(F.col("level") >= least), path, units).collect()}


def encode(docs: DataFrame, path: str, units: Callable[[str], list[str]] = spaced_units, table_bytes: int = 24 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``ids``, the whole text's token ids as an array."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent(word_table(docs, path, units, id_col, text_col), path, table_bytes, units))

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path, units, table=table.value, keep=KEEP_BESIDE, memory=remembered(path, units.__name__))
        for batch in text_slices(batches):
            values, begins = encoder.flat(batch.column("__text"))
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(values))], names=["__id", "ids"])
        pa.default_memory_pool().release_unused()

    rows = id_and_text(docs, id_col, text_col)
    out = rows.mapInArrow(ids, f"__id {rows.schema['__id'].dataType.simpleString()}, ids array<int>")
    return out.withColumnRenamed("__id", id_col)


def byte_pieces(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary; special tokens as their text."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    byte = {c: b for b, c in enumerate(_byte_letters())}
    pieces: dict[int, bytes] = {i: bytes(byte[c] for c in piece) for piece, i in content["model"]["vocab"].items()}
    pieces |= {t["id"]: t["content"].encode() for t in content["added_tokens"]}
    return [pieces.get(i, b"") for i in range(max(pieces) + 1)]


def _joined(pieces: pa.Array, begins: np.ndarray) -> pa.Array:
    """Texts of consecutive pieces, which lie one after another as it is."""
    if not len(pieces):
        return pa.array([""] * (len(begins) - 1), pa.string())
    _, places, buffer = pieces.buffers()
    places = np.frombuffer(places, np.int64)[pieces.offset : pieces.offset + len(pieces) + 1][begins]
    out = pa.LargeStringArray.from_buffers(len(begins) - 1, pa.py_buffer(places), buffer or pa.py_buffer(b""))
    try:
        out.validate(full=True)
    except pa.ArrowInvalid:  # ids that end within a character
        data = buffer.to_pybytes()
        return pa.array([data[a:b].decode("utf-8", "replace") for a, b in pairwise(places.tolist())], pa.string())
    return out.cast(pa.string())


def decode(coded: DataFrame, path: str, ids_col: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns and the text of the ids, by the table of pieces."""
    place = coded.columns.index(ids_col)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(byte_pieces(path), pa.large_binary())
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                batch = whole.slice(begin, 256)
                column = batch.column(place)
                begins = np.append(0, pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).cumsum())
                yield pa.RecordBatch.from_arrays([*batch.columns, _joined(pieces.take(column.flatten()), begins)], names=[*batch.schema.names, text])
        pa.default_memory_pool().release_unused()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema.fields)
    return coded.mapInArrow(texts, f"{fields}, `{text}` string")
