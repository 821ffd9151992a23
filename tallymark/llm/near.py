"""N-gram Jaccard join: a MinHash LSH forest with exact verification.

A document is its set of word shingles (``SHINGLE`` consecutive words; a shorter text is
one shingle). Equal sets are joined first and travel as one representative with a count
and a number of its own; ids play no part until the classes are named.
A signature has ``TREES`` trees of ``DEPTH`` min-hashes. Representatives that agree on a
prefix of a tree are neighbours in its sorted order and form a bucket, and every pair of
a bucket is verified on the shingle sets. The join starts with the longest prefix; the
similarities found, each weighted by one over its chance of being found, estimate the
recall, and prefixes are shortened by one until the estimate reaches the target or the
shortest prefix is used.

Size: a bucket of any size is dealt into blocks that meet pairwise in separate tasks, and
a task returns one row per document (its links and one edge), never its pairs. A pair is
counted in the first tree where it agrees, so the counts are exact without listing it.

Defined cases: a null or wordless text is in a class of its own without links; rows that
repeat a text count as copies of each other, rows that only repeat an id (or have none)
do not; a null id counts as the smallest;
a similarity equal to the threshold is a link; an empty table gives an empty result; only
id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.components import components
from tallymark.llm.store import numbered, settle
from tallymark.llm.words import gram_hashes, mix, signed, text_slices, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
TREES = 20
DEPTH = 5
SHORTEST = 4
#: A pair at the threshold is found with a chance of 0.99964 by prefixes of 5 and 0.99997 by 4: a
#: corpus with many links near the threshold needs the shorter ones, one with close copies does not.
TARGET = 0.9999
BLOCK = 512
NO_ID = -(1 << 63)

_SEEDS = mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    hashes, begins = word_hashes(texts)
    grams = gram_hashes(hashes, size)
    out = []
    for a, b in zip(begins[:-1], begins[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            out.append(gram_hashes(hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the least hash under each function, tree after tree."""
    least = np.full(len(_SEEDS), np.uint64(0xFFFFFFFFFFFFFFFF))
    for begin in range(0, len(shingles), 2048):
        part = shingles[begin : begin + 2048, None] ^ (_SEEDS >> np.uint64(7))
        least = np.minimum(least, (part * _SEEDS).min(axis=0))
    return (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)


def prefix_keys(signatures: np.ndarray, length: int) -> np.ndarray:
    """A hash of each tree's first ``length`` values; one column per tree."""
    trees = signatures.reshape(len(signatures), TREES, DEPTH)[:, :, :length].astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64) * np.uint64(64) + np.uint64(length), trees.shape[:2]).copy()
    for level in range(length):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) ^ trees[:, :, level])
    return keys


def chance(similarity: np.ndarray, length: int) -> np.ndarray:
    """The chance that a pair agrees on a prefix of some tree."""
    return 1 - (1 - similarity**length) ** TREES


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of some sets, as a matrix."""
    count = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(count), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    begins = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    holders = np.diff(np.append(begins, len(values)))
    shared = np.zeros((count, count), dtype=np.int64)
    flat = shared.reshape(-1)
    for number in np.unique(holders[holders > 1]):
        columns = begins[holders == number]
        if number <= 32:  # few holders: count the pairs of each shingle
            step = max(1, (1 << 20) // int(number) ** 2)
            for at in range(0, len(columns), step):
                held = owner[columns[at : at + step, None] + np.arange(number)]
                pairs = held[:, :, None] * count + held[:, None, :]
                flat += np.bincount(pairs.reshape(-1), minlength=count * count)
        else:
            for at in range(0, len(columns), 1024):
                part = columns[at : at + 1024]
                held = owner[part[:, None] + np.arange(number)]
                table = np.zeros((count, len(part)), dtype=np.float32)
                table[held, np.arange(len(part))[:, None]] = 1
                shared += (table @ table.T).astype(np.int64)
    return shared


def links_of_block(ids: np.ndarray, weights: np.ndarray, signatures: np.ndarray, sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, tree: int, length: int, longer: int, threshold: float) -> list[tuple]:
    """Verified links between the first and second side of a block, one row per document.

    A pair counts when ``tree`` is the first where it agrees on ``length`` values and it
    agrees on ``longer`` values (an earlier round) in none. Rows: id, least id it is
    linked to in this block, documents linked, pairs found, and the pairs' weights.
    """
    sizes = np.array([len(s) for s in sets])
    both = shared_counts(sets)
    total = sizes[:, None] + sizes[None, :] - both
    similar = both >= threshold * total - 1e-9
    upper = np.triu(np.ones_like(similar), 1) & similar
    upper &= (first[:, None] & second[None, :]) | (second[:, None] & first[None, :])
    left, right = np.nonzero(upper)
    if not len(left):
        return []
    now = prefix_keys(signatures, length)
    equal = now[left] == now[right]
    new = equal[:, tree] & ~equal[:, :tree].any(axis=1)
    if longer:
        before = prefix_keys(signatures, longer)
        new &= ~(before[left] == before[right]).any(axis=1)
    left, right = left[new], right[new]
    if not len(left):
        return []
    similarity = both[left, right] / total[left, right]
    root = np.arange(len(ids))
    changed = True
    while changed:  # least id reachable within the block
        least = root.copy()
        np.minimum.at(least, left, root[right])
        np.minimum.at(least, right, root[left])
        least = least[least]
        changed = bool((least != root).any())
        root = least
    count = len(ids)
    links = np.bincount(left, weights=weights[right], minlength=count) + np.bincount(right, weights=weights[left], minlength=count)
    found = np.bincount(left, minlength=count)
    expected = [np.bincount(left, weights=1 / chance(similarity, k), minlength=count) for k in range(SHORTEST, DEPTH + 1)]
    hit = np.flatnonzero((links > 0) | (found > 0))
    return [(int(ids[i]), int(ids[root[i]]), int(links[i]), int(found[i]), *(float(e[i]) for e in expected)) for i in hit]


_WEIGHTS = [f"e{k}" for k in range(SHORTEST, DEPTH + 1)]
_LINK_ROWS = "id bigint, root bigint, links bigint, found bigint, " + ", ".join(f"{e} double" for e in _WEIGHTS)


def _verify(length: int, longer: int, threshold: float) -> Callable:
    """Rows come sorted by bucket and block; each block is verified once it is complete."""

    def finish(rows: list[dict]) -> list[tuple]:
        rows.sort(key=lambda r: r["rep"])
        block = rows[0]["i"], rows[0]["j"]
        side = np.array([r["blk"] for r in rows])
        signatures = np.frombuffer(b"".join(r["sig"] for r in rows), np.uint16).reshape(len(rows), -1)
        return links_of_block(
            np.array([r["rep"] for r in rows]), np.array([r["weight"] for r in rows], dtype=np.float64), signatures,
            [np.frombuffer(r["shingles"], np.uint64) for r in rows], side == block[0], side == block[1], rows[0]["tree"], length, longer, threshold,
        )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        key, out = None, []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * (4 + len(_WEIGHTS))
            out.clear()
            kinds = [pa.int64()] * 4 + [pa.float64()] * len(_WEIGHTS)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "root", "links", "found", *_WEIGHTS])

        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                for row in batch.slice(begin, 256).to_pylist():
                    at = (row["key"], row["i"], row["j"])
                    if at != key:
                        if len(held) > 1:
                            out += finish(held)
                        held, key = [], at
                    held.append(row)
            if len(out) > 4096:
                yield flush()
        if len(held) > 1:
            out += finish(held)
        yield flush()

    return verify


def _set_key(shingles: np.ndarray) -> tuple[int | None, int | None]:
    if not len(shingles):
        return None, None
    return tuple(int(signed(mix(s).sum(keepdims=True))[0]) for s in (shingles, shingles ^ np.uint64(0x5BD1E995)))


def _sets(rows: DataFrame) -> DataFrame:
    """Per row: id, two hashes of the row, 128 bits of its shingle set (null without words), signature."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column("__text").to_pylist())
            a, b = zip(*map(_set_key, sets), strict=True)
            sigs = [signature(s).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), batch.column("__r1"), batch.column("__r2"), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sigs, pa.binary())],
                names=["id", "r1", "r2", "a", "b", "sig"],
            )

    return rows.mapInArrow(read, "id bigint, r1 bigint, r2 bigint, a bigint, b bigint, sig binary")


def _tree_keys(reps: DataFrame, length: int) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            found = signed(prefix_keys(sigs, length))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("rep").to_numpy(), TREES)), pa.array(np.tile(np.arange(TREES, dtype=np.int32), batch.num_rows)), pa.array(found.reshape(-1))],
                names=["rep", "tree", "key"],
            )

    return reps.select("rep", "sig").mapInArrow(keys, "rep bigint, tree int, key bigint")


def _shingles(rows: DataFrame) -> DataFrame:
    """Per row with words: id, key of its shingle set, shingles; repeats within a task once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in text_slices(batches):
            out = []
            for i, shingles in zip(batch.column("__id").to_pylist(), shingle_sets(batch.column("__text").to_pylist()), strict=True):
                row = (i, *_set_key(shingles))
                if len(shingles) and row not in seen:
                    seen.add(row)
                    out.append((*row, shingles.tobytes()))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.binary()], strict=True)], names=["id", "a", "b", "shingles"])

    return rows.mapInArrow(read, "id bigint, a bigint, b bigint, shingles binary")


def _row_hashes(docs: DataFrame) -> list:
    """Two hashes over all columns, without maps, which have no hash."""
    columns = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    nulls = [c.isNull() for c in columns]
    return [F.xxhash64(*columns, *nulls).alias("__r1"), F.xxhash64(F.lit(1), *columns, *nulls).alias("__r2")]


def _classes(rows: DataFrame, threshold: float, target: float) -> tuple[DataFrame, DataFrame]:
    """Per row: id, row hashes, set key. Per set: key, weight, class, links, and its first row.

    ``rows`` has ``__id``, ``__text``, ``__r1`` and ``__r2``. ``own`` is the first row of a
    set by id and row hashes, ``class`` the number of one set of the class.
    """
    sets = settle(_sets(rows))
    reps = settle(sets.where(F.col("a").isNotNull()).groupBy("a", "b").agg(F.min(F.struct("id", "r1", "r2")).alias("own"), F.count("*").alias("weight"), F.first("sig").alias("sig")).withColumn("rep", F.monotonically_increasing_id()))
    rounds, seen, longer, before = [], None, 0, None
    for length in range(DEPTH, SHORTEST - 1, -1):
        keyed = _tree_keys(reps, length)
        member = F.xxhash64("rep")
        sums = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("tree").alias("tree"), F.bit_xor(member).alias("x"), F.sum(member.bitwiseAND(F.lit((1 << 40) - 1))).alias("s"))
        buckets = sums.where(F.col("n") > 1)
        if seen is not None:  # the same members met in an earlier round
            buckets = buckets.join(seen, ["n", "x", "s"], "left_anti")
        # Trees with the same members: the first tree's bucket stands for all.
        buckets = settle(buckets.groupBy("n", "x", "s").agg(F.min(F.struct("tree", "key")).alias("b")).select("n", "x", "s", "b.tree", "b.key"))
        seen = buckets.select("n", "x", "s") if seen is None else seen.unionByName(buckets.select("n", "x", "s"))
        members = settle(keyed.drop("tree").join(buckets.select("key", "tree", "n"), "key"))
        asked = members.select("rep").distinct()
        if before is not None:  # sets of an earlier round are at hand
            asked = asked.join(before.select("rep"), "rep", "left_anti")
        wanted = asked.join(reps, "rep").select(F.col("own.id").alias("id"), "a", "b", "rep", "weight", "sig")
        # By id first, without multiplying rows that share one; then by the set itself.
        texts = rows.select("__id", "__text").join(wanted.select(F.col("id").alias("__id")).distinct(), "__id", "left_semi")
        held = _shingles(texts).join(wanted, ["id", "a", "b"]).dropDuplicates(["id", "a", "b"])
        held = settle(held.select("rep", "weight", "sig", "shingles"))
        if before is not None:
            held = held.unionByName(before)
        before = held
        # Blocks of a bucket: block i meets block j once, for i <= j.
        blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
        own = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks")).cast("int")
        placed = (
            members.withColumn("blocks", blocks)
            .withColumn("blk", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", "tree", "rep", "blk", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"))
        )
        sides = placed.join(held, "rep").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        rounds.append(settle(sides.mapInArrow(_verify(length, longer, threshold), _LINK_ROWS)))
        longer = length
        figures = [r.agg(F.sum("found").alias("f"), *(F.sum(e).alias(e) for e in _WEIGHTS)).first() for r in rounds]
        found, expected = sum(f["f"] or 0 for f in figures), sum(f[f"e{length}"] or 0.0 for f in figures)
        if found >= target * expected:
            break
    linked = rounds[0]
    for more in rounds[1:]:
        linked = linked.unionByName(more)
    edges = linked.where(F.col("id") != F.col("root")).select(F.col("id").alias("u"), F.col("root").alias("v")).distinct()
    classes = components(edges).select(F.col("node").alias("rep"), F.col("label").alias("class"))
    degrees = linked.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links"))
    named = reps.select("a", "b", "own", "rep", "weight").join(classes, "rep", "left").join(degrees, "rep", "left")
    return sets.select("id", "r1", "r2", "a", "b"), settle(named.select("a", "b", "own", "weight", F.coalesce("class", "rep").alias("class"), "links"))


def join(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``class_id`` (least id of its class) and ``n_links``.

    A class is what links connect; ``n_links`` counts the other rows at the threshold or
    above, copies included.
    """
    no_hash = F.lit(0).cast("long")
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("__id"), F.col(f"`{text_col}`").alias("__text"), no_hash.alias("__r1"), no_hash.alias("__r2"))
    sets, named = _classes(rows, threshold, target)
    least = named.groupBy("class").agg(F.min("own.id").alias("least"))
    named = settle(named.join(least, "class").select("a", "b", "weight", "links", "least"))
    out = sets.select("id", "a", "b").join(named, ["a", "b"], "left")
    back = lambda c: F.when(c != NO_ID, c)
    return out.select(
        back(F.col("id")).alias(id_col),
        back(F.coalesce("least", "id")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the least id of each class, with all its columns.

    Of rows of a class that share the least id, the first by a hash of the whole row.
    """
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    hashes = _row_hashes(docs)
    _, named = _classes(docs.select(key.alias("__id"), F.col(f"`{text_col}`").alias("__text"), *hashes), threshold, TARGET)
    first = named.groupBy("class").agg(F.min("own").alias("own"))
    first = settle(first.select(F.col("own.id").alias("__id"), F.col("own.r1").alias("__r1"), F.col("own.r2").alias("__r2")))
    text = F.col(f"c{docs.columns.index(text_col)}")
    own = numbered(docs.select("*", key.alias("__id"), *hashes)).withColumnsRenamed({f"c{len(docs.columns) + i}": n for i, n in enumerate(("__id", "__r1", "__r2"))})
    worded = F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = own.where(worded).join(first, ["__id", "__r1", "__r2"], "left_semi").dropDuplicates(["__id", "__r1", "__r2"])
    return kept.unionByName(own.where(~worded)).drop("__id", "__r1", "__r2").toDF(*docs.columns)
