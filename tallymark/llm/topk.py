"""Exact top-k search by inner product with pivot-table elimination.

Pivots are the vectors of a bounded sample. Every vector has a table of its distances to
them, made where its block is read. For a query and a candidate each pivot gives a lower bound of
their distance, |d(q,p) - d(x,p)|, and the largest, with both lengths, bounds the inner product
from above. Candidates are evaluated in the order of that bound, and none whose bound is below the k-th best
score, so the result is exact. Of the pivots those next to the query and those next to
the candidate are looked at: they give the largest bounds, and any of them gives a valid one.

Neighbouring queries go through a block together, each with bounds and a limit of its own.
A candidate that the bounds leave to none of them is not evaluated. The others are scored in
one product of matrices for the whole group; where the bounds leave few pairs, pair by pair.

Candidates are dealt by their nearest pivot, in an order in which near pivots are
neighbours, into blocks of bounded size; a pivot with too many is split. A task takes a
block of queries through several blocks of candidates, the likeliest first, and the limit
that one block gives a query holds for the next. A candidate block is copied once for each
``QUERY_BLOCK`` queries.

Vectors with components beyond ``WIDE`` have blocks of their own and are scored with Python's
integers, every pair of them.

Defined cases: vectors that are null, or hold a null or non-finite component, and rows
without an id take no part; shorter vectors count as filled up with zeros; rows that
repeat an id count once, with the smallest vector; ties go to the smaller id; with fewer
candidates than k all are returned; a score beyond the range of a long is ranked by its
value and shown as the nearest long; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.store import pieces_of, settle

PIVOTS = 2048
#: Pivots looked at for a pair: the nearest of the query, and of the candidate.
NEAR_QUERY, NEAR_CANDIDATE = 16, 4
QUERY_BLOCK = 4096
BLOCK = 4096
WIDE_BLOCK = 256
#: Blocks of candidates that a task takes a block of queries through.
BLOCKS_A_TASK = 8
#: Queries that go through a block together.
GROUP = 32
#: Candidates evaluated before the first look at the bound; doubled after each look.
STEP = 256
#: Pairs of a product of matrices that take the time of a pair alone.
ALONE = 16
#: Share of squared lengths added to bounds, so that no rounding, to 32 bits too, lowers one.
ROUNDING = 2e-6
#: Scaled components from here on are no numbers for numpy's products.
WIDE = float(1 << 26)
LONGEST, LEAST = (1 << 63) - 1, -(1 << 63)
#: Limits are no larger, so that they are finite doubles; scores of other vectors than wide ones are far smaller.
MOST = 10**300


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``__id`` and ``__x``, the components as doubles, of the vectors that take part."""
    finite = F.forall("__x", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), F.lit(False)))
    return (
        vectors.select(F.col(f"`{id_col}`").cast("long").alias("__id"), F.col(f"`{vector_col}`").cast("array<double>").alias("__x"))
        .where(F.col("__id").isNotNull() & F.col("__x").isNotNull() & finite)
        .groupBy("__id")
        .agg(F.min("__x").alias("__x"))
    )


def _matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Lists as rows, filled up with zeros."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), max([1, width, *sizes])))
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _scaled(points: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component: exact doubles, or Python integers where they must be."""
    with np.errstate(over="ignore"):
        out = points * scale
    if np.abs(out).max(initial=0) < WIDE:
        return np.floor(out)
    return np.array([[math.floor(x * scale) if math.isfinite(x * scale) else int(x) * scale for x in row] for row in points.tolist()], dtype=object)


def choose_pivots(table: DataFrame, scale: int, count: int = PIVOTS) -> np.ndarray:
    """Distinct vectors of a bounded sample by the hash of the id, near ones next to each other."""
    small = table.where(F.forall("__x", lambda x: F.abs(x) * F.lit(float(scale)) < F.lit(WIDE)))
    rows = [r["__x"] for r in small.orderBy(F.xxhash64("__id"), "__id").limit(count).collect()]
    if not rows:
        return np.zeros((1, 1))
    points = np.unique(_scaled(_matrix(pa.array(rows, pa.list_(pa.float64()))), scale), axis=0)
    centred = points - points.mean(0)
    axis = np.linalg.svd(centred, full_matrices=False)[2][0]
    return points[np.argsort(centred @ axis, kind="stable")]


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Of points with whole components, in 32 bits if these hold every step before the root exactly."""
    width = max(points.shape[1], pivots.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (points, pivots))
    of_a, of_b = (a**2).sum(1), (b**2).sum(1)
    if of_a.max(initial=0) + of_b.max(initial=0) < 2**23:
        a, b, of_a, of_b = (m.astype(np.float32) for m in (a, b, of_a, of_b))
    out = a @ b.T
    out *= -2
    out += of_a[:, None]
    out += of_b
    return np.sqrt(np.maximum(out, 0, out=out), out=out)


def with_home(table: DataFrame, pivots: np.ndarray, scale: int) -> DataFrame:
    """The vectors with ``__home``, the number of the nearest pivot; -1 for wide ones."""

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1024):
                batch = whole.slice(begin, 1024)
                points = _matrix(batch.column("__x"))
                with np.errstate(over="ignore"):
                    wide = (np.abs(points) * scale >= WIDE).any(1)
                nearest = _distances(np.floor(np.where(wide[:, None], 0, points) * scale), pivots).argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.where(wide, -1, nearest), pa.int32())], names=["__id", "__x", "__home"])

    return table.mapInArrow(home, "__id bigint, __x array<double>, __home int")


def in_blocks(rows: DataFrame, block: int) -> tuple[DataFrame, int]:
    """One row per block (``block``, ``width``, ``ids``, ``points``), and how many blocks there are.

    Neighbouring homes share a block; the counts of the homes, no more than pivots, decide.
    """
    counts = {r["__home"]: r["count"] for r in rows.groupBy("__home").count().collect()}
    plan, passed = [], 0
    for home in sorted(h for h in counts if h >= 0):
        plan.append((home, passed // block, pieces_of(counts[home], block)))
        passed += counts[home]
    blocks = max((first + splits for _, first, splits in plan), default=0)
    if -1 in counts:
        plan.append((-1, blocks, pieces_of(counts[-1], WIDE_BLOCK)))
        blocks += plan[-1][2]
    known = rows.sparkSession.createDataFrame(plan, "__home int, first int, splits int")
    dealt = rows.join(known, "__home").withColumn("__block", (F.col("first") + F.pmod(F.xxhash64("__id"), F.col("splits"))).cast("int"))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["__home", "__id"])  # so that neighbours make up a group
        points = _matrix(pa.array(frame["__x"].tolist(), pa.list_(pa.float64())))
        return pd.DataFrame({"block": [int(frame["__block"].iloc[0])], "width": [points.shape[1]], "ids": [frame["__id"].to_numpy(np.int64).tobytes()], "points": [points.tobytes()]})

    packed = dealt.select("__block", "__home", "__id", "__x").groupBy("__block").applyInPandas(pack, "block int, width int, ids binary, points binary")
    return packed, max(blocks, 1)


@dataclass
class Block:
    """Ids, scaled vectors, the table of distances to the pivots, pivot by pivot, the nearest pivots with their distances, and half the squared lengths."""

    ids: np.ndarray
    points: np.ndarray
    table: np.ndarray
    near: np.ndarray
    away: np.ndarray
    half: np.ndarray

    @classmethod
    def read(cls, ids: bytes, points: bytes, width: int, pivots: np.ndarray, scale: int, near: int) -> Block:
        names = np.frombuffer(ids, np.int64)
        scaled = _scaled(np.frombuffer(points, np.float64).reshape(len(names), width), scale)
        table = np.zeros((len(pivots), len(names)), np.float32)
        if scaled.dtype == object:
            return cls(names, scaled, table, table[:0].astype(np.int64), table[:0], np.zeros(len(names), np.float32))
        count = min(near, len(pivots))
        nearest = np.empty((count, len(names)), np.int64)
        for begin in range(0, len(names), 256):
            far = _distances(scaled[begin : begin + 256], pivots)
            nearest[:, begin : begin + 256] = np.argpartition(far, count - 1, axis=1)[:, :count].T
            table[:, begin : begin + 256] = far.T
        return cls(names, scaled, table, nearest, table[nearest, np.arange(len(names))], ((0.5 + ROUNDING) * (scaled**2).sum(1)).astype(np.float32))


class Best:
    """The k best so far of each query of a block; ``evaluated`` counts the pairs scored."""

    def __init__(self, queries: Block, k: int, longest_pivot: float):
        self.queries, self.k, self.evaluated = queries, k, 0
        self.far, self.half = np.ascontiguousarray(queries.table.T), queries.half + np.float32(ROUNDING * (longest_pivot + 1))
        #: By group: places of the queries in it, ids and scores, best first.
        self.found: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        #: Of each query the k-th best score so far, and its id.
        self.limit, self.last = np.full(len(queries.ids), -math.inf), np.zeros(len(queries.ids), np.int64)

    def take(self, block: Block) -> None:
        """Every query through one block of candidates."""
        width = max(self.queries.points.shape[1], block.points.shape[1])
        q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (self.queries.points, block.points))
        exact: type = object
        if q.dtype != object and x.dtype != object:
            # The narrowest numbers that hold every partial sum of a product exactly.
            largest = max(np.abs(q).sum(1).max(), 1) * max(np.abs(x).max(), 1)
            exact = np.float32 if largest < 2**23 else np.float64 if largest < 2**52 else np.int64 if largest < 2**62 else object
        wide = exact is object
        q, x = ((m.astype(np.int64) if wide and m.dtype != object else m).astype(exact) for m in (q, x))
        bounded = self.queries.points.dtype != object and block.points.dtype != object
        for begin in range(0, len(q), GROUP):
            self._take(begin, block, q[begin : begin + GROUP], x, bounded)

    def _bounds(self, row: int, block: Block, own: np.ndarray | slice) -> np.ndarray:
        """The most that each candidate's score can be."""
        far, near = self.far[row], self.queries.near[:, row]
        by_query = block.table[near][:, own]
        by_query -= far[near][:, None]
        by_candidate = far[block.near[:, own]]
        by_candidate -= block.away[:, own]
        gap = np.maximum(np.abs(by_query, out=by_query).max(0), np.abs(by_candidate, out=by_candidate).max(0))
        return block.half[own] + self.half[row] - gap * gap * np.float32(0.5)

    def _take(self, begin: int, block: Block, q: np.ndarray, x: np.ndarray, bounded: bool) -> None:
        """A group of queries, from ``begin`` on."""
        limit = self.limit[begin : begin + len(q)]
        bound, order = None, np.arange(len(block.ids))
        if bounded:
            bound = np.stack([self._bounds(row, block, slice(None)) for row in range(begin, begin + len(q))])
            order = np.argsort(-bound.max(0))
        at, step = 0, STEP
        while at < len(order):
            part, at, step = order[at : at + step], at + step, 2 * step
            wanted = np.ones((len(q), len(part)), bool)
            if bound is not None:
                wanted = bound[:, part] >= _rounded(limit, bound)[:, None]
                left = wanted.any(0)
                part, wanted = part[left], wanted[:, left]
            if not len(part):
                continue
            if wanted.sum() * ALONE < wanted.size:
                rows, places = np.nonzero(wanted)
                scores = np.einsum("ij,ij->i", q[rows], x[part[places]])
                self.evaluated += len(rows)
            else:
                scored = q @ x[part].T
                self.evaluated += scored.size
                rows, places = np.nonzero(self._good(scored, limit))
                scores = scored[rows, places]
            self._merge(begin, rows, block.ids[part[places]], scores)

    def _good(self, scored: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Which scores may be among the k best of their row."""
        if scored.dtype == object:
            return np.ones(scored.shape, bool)
        least = _rounded(limit, scored)
        if np.isinf(limit).any() and scored.shape[1] > self.k + 1:  # one may be the query itself
            least = np.maximum(least, np.partition(scored, -self.k - 1, axis=1)[:, -self.k - 1].astype(least.dtype))
        return scored >= least[:, None]

    def _merge(self, begin: int, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Candidates of a group among its best ones."""
        keep = ids != self.queries.ids[begin + rows]
        if scores.dtype != object:
            scores, limit = scores.astype(np.int64), self.limit[begin + rows]
            keep &= ~((scores == limit) & (np.abs(limit) < 2**53) & (ids > self.last[begin + rows]))
        if not keep.any():
            return
        new = rows[keep], ids[keep], scores[keep]
        rows, ids, scores = (np.concatenate(x) for x in zip(self.found[begin], new, strict=True)) if begin in self.found else new
        if scores.dtype == object:
            best = np.array(sorted(range(len(rows)), key=lambda i: (rows[i], -scores[i], ids[i])), dtype=np.int64)
        else:
            best = np.lexsort((ids, -scores, rows))
        place = np.arange(len(rows)) - np.searchsorted(rows[best], rows[best])
        best, place = best[place < self.k], place[place < self.k]
        rows, ids, scores = rows[best], ids[best], scores[best]
        if scores.dtype == object and all(abs(s) < 2**62 for s in scores):
            scores = scores.astype(np.int64)
        self.found[begin] = rows, ids, scores
        full = place == self.k - 1
        self.limit[begin + rows[full]] = [float(min(max(s, -MOST), MOST)) for s in scores[full].tolist()]
        self.last[begin + rows[full]] = ids[full]

    def rows(self) -> Iterator[tuple[int, int, int, str]]:
        for begin, (rows, ids, scores) in self.found.items():
            for query, i, s in zip(self.queries.ids[begin + rows].tolist(), ids.tolist(), scores.tolist(), strict=True):
                yield query, i, min(max(s, LEAST), LONGEST), in_order(s)


def _rounded(limit: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Limits as numbers of that kind, of 64 bits for integers: a number of the kind that reaches the limit reaches the rounded one."""
    with np.errstate(over="ignore"):
        return limit.astype(like.dtype if like.dtype == np.float32 else np.float64)


def in_order(number: int) -> str:
    """A text for an integer of any size, so that texts are in the order of the integers."""
    digits = str(abs(number))
    if number >= 0:
        return f"1{len(digits):05d}{digits}"
    return f"0{99999 - len(digits):05d}" + "".join(str(9 - int(d)) for d in digits)


def top_k(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` from 1, the candidate's id, ``score``.

    ``is_query`` tells query rows by their id; the candidates are all rows. The score is the inner
    product of the vectors, each component scaled and rounded down to an integer.
    """
    table = settle(usable(vectors, id_col, vector_col))
    pivots = choose_pivots(table, scale)
    longest_pivot = float((pivots**2).sum(1).max())
    table = settle(with_home(table, pivots, scale))
    left, query_blocks = in_blocks(table.where(is_query(F.col("__id"))), QUERY_BLOCK)
    right, blocks = in_blocks(table, BLOCK)
    left = left.select(*(F.col(c).alias(f"q_{c}") for c in ("block", "width", "ids", "points")))
    slices = pieces_of(blocks, BLOCKS_A_TASK)
    right = right.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = right.withColumn("slice", F.pmod(F.col("block"), F.lit(slices)))
    # Blocks lie in the order of the pivots: those next to the queries' place come first.
    apart = F.abs(F.col("block") / F.lit(blocks) - F.col("q_block") / F.lit(query_blocks))
    # A hot key cannot arise: each pair of blocks is one row, and blocks are bounded.
    pairs = (
        right.join(left, F.col("with") == F.col("q_block"))
        .withColumn("apart", apart)
        .repartition(query_blocks * slices, "q_block", "slice")
        .sortWithinPartitions("q_block", "slice", "apart", "block")
    )

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, best = None, None

        def done() -> pd.DataFrame:
            return pd.DataFrame(list(best.rows()), columns=["query_id", "id", "score", "place"]).astype({c: "int64" for c in ("query_id", "id", "score")})

        for frame in frames:
            for row in frame.itertuples(index=False):
                if at != (row.q_block, row.slice):
                    if best is not None:
                        yield done()
                    at = row.q_block, row.slice
                    best = Best(Block.read(row.q_ids, row.q_points, row.q_width, pivots, scale, NEAR_QUERY), k, longest_pivot)
                best.take(Block.read(row.ids, row.points, row.width, pivots, scale, NEAR_CANDIDATE))
        if best is not None:
            yield done()

    found = pairs.mapInPandas(search, "query_id bigint, id bigint, score bigint, place string")
    order = Window.partitionBy("query_id").orderBy(F.desc("place"), F.asc("id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
