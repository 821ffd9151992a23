"""Quality classifier: learned hashed word and character n-gram vectors, softmax output.

A word's vector is the mean of the vectors of its own bucket and of the buckets of its
character n-grams (bytes, with marks for a word's start and end); a document's vector is
the mean over its words, and a pseudo-word stands for each word that repeats the one
before it. Vectors and output weights are trained together by stochastic gradient
descent in numpy, on a bounded sample of labelled documents: at most ``sample`` rows,
those with the smallest hash of the id. The model has a fixed size, and as the output is
linear in the vectors, scoring needs one number per bucket.

Defined cases: a null text is an empty one; a text without words scores what the bias
alone gives; labels that are null or disagree for an id are not learned from; with no
usable label every score is 0.5; repeated ids and rows each get their own score; an
empty table gives an empty result; other columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.store import id_and_text
from tallymark.llm.words import mix, text_slices, word_spans

BUCKETS = 1 << 17
GRAMS = (1, 2, 3, 4)
DIMENSIONS = 16
SAMPLE = 4000
EPOCHS = 4
RATE = 1.0

_AGAIN = np.uint64(0x5A17)


def word_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of the distinct words of some texts, and the words of each text.

    Returns the buckets of all distinct words one after another, where each word's begin,
    the number of buckets per word, the distinct word at each place, and the places where
    texts begin (one more at the end).
    """
    spans = word_spans(texts)
    hashes = spans.hashes.copy()
    if len(hashes) > 1:  # a repeated word becomes the pseudo-word
        again = np.zeros(len(hashes), dtype=bool)
        again[1:] = spans.hashes[1:] == spans.hashes[:-1]
        again[spans.begins[:-1][spans.begins[:-1] < len(hashes)]] = False
        hashes[again] = _AGAIN
    distinct, first, places = np.unique(hashes, return_index=True, return_inverse=True)
    starts, ends = spans.starts[first], spans.ends[first]
    word, bucket = [np.arange(len(distinct))], [mix(distinct) % np.uint64(BUCKETS)]
    real = distinct != _AGAIN
    for size in GRAMS:
        counts = np.where(real, np.maximum(ends - starts - size + 1, 0), 0)
        owner = np.repeat(np.arange(len(distinct)), counts)
        at = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        edge = (at == starts[owner]).astype(np.uint64) + np.uint64(2) * (at + size == ends[owner]).astype(np.uint64)
        word.append(owner)
        bucket.append(mix(spans.gram(at, size) ^ (edge << np.uint64(60)) ^ np.uint64(size)) % np.uint64(BUCKETS))
    owner, bucket = np.concatenate(word), np.concatenate(bucket).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(distinct))
    return bucket[order], np.cumsum(counts) - counts, counts, places, spans.begins


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A document's buckets and their weights, which sum to one unless it has no word."""
    bucket, _, counts, places, _ = word_features([text])
    if not len(places):
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    uses = np.bincount(places, minlength=len(counts)) / (len(places) * counts)
    weights = np.bincount(bucket, weights=np.repeat(uses, counts), minlength=BUCKETS)
    held = np.flatnonzero(weights)
    return held.astype(np.int32), weights[held].astype(np.float32)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> np.ndarray:
    """One number per bucket and the bias last: the difference of the two outputs.

    ``rows`` holds the features of each document, as ``document_features`` gives them.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    total, done = epochs * len(rows), 0
    for _ in range(epochs):
        for at in rng.permutation(len(rows)):
            bucket, weight = rows[at]
            step = rate * (1 - done / total)
            done += 1
            hidden = weight @ vectors[bucket] if len(bucket) else np.zeros(DIMENSIONS, np.float32)
            scores = output @ hidden + bias
            chance = np.exp(scores - scores.max())
            error = chance / chance.sum()
            error[labels[at]] -= 1
            back = error @ output
            output -= step * np.outer(error, hidden)
            bias -= 0.1 * step * error
            if len(bucket):
                # Weights of a text are tiny for a long one; their largest sets the pace.
                vectors[bucket] -= step * np.outer(weight / weight.max(), back)
    numbers = vectors @ (output[1] - output[0])
    return np.append(numbers, bias[1] - bias[0]).astype(np.float32)


def scores(model: np.ndarray, texts: list[str | None]) -> np.ndarray:
    """The chance of label 1 for each text."""
    bucket, begins, counts, places, texts_at = word_features(texts)
    logit = np.full(len(texts), float(model[-1]))
    if len(places):
        word = np.add.reduceat(model[bucket].astype(np.float64), begins) / counts
        sums = np.concatenate(([0.0], np.cumsum(word[places])))
        number = np.diff(texts_at)
        logit += np.where(number > 0, (sums[texts_at[1:]] - sums[texts_at[:-1]]) / np.maximum(number, 1), 0.0)
    return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def held_out(key: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 1 by three."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> np.ndarray:
    """Train on at most ``sample`` labelled documents that are not held out.

    The labels are cut to the sample before the texts are read for it, and texts become
    features (at most a bucket and a weight for each of ``BUCKETS``, however long the text) in the tasks that
    read them; so the broadcast and the one training task are bounded at any corpus size. Of texts that
    share an id the one with the least hash is learned from.
    """
    marked = labels.select(F.col(f"`{id_col}`").alias("__key"), F.col(f"`{label_col}`").cast("int").alias("__label"))
    chosen = (
        marked.where(F.col("__label").isin(0, 1) & F.col("__key").isNotNull() & ~held_out(F.col("__key")))
        .groupBy("__key")
        .agg(F.min("__label").alias("__label"), F.max("__label").alias("__most"))
        .where(F.col("__label") == F.col("__most"))
        .orderBy(F.xxhash64("__key"), "__key")
        .limit(sample)
    )
    rows = id_and_text(docs, id_col, text_col)
    chosen_texts = rows.join(F.broadcast(chosen), F.col("__id") == F.col("__key")).select("__id", "__text", "__label")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            made = [document_features(t) for t in batch.column("__text").to_pylist()]
            columns = [pa.array([x[i].tobytes() for x in made], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__label"), batch.column("__h"), *columns], names=["__id", "__label", "__h", "bucket", "weight"])

    kind = rows.schema["__id"].dataType.simpleString()
    hashed = chosen_texts.withColumn("__h", F.xxhash64(F.coalesce("__text", F.lit(""))))
    made = hashed.mapInArrow(features, f"__id {kind}, __label int, __h bigint, bucket binary, weight binary")
    one = made.groupBy("__id", "__label").agg(F.min(F.struct("__h", "bucket", "weight")).alias("f")).select("__id", "__label", "f.bucket", "f.weight")

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [f for f in frames if len(f)]
        if held:
            frame = pd.concat(held).sort_values("__id", kind="stable")
            read = [(np.frombuffer(b, np.int32), np.frombuffer(w, np.float32)) for b, w in zip(frame["bucket"], frame["weight"], strict=True)]
            yield pd.DataFrame({"model": [train(read, frame["__label"].tolist()).tobytes()]})

    found = one.repartition(1).mapInPandas(learn, "model binary").first()
    return np.zeros(BUCKETS + 1, np.float32) if found is None else np.frombuffer(bytes(found["model"]), np.float32)


def score(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``score`` of every document, one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = scores(shared.value, batch.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(found, pa.float64())], names=["__id", "score"])

    rows = id_and_text(docs, id_col, text_col)
    out = rows.mapInArrow(rate, f"__id {rows.schema['__id'].dataType.simpleString()}, score double")
    return out.withColumnRenamed("__id", id_col)


def keep_good(docs: DataFrame, model: np.ndarray, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents that score ``least`` or more, with all their columns, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [f"c{i}" for i in range(batch.num_columns)]
            plain = pa.RecordBatch.from_arrays(batch.columns, names=names)
            for part in text_slices(iter([plain]), names[place]):
                good = scores(shared.value, part.column(place).to_pylist()) >= least
                kept = part.filter(pa.array(good))
                yield pa.RecordBatch.from_arrays(kept.columns, names=batch.schema.names)

    return docs.mapInArrow(keep, docs.schema)
