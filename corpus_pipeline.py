"""Documents to packed sequences: the stages, each calling one operator.

A stage takes the session, the documents its predecessor kept, and the folder of the
sample tables; all but the last return the columns of ``documents``, with ``n_chars``
following the text. A document whose text is emptied by a stage stays as an empty one.

Defined cases: a null text stays null unless a stage would change it, counts as empty, and is packed
as its end id alone; rows that repeat an id are documents of their own, except that
only one of those with the same text and id stays (as of any near copies); a null id counts as the smallest;
further columns pass through all stages but the last, whatever their names; of an empty
table nothing is left. Each operator's own docstring says more.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import lines, near, packing, phrases, quality
from tallymark.llm.store import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more that three documents share stay in the last one."""
    return _counted(lines.dedup_lines(docs), docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a shingle similarity of 0.8 or more, the least id."""
    return near.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more stay in the document with the least id."""
    return _counted(phrases.drop_repeats(docs), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    packed = packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
    return packed.select(F.col("__id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_shared_lines),
    ("jaccard_join", keep_one_of_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("best_fit_packing", pack_sequences),
]

#: The classifier and the packing are not SQL; a brute-force version tests the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each settled before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if at == 0 else settle(docs), sf_dir)
    return docs
