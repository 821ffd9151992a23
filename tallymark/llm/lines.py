"""Drop lines that many documents share, keeping each in one document only.

Explode normalised lines, hash them, count distinct documents per hash, drop the lines
over the threshold, and reassemble by position. DataFrame functions throughout.

A line's key is the line without spaces and the controls 9 to 13 at both ends, A-Z in
lower case. A key of at least ``min_chars`` characters that at least ``min_docs``
documents hold is dropped everywhere but in the document with the largest id.

Defined cases: a null or empty text is one empty line; documents without lines to drop
come out as they are; rows that repeat an id count as one document, and each keeps
its own lines; null ids count as one document with the smallest id; an empty table gives
an empty table; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.store import id_and_text, numbered, settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _hashes(key: Column) -> Column:
    """128 bits of a key as two longs."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("second"), key).alias("b"))


def shared_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Positions to drop: ``__key`` (id), ``__text_key`` (hash of the text) and ``__drop``.

    The count is a grouped sum with a partial step, so a line that a third of the
    documents hold is one row per task before the shuffle. The shared hashes are settled,
    so that the join back has plain shuffles on both sides and adaptive execution can
    split its hot keys.
    """
    keyed = (
        id_and_text(docs, id_col, text_col)
        .select("__id", F.xxhash64("__text").alias("__row"), F.posexplode(F.transform(lines_of(F.col("__text")), line_key)).alias("__at", "__line"))
        .where(F.char_length("__line") >= min_chars)
        .select("__id", "__row", "__at", _hashes(F.col("__line")).alias("__h"))
        .select("__id", "__row", "__at", "__h.a", "__h.b")
    )
    counted = settle(
        keyed.groupBy("a", "b", "__id")
        .agg(F.lit(1).alias("one"))
        .groupBy("a", "b")
        .agg(F.count("*").alias("n"), F.max("__id").alias("__last"))
        .where(F.col("n") >= min_docs)
        .select("a", "b", "__last")
    )
    return (
        keyed.join(counted, ["a", "b"])
        .where(~F.col("__id").eqNullSafe(F.col("__last")))
        .groupBy(F.col("__id").alias("__key"), F.col("__row").alias("__text_key"))
        .agg(F.collect_list("__at").alias("__drop"))
    )


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text", n_lines: str | None = None, n_dropped: str | None = None) -> DataFrame:
    """Documents with their shared lines dropped; all columns of ``docs``.

    ``n_lines`` and ``n_dropped`` name two further columns, if given: lines before the
    drop and lines dropped.
    """
    found = shared_lines(docs, min_chars, min_docs, id_col, text_col)
    key, place = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    same = key.eqNullSafe(F.col("__key")) & (F.xxhash64(place) == F.col("__text_key"))
    joined = numbered(docs).join(found, same, "left")
    held = joined.withColumn("__lines", lines_of(place))
    size = F.size("__lines")
    # Positions left over, by a hash set: a text of many thousand lines stays linear.
    stay = F.array_except(F.sequence(F.lit(0), size - 1), F.col("__drop"))
    text = F.array_join(F.transform(stay, lambda at: F.get(F.col("__lines"), at)), "\n")
    text = F.when(F.col("__drop").isNull(), place).otherwise(text)
    named = [(text if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)]
    if n_lines:
        named.append(size.cast("long").alias(n_lines))
    if n_dropped:
        dropped = F.coalesce(F.size(F.array_distinct("__drop")), F.lit(0))
        named.append(F.greatest(dropped, F.lit(0)).cast("long").alias(n_dropped))
    return held.select(*named)
