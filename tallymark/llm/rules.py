"""Quality rules as a ledger: every rule is evaluated once, policies are applied later.

The ledger holds, per document, the measurements and one 64-bit word of failure bits.
A policy is a versioned set of rules; applying one, or asking what each of its rules
does (ablation), is bit arithmetic on the ledger and never reads the text again.

Defined cases: a null text is an empty one (no words); an empty table gives an empty
ledger; repeated ids and repeated rows each get their own ledger row; only the id and
the text are read, so other columns may have any name; a ratio whose denominator is zero
is zero; a measurement equal to a bound passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.store import id_and_text
from tallymark.llm.words import text_slices

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_caps", "n_letters", "n_distinct_words", "n_bangs")


@dataclass(frozen=True)
class Rule:
    """A bit, a name and the condition under which a document fails."""

    bit: int
    name: str
    fails: str  # SQL over the measurements


#: Bits are never given to another rule; a changed bound is a new rule with a new bit.
RULES = (
    Rule(0, "too_few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols_per_word", "10 * n_symbols > n_words"),
    Rule(3, "short_words", "word_chars < 2 * n_words"),
    Rule(4, "long_words", "word_chars > 20 * n_words"),
    Rule(5, "repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule(6, "capitals", "2 * n_caps > n_letters"),
    Rule(7, "few_distinct_words", "20 * n_distinct_words < n_words"),
    Rule(8, "exclamations", "2 * n_bangs > n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A named version: a document is kept when none of these rules fails."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return reduce(lambda word, name: word | 1 << bits[name], self.rules, 0)


POLICIES = {
    p.version: p
    for p in (
        Policy("base", ("too_few_words", "repeated_windows")),
        Policy("v1", ("too_few_words", "repeated_windows", "symbols_per_word", "short_words", "long_words", "repeated_lines")),
        Policy("v2", tuple(r.name for r in RULES)),
    )
}


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen, twice = set(), set()
    for window in windows:
        (twice if window in seen else seen).add(window)
    count, upto = 0, 0  # upto: the first word not yet counted
    for at, window in enumerate(windows):
        if window in twice:
            count += at + 3 - max(at, upto)
            upto = at + 3
    return count


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        upper,
        sum(map(str.isalpha, text)),
        len(set(words)),
        text.count("!"),
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["__id", *MEASURES]
    for batch in text_slices(batches):
        rows = list(map(measure, batch.column("__text").to_pylist()))
        columns = zip(*rows, strict=True) if rows else [[]] * len(MEASURES)
        yield pa.RecordBatch.from_arrays([batch.column("__id"), *(pa.array(c, pa.int64()) for c in columns)], names=names)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, measurements and ``fail_bits``: one pass over the text, no shuffle."""
    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["__id"].dataType.simpleString()
    measured = rows.mapInArrow(_measured, f"__id {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES))
    bits = reduce(Column.bitwiseOR, (F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in RULES))
    return measured.select(F.col("__id").alias(id_col), *MEASURES, bits.alias("fail_bits"))


def fails(mask: int) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")) != 0


def apply_policy(book: DataFrame, policy: Policy, kept: str = "kept") -> DataFrame:
    """The ledger with the policy's verdict."""
    return book.withColumn(kept, ~fails(policy.mask))


def ablations(book: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and keepers without it.

    Documents are counted per combination of failure bits first: at most 2^rules rows
    whatever the corpus, summed before the shuffle.
    """
    patterns = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    rules = book.sparkSession.createDataFrame([(r.bit, r.name, 1 << r.bit) for r in RULES if r.name in policy.rules], "bit int, rule string, flag long")
    flag = F.col("bits").bitwiseAND(F.col("flag"))
    each = patterns.select("bits", "n", F.explode(F.array(*(F.lit(1 << r.bit).cast("long") for r in RULES if r.name in policy.rules))).alias("flag"))
    total = (
        each.groupBy("flag")
        .agg(
            F.coalesce(F.sum(F.when(flag != 0, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(F.col("bits") == F.col("flag"), F.col("n"))), F.lit(0)).alias("n_failed_alone"),
            F.coalesce(F.sum(F.when((F.col("bits") == 0) | (F.col("bits") == F.col("flag")), F.col("n"))), F.lit(0)).alias("n_kept_without"),
        )
    )
    return rules.join(total, "flag").select("bit", "rule", "n_failed", "n_failed_alone", "n_kept_without")
