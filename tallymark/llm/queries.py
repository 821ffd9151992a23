"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallymark.llm import bpe, licenses, lines, near, packing, pages, phrases, quality, repair, rules, symbols, topk, tries


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements and failure bits of every document, and the verdict of policy v2."""
    book = rules.ledger(table(spark, folder, "documents"))
    judged = rules.apply_policy(book, rules.POLICIES["v2"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", rules.fails(rules.POLICIES["base"].mask).alias("base_failed"), "kept", "fail_bits")


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near.join(table(spark, folder, "documents"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, folder, "documents"), n_lines="__n_lines", n_dropped="__n_dropped")
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Kept words of every document; a text that loses nothing is joined the same way."""
    out = phrases.drop_repeats(table(spark, folder, "documents"))
    words = F.regexp_replace(F.btrim(F.coalesce("text", F.lit("")), F.lit(lines.BLANKS)), r"[\x20\x09-\x0D]+", " ")
    return out.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"), F.sha2(words, 256).alias("kept_sha256"))


def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    out = pages.extract(table(spark, folder, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op6_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(table(spark, folder, "documents"), path), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    out = quality.score(docs, model)
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), lambda key: key % 20 == 0)


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    base = F.array_sort(F.array_distinct("places.label"))
    every = F.array_sort(F.array_union(base, F.col("blocks.label")))
    score = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("blocks.containment"), F.lit(0.0)))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        score.alias("score"),
    )


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    cut = packing.pieces(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(cut).select(F.col("__id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Damage to the conversations by a checksum of each turn, and the cheapest repair."""
    rows = table(spark, folder, "conversations")
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(named("text"), ".!?", "")).otherwise(named("text"))
    damaged = rows.withColumn("kind", kind).where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(named("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    found = repair.summarise(repair.repair(damaged.drop("copy")))
    every = rows.select(F.col("conv_id").alias("__c")).distinct()
    out = every.join(found, F.col("__c").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").withColumnRenamed("__c", "conv_id")
    nothing = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
    return out.fillna(nothing | {"audit": "", "repaired_sha256": repair.EMPTY}).select("conv_id", *nothing, "audit", "repaired_sha256")


def op12_sentencepiece_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = symbols.decode(symbols.encode(table(spark, folder, "documents"), path), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    fails = tries.failures(table(spark, folder, "documents"))
    return tries.audit(tries.masks(fails, table(spark, folder, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_rule_ledger,
        op2_jaccard_join,
        op3_line_dedup,
        op4_substring_dedup,
        op5_html_extraction,
        op6_bpe_round_trip,
        op7_quality_classifier,
        op8_exact_top_k,
        op9_license_scan,
        op10_best_fit_packing,
        op11_conversation_repair,
        op12_sentencepiece_round_trip,
        op13_filter_audit,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run
