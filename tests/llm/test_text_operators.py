"""Each text operator against its brute-force version, on tables with awkward rows."""

from __future__ import annotations

import itertools
import random
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymark.llm import bpe, licenses, lines, near, packing, phrases, quality, rules, words

VOCABULARY = [f"w{i}" for i in range(400)] + ["é", "日本", "Wörter,", "MIT"]


def _documents():
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))
    passage, line = say(60), "A line that several documents share"
    docs = [(i, "\n".join(say(rng.randint(1, 80)) for _ in range(rng.randint(1, 6)))) for i in range(60)]
    base = say(200).split(" ")
    for i in range(60, 90):  # near copies of one text
        copy = list(base)
        copy[rng.randrange(200)] = f"new{i}"
        docs.append((i, " ".join(copy)))
    docs += [(i, docs[3][1]) for i in range(90, 100)]  # exact copies
    docs += [(i, f"{say(30)} {passage}\n  {line.upper()}\t\n{say(20)}") for i in range(100, 112)]
    docs += [(112, None), (113, ""), (114, " \n\t\n "), (115, "one"), (116, "a b c d"), (117, "a b c d"), (None, passage + " tail"), (None, "x\n" + line)]
    docs += [(118, "again " * 5000), (119, say(20000)), (3, docs[3][1]), (-7, docs[70][1]), (1 << 40, docs[70][1])]
    docs += [(120, "It's <|endoftext|> 5 o'clock,\r\n　Ünïcodé   x"), (121, f"{line}\n\n{line}\n")]
    rng.shuffle(docs)
    return docs


DOCS = _documents()
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def docs(spark):
    extra = [(i, t, "a", 1, "n", True) for i, t in DOCS]
    return spark.createDataFrame(extra, SCHEMA + ", __key string, n int, words string, kept boolean").repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(rows):
    return sorted(map(repr, rows))


def test_line_dedup(docs, empty):
    out = lines.dedup_lines(docs, n_lines="lines", n_dropped="dropped")
    assert out.columns == [*docs.columns, "lines", "dropped"]
    assert bag(tuple(r) for r in out.select("doc_id", "lines", "dropped", "text").collect()) == bag(brute.line_dedup(DOCS))
    assert lines.dedup_lines(empty).count() == 0


def test_near_join(docs, empty):
    out = near.join(docs)
    assert bag(tuple(r) for r in out.collect()) == bag(brute.near(DOCS))
    assert near.join(empty).count() == 0


def test_near_join_in_small_blocks(docs, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 4)
    assert bag(tuple(r) for r in near.join(docs).collect()) == bag(brute.near(DOCS))


def test_prefixes_get_shorter_until_the_target(spark, monkeypatch):
    rng = random.Random(2)
    pairs = []
    for i in range(150):  # similarities just above the threshold
        base = [f"p{i}x{j}" for j in range(204)]
        other = list(base)
        for at in rng.sample(range(3, 200, 6), 4):
            other[at] = f"q{i}y{at}"
        pairs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    frame = spark.createDataFrame(pairs, SCHEMA)
    got = {r.doc_id: r.class_id for r in near.join(frame, target=0.99999).collect()}
    assert sum(got[2 * i + 1] == 2 * i for i in range(150)) >= 149
    # The target of the queries asks for shorter prefixes here too.
    lengths, verify = [], near._verify
    monkeypatch.setattr(near, "_verify", lambda length, *more: (lengths.append(length), verify(length, *more))[1])
    near.join(frame).count()
    assert lengths == [5, 4]


def test_keep_one_of_each_class(docs):
    kept = {r.doc_id for r in near.keep_one(docs).collect()}
    classes = defaultdict(list)
    for i, c, _ in brute.near(DOCS):
        classes[c].append(i)
    assert kept == set(classes)


def test_near_tells_rows_with_equal_ids_apart(spark):
    say = lambda name: " ".join(f"{name}{k}" for k in range(120))
    close = lambda name: say(name) + " end"
    rows = [(None, say("a")), (None, say("b")), (None, close("b")), (None, None), (None, ""), (7, say("c")), (7, say("d")), (8, close("c")), (9, close("d")), (9, say("e"))]
    rows += [(3, close("e")), (9, "  "), (9, None), (11, say("f")), (11, say("f"))]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert bag(tuple(r) for r in near.join(frame).collect()) == bag(brute.near(rows))
    kept = [tuple(r) for r in near.keep_one(frame).collect()]
    b = [r for r in kept if r in ((None, say("b")), (None, close("b")))]
    assert len(b) == 1
    assert bag(kept) == bag([*b, (None, say("a")), (None, None), (None, ""), (7, say("c")), (7, say("d")), (3, close("e")), (9, "  "), (9, None), (11, say("f"))])


def test_substring_dedup(docs, empty):
    out = phrases.drop_repeats(docs)
    assert out.columns == [*docs.columns, "__n_words", "__n_removed"]
    assert bag(tuple(r) for r in out.select("doc_id", "__n_words", "__n_removed", "text").collect()) == bag(brute.substring_dedup(DOCS))
    assert phrases.drop_repeats(empty).count() == 0


def test_substring_dedup_over_many_shards_and_groups(docs, monkeypatch):
    for name in ("SHARD_BYTES", "GROUP_BYTES", "BATCH_BYTES"):
        monkeypatch.setattr(phrases, name, 1 << 12)
    monkeypatch.setattr(phrases, "BLOCK", 4)
    out = phrases.drop_repeats(docs).select("doc_id", "__n_words", "__n_removed", "text")
    assert bag(tuple(r) for r in out.collect()) == bag(brute.substring_dedup(DOCS))


def test_substring_dedup_of_short_texts_alone(spark):
    """Partitions without a single window, one of them for each row; windows that nothing shares."""
    rows = [(1, "a b c"), (2, None), (3, ""), (4, "x " * 12), (5, " ".join(VOCABULARY[:14]))]
    short = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for docs in (short, short.coalesce(1), short.where("text is null"), short.where("doc_id = 3"), short.where("doc_id = 5")):
        out = phrases.drop_repeats(docs, n_words="w", n_removed="r")
        assert bag(tuple(r) for r in out.select("doc_id", "w", "r", "text").collect()) == bag(brute.substring_dedup([tuple(r) for r in docs.select("doc_id", "text").collect()]))


def test_substring_dedup_of_ids_with_a_stride_or_none(spark, monkeypatch):
    """Groups are dealt by a hash of the block: ids of any stride, and null ids, spread."""
    monkeypatch.setattr(phrases, "GROUP_BYTES", 2000)
    say = " ".join(VOCABULARY[:20])
    rows = [(i * 6400, f"{VOCABULARY[i]} {say} {VOCABULARY[-i]}") for i in range(200)] + [(None, f"{say} end{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = phrases.drop_repeats(docs, n_words="w", n_removed="r")
    assert bag(tuple(r) for r in out.select("doc_id", "w", "r", "text").collect()) == bag(brute.substring_dedup(rows))
    block = phrases._block(F.col("doc_id"), F.col("text"))
    dealt = docs.withColumn("g", phrases._group(block, 100)).groupBy("g", F.col("doc_id").isNull().alias("none")).count()
    assert max(r["count"] for r in dealt.collect()) < 12
    blocks = docs.select(block.alias("b"), phrases._group(block, 100).alias("g")).collect()
    assert phrases._group_of(np.array([r.b for r in blocks]), 100).tolist() == [r.g for r in blocks]


def test_chance_agreement_of_codes_removes_nothing(docs, monkeypatch):
    import numpy as np

    monkeypatch.setattr(phrases, "GROUP_BYTES", 1 << 14)
    coarse = lambda hashes, shards: (np.zeros(len(hashes), np.int64), hashes % np.uint64(4096))
    monkeypatch.setattr(phrases, "_codes", coarse)
    few = docs.where("length(text) < 2000 or text is null")
    most = {i: n for i, _, n, _ in brute.substring_dedup([d for d in DOCS if d[1] is None or len(d[1]) < 2000])}
    found = phrases.drop_repeats(few).select("doc_id", "__n_removed").collect()
    assert all(r["__n_removed"] <= most[r.doc_id] for r in found) and any(r["__n_removed"] for r in found)


@pytest.mark.parametrize("bound", [1 << 24, 4000, 0])
def test_bpe_round_trip(docs, empty, bound):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = bpe.tokenizer(path)
    out = bpe.decode(bpe.encode(docs, path, table_bytes=bound), path)
    expected = []
    for i, text in DOCS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert bag(tuple(r) for r in out.collect()) == bag(expected)
    assert bpe.encode(empty, path).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_where_the_library_never_merges(name):
    rng = random.Random(1)
    alphabet = "ab Z9\n\t\r\x0b\x1c\x1f\x85  　'sééÉßΣσİ東\U0001f600,.!-  ​́"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["a\n\n\nb\n\n", " a  b ", "a\0b c", "<|startoftext|>x<|ENDOFTEXT|> y<|endoftext|>"]
    path = public_tokenizers.path(name)
    encoder = bpe.WordEncoder(path, *((bpe.spaced_units,) if name.startswith("byte") else (bpe.bare_units, True)))
    expected = [bpe._packed(e.ids) for e in bpe.tokenizer(path).encode_batch(texts, add_special_tokens=False)]
    assert encoder(texts) == expected


def test_texts_in_one_row_get_the_ids_of_the_library():
    rng = random.Random(2)
    alphabet = "ab Z9\n\t\r\x0b\x1c\x1f\x85\xa0\u1680\u2003\u200b\u2028\u3000'sééÉßΣσİ東ЖאعかҢ한Ꮳ\U0001f600,.!-_ ×ªǃ\u0301"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    texts += [None, "", "a\n\n\nb\n\n", " a  b ", "  ", "\u2003", "\u2003x", "a\0b c", "don't it's. x's_y'll", "<|endof", "text|>", "\n", "\t", " "]
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = bpe.WordEncoder(path)
    for part in (texts, [*texts, "x<|endoftext|> y", "<|endoftext|>"], [None, ""], []):
        expected = [e.ids for e in bpe.tokenizer(path).encode_batch([t or "" for t in part], add_special_tokens=False)]
        column = pa.array(["before", *part, "after"], pa.string()).slice(1, len(part))
        values, begins = encoder.flat(column)
        assert [values[a:b].tolist() for a, b in itertools.pairwise(begins.tolist())] == expected


def test_letters_are_counted_without_their_marks_and_spared_the_pattern(spark, monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(1, "grün, grün. word, word. word!"), (2, "word élevé."), (3, None)], SCHEMA)
    found = {r["word"]: r["n"] for r in bpe.word_table(docs, path).collect()}
    assert found == {"grün": 1, " grün": 1, " word": 3, "word": 1, " élevé.": 1, ",": 2, ".": 2, "!": 1}
    expected = [bpe._packed(e.ids) for e in bpe.tokenizer(path).encode_batch([" grün", "Straße", " élève", " слово"], add_special_tokens=False)]
    seen = []
    whole = bpe._ids
    monkeypatch.setattr(bpe, "_ids", lambda library, text: seen.append(text) or whole(library, text))
    assert bpe.WordEncoder(path).encode_words([" grün", "Straße", " élève", " слово"]) == expected
    assert all(not any(c.isalpha() for c in text) for text in seen)


def test_ids_that_end_within_a_character_are_decoded_as_by_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = bpe.tokenizer(path)
    whole = library.encode("a\U0001f600\u1ccd", add_special_tokens=False).ids
    rows = [(1, whole), (2, whole[:-1]), (3, whole[2:]), (4, []), (5, None), (6, [50256])]
    coded = spark.createDataFrame(rows, "doc_id long, ids array<int>").coalesce(1)
    out = {r.doc_id: r.decoded for r in bpe.decode(coded, path).collect()}
    assert out == {i: library.decode(ids or [], skip_special_tokens=False) for i, ids in rows}
    assert "\ufffd" in out[2] and "\ufffd" in out[3]


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    out = [tuple(r) for r in packing.pack(packing.pieces(docs, path), group_tokens=20_000).collect()]
    assert bag(r[:5] for r in out) == bag(brute.pieces(DOCS, bpe.tokenizer(path)))
    sequences = defaultdict(list)
    for *_, length, _, sequence, offset in [(r[0], r[1], r[2], r[3], r[4], r[5], r[6]) for r in out]:
        sequences[sequence].append((offset, length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    total = sum(r[3] for r in out)
    assert len(sequences) <= 1.03 * -(-total // packing.LENGTH) + 1
    assert packing.pack(packing.pieces(empty, path)).count() == 0


def test_local_search_empties_bins():
    # Best fit needs four bins of 10; an exchange of two for one frees one.
    number, _, fill = packing.pack_group([6, 6, 4, 4, 3, 3, 2, 2], 10)
    assert len(set(number)) == 3 and set(fill) == {10}
    rng = random.Random(3)
    for _ in range(50):
        sizes = [rng.randint(1, 100) for _ in range(rng.randint(1, 60))]
        before = len(packing.Bins(sizes, 100).items)
        number, offset, fill = packing.pack_group(sizes, 100)
        assert len(set(number)) <= before and max(fill) <= 100
        for b in set(number):
            held = sorted((offset[i], sizes[i]) for i in range(len(sizes)) if number[i] == b)
            assert [o for o, _ in held] == [sum(s for _, s in held[:n]) for n in range(len(held))]


def test_rule_ledger(docs, empty):
    book = rules.ledger(docs).collect()
    assert len(book) == len(DOCS)
    for row in book:
        assert bool(row.fail_bits & 1) == (row.n_words < 50)
        assert bool(row.fail_bits & 2) == (100 * row.n_repeat_words > 50 * row.n_words)
    assert rules.ledger(empty).count() == 0
    for words, expected in (("a b c", 0), ("a b c a b c", 6), ("a a a a", 4), ("x a b c y a b c", 6), ("a b a b a", 5)):
        assert rules.repeated_words(words.encode().split()) == expected


def test_policies_and_ablations(spark):
    book = spark.createDataFrame([(0,), (1,), (3,), (3,), (4,), (256,), (0,)], "fail_bits bigint")
    judged = [r.kept for r in rules.apply_policy(book, rules.POLICIES["base"]).collect()]
    assert judged == [True, False, False, False, True, True, True]
    found = {r.rule: (r.n_failed, r.n_failed_alone, r.n_kept_without) for r in rules.ablations(book, rules.POLICIES["base"]).collect()}
    assert found == {"too_few_words": (3, 1, 5), "repeated_windows": (2, 0, 4)}
    assert rules.ablations(book.limit(0), rules.POLICIES["base"]).count() == 0


def test_license_scan_equals_all_pairs(spark, empty):
    rng = random.Random(4)
    pool = [w for _, t in licenses.TEMPLATES for w in t.split()] + VOCABULARY
    texts = [None, "", "The MIT-License; mit license mit mit license", "apache\nlicense", "general public general public license"]
    for _ in range(150):
        kept = [w for w in rng.choice(licenses.TEMPLATES)[1].split() if rng.random() < 0.95]
        rng.shuffle(kept)
        texts.append(" ".join(rng.choices(pool, k=10)) + "\n" + " ".join(kept + rng.choices(pool, k=3)).upper())
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for row in licenses.scan(frame).collect():
        expected = set()
        for at, line in enumerate((texts[row.doc_id] or "").split("\n")):
            held = set(licenses.words_of(line))
            for label, template in licenses.TEMPLATES:
                tokens = set(licenses.words_of(template))
                if len(tokens & held) >= licenses.THRESHOLD * len(tokens) - 1e-9:
                    expected.add((at, label))
        assert {(b.line, b.label) for b in row.blocks} == expected
    places = {r.doc_id: [(p.word, p.label) for p in r.places] for r in licenses.scan(frame).collect()}
    assert places[2] == [(1, "mit"), (3, "mit"), (6, "mit")] and places[3] == [(0, "apache")] and places[4] == [(2, "gpl")]
    assert licenses.scan(empty).count() == 0


WRAPPED = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a\ncopy of this software and associated documentation files (the\n\"Software\"), to deal in the Software without restriction",
    "bsd": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:",
    "gpl": "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General\n#\n# Public License as published by",
}


def test_license_notices_wrapped_over_lines(spark):
    texts = [(label, "a line before\n" + text + "\nafter") for label, text in WRAPPED.items()]
    found = {r.doc_id: [(b.line, b.label, b.containment) for b in r.blocks] for r in licenses.scan(spark.createDataFrame(texts, "doc_id string, text string")).collect()}
    for label in WRAPPED:
        assert [b[:2] for b in found[label]] == [(1, label)] and found[label][0][2] >= 0.9


def test_license_words_scattered_over_a_very_long_line(spark):
    rng = random.Random(12)
    scattered = []
    for _, template in licenses.TEMPLATES:
        for word in template.split():
            scattered += [word, *rng.choices(VOCABULARY[:400], k=40)]
    notice = scattered[:9000] + WRAPPED["bsd"].split() + scattered[9000:]
    frame = spark.createDataFrame([(0, " ".join(scattered)), (1, " ".join(notice))], SCHEMA)
    assert {r.doc_id: [(b.line, b.label) for b in r.blocks] for r in licenses.scan(frame).collect()} == {0: [], 1: [(0, "bsd")]}


def test_license_windows_equal_brute_force():
    rng = random.Random(13)
    templates = (("x", "a b c d e f g h i j k l"), ("y", "m n a b c"))
    matcher = licenses.Matcher.build(templates, 0.8, {b"a": 9, b"b": 5})
    for _ in range(300):
        words = [w.encode() for w in rng.choices("abcdefghijklmn" + "z" * rng.randint(0, 6), k=rng.randint(0, 60))]
        expected = set()
        for label, text in templates:
            tokens, length = set(licenses.words_of(text)), len(text.split())
            width = length + licenses.slack(length)
            best = max((len(tokens.intersection(words[i : i + width])) for i in range(len(words))), default=0)
            if best >= 0.8 * len(tokens) - 1e-9:
                expected.add((label, best / len(tokens)))
        got: dict[str, float] = {}
        for _, label, share in matcher.passages(words):
            got[label] = max(got.get(label, 0.0), share)
        assert set(got.items()) == expected


def test_quality_classifier_learns_and_holds_out(spark, docs):
    rng = random.Random(8)
    rows = [(i, " ".join((f"{w}***" if i % 4 == 0 else w) for w in rng.choices(VOCABULARY, k=rng.randint(5, 200)))) for i in range(600)]
    frame = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, None if i % 50 == 1 else int(i % 4 != 0)) for i, _ in rows] + [(2, 0)], "doc_id bigint, quality int")
    model = quality.fit(frame, labels)
    scored = quality.score(frame, model).withColumn("held", quality.held_out(F.col("doc_id"))).collect()
    held = [r for r in scored if r.held]
    assert 150 < len(held) < 250
    assert sum((r.score >= 0.5) == (r.doc_id % 4 != 0) for r in held) >= 0.97 * len(held)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    good = {r.doc_id for r in quality.score(docs, model).collect() if r.score >= 0.5}
    assert {r.doc_id for r in kept.collect()} == good


def test_quality_without_labels_is_undecided(spark, docs, empty):
    model = quality.fit(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert {r.score for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.score(empty, model).count() == 0


def _plain_features(text):
    """Buckets and weights of a text, word by word and gram by gram."""
    base, spread = 0x9E3779B97F4A7C15 | 1, 1 << 64
    one = lambda x: int(words.mix(np.array([x % spread], dtype=np.uint64))[0])
    spell = lambda part: sum((b + 0) * pow(base, i, spread) for i, b in enumerate(part)) % spread
    found, before, weights = brute.words(text), None, defaultdict(float)
    for word in found:
        raw = word.encode()
        buckets = [one(one(spell(raw) + len(raw))) % quality.BUCKETS] if word != before else [one(0x5A17) % quality.BUCKETS]
        for size in quality.GRAMS if word != before else ():
            for at in range(len(raw) - size + 1):
                edge = (at == 0) + 2 * (at + size == len(raw))
                buckets.append(one(spell(raw[at : at + size]) ^ edge << 60 ^ size) % quality.BUCKETS)
        for bucket in buckets:
            weights[bucket] += 1 / (len(found) * len(buckets))
        before = word
    return weights


def test_quality_features_and_scores_equal_plain_loops():
    texts = ["", None, "one", "again again  again", "Ünï cödé 日本 a\nbc", DOCS[0][1]]
    model = np.random.default_rng(3).normal(size=quality.BUCKETS + 1).astype(np.float32)
    for text, score in zip(texts, quality.scores(model, texts), strict=True):
        expected = _plain_features(text)
        bucket, weight = quality.document_features(text)
        assert bucket.tolist() == sorted(expected)
        assert np.allclose(weight, [expected[b] for b in bucket.tolist()], rtol=1e-5)
        logit = model[-1] + sum(w * model[b] for b, w in expected.items())
        assert abs(score - 1 / (1 + np.exp(-logit))) < 1e-5


def test_quality_of_repeated_ids_is_learned_from_a_fixed_text(spark, docs):
    labels = docs.select("doc_id").distinct().withColumn("quality", (F.col("doc_id") % 2).cast("int"))
    twice = docs.unionByName(docs.withColumn("text", F.concat(F.lit("other "), "text")))
    models = [quality.fit(frame, labels) for frame in (twice, twice.repartition(7).orderBy(F.desc("text")))]
    assert (models[0] == models[1]).all()
