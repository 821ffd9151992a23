"""Filter audit against plain loops over documents and orders."""

from __future__ import annotations

import random
import re
from itertools import permutations

import pytest

from tallymark.llm import tries

SCHEMA = "doc_id bigint, text string, lang string"
BLANK = " \t\n\x0b\x0c\r"


def _documents():
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "日本", "\x85", "　x"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    begin = say(120)
    texts = [say(rng.choice([3, 199, 200, 201, 400])) for _ in range(40)]
    texts += [f"{begin} {say(90)}" for _ in range(30)] + [begin, begin[:-1], begin + " "]
    texts += ["A" * 3 + "b" * 97, "A" * 4 + "b" * 96, say(250) + " $", "", None, "again " * 300, say(300).upper(), "x " * 150 + say(150)]
    docs = [(i, t, rng.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    docs += [(rng.randint(0, 400), rng.choice(texts), rng.choice(["en", "de"])) for _ in range(120)]
    docs += [(None, texts[0], "en"), (None, texts[0], "en"), (7, texts[7], "en"), (7, texts[7], "de"), (-3, texts[9], "fr"), (500, say(20000), "fr")]
    rng.shuffle(docs)
    return docs


DOCS = _documents()
LABELS = [(i, int(i % 3 == 0), int(i % 7 == 0)) for i in range(0, 300, 2)] + [(4, 1, 1), (4, 0, None), (None, 1, 1), (6, None, None)]


def _masks(docs):
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    for i, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search("[#$%&*|]", text)), i is not None and i > least[text]]
        yield i, part or "", fails


def _expected(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = list(_masks(docs))
    out = []
    for part in {p for _, p, _ in rows}:
        mine = [(i, f) for i, p, f in rows if p == part]
        removals = {k: 0 for k in range(5)}
        lines = []
        for order in permutations(range(5)):
            left = mine
            for step, k in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[k]]
                left = [(i, f) for i, f in left if not f[k]]
                removals[k] += len(gone)
                failing = [f for _, f in mine if f[k]]
                lines.append((part, "".join("ABCDE"[o] for o in order), step, len(left), len(gone), len(failing) - len(gone), sum(sum(f) == 1 for f in failing), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), k))
        out += [(*line[:-1], removals[line[-1]]) for line in lines]
    return sorted(out)


@pytest.mark.parametrize(("size", "prefix", "partitions"), [(1 << 24, 256, 1 << 16), (3000, 16, 1 << 16), (3000, 256, 2)])
def test_audit_equals_plain_loops(spark, monkeypatch, size, prefix, partitions):
    """In one range, in many, with prefixes too short to split, and several ranges a partition."""
    monkeypatch.setattr(tries, "RANGE_BYTES", size)
    monkeypatch.setattr(tries, "TRIE_BYTES", size)
    monkeypatch.setattr(tries, "PREFIX", prefix)
    monkeypatch.setattr(tries, "MOST_PARTITIONS", partitions)
    docs = spark.createDataFrame([(*d, 1, "x") for d in DOCS], SCHEMA + ", deal int, part string").repartition(4)
    labels = spark.createDataFrame([(*r, 0) for r in LABELS], "doc_id bigint, quality int, toxic int, n int")
    out = tries.audit(tries.masks(tries.failures(docs), labels))
    assert sorted(map(tuple, out.collect())) == _expected(DOCS, LABELS)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert tries.audit(tries.masks(tries.failures(none), labels)).count() == 0
    one = spark.createDataFrame([(1, "", None)], SCHEMA)
    assert [(r.part, r.step, r.kept) for r in tries.audit(tries.masks(tries.failures(one), labels)).where("filter_order = 'BCDEA'").orderBy("step").collect()] == [("", s, int(s < 5)) for s in range(1, 6)]


def test_tries_hold_every_text_once_in_order():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) * rng.choice([1, 1, 40]) for _ in range(3000)]
    trie = tries.Trie()
    for number, text in enumerate(texts):
        trie.add(text, number, "", 0, 1)
    walked = [(text, held.least) for text, held in trie.walk()]
    assert walked == sorted((t, texts.index(t)) for t in set(texts))


def test_ranges_keep_equal_texts_together_and_split_shared_beginnings():
    rng = random.Random(3)
    texts = [b"the same beginning " * 20 + str(rng.random()).encode() for _ in range(400)] + [str(rng.random()).encode() * 9 for _ in range(400)]
    ranges = tries.cut_ranges([(t[: tries.PREFIX], len(t)) for t in texts], 1000 * tries.RANGE_BYTES)
    dealt = [ranges.deal(t) for t in texts]
    assert max(dealt) < ranges.count and len(set(dealt)) > 300 and max(dealt.count(d) for d in set(dealt)) < 12
    assert ranges.bounds == sorted(ranges.bounds) and all(len(b) < tries.PREFIX for b in ranges.bounds)
