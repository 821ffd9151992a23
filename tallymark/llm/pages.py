"""Main text of web pages: page structure first, then a suffix array per host.

A page is read into blocks of text. Markup decides where it can: blocks in an article or
main element stay, blocks of navigation, forms, notices, adverts, comments and the like
go, but no class or id takes the main element itself or what wraps it. For pages without such an element the open blocks are judged by their host: the token
streams of its pages are concatenated, a suffix array over them finds every substring of
at least ``LONGEST`` tokens that distinct pages share, tokens under such a substring are
boilerplate, and the runs between them are kept.

A host with many pages is dealt into groups of about ``GROUP`` pages, each with its own
suffix array. What the pages of one group cannot show is found before: every window of
``LONGEST`` tokens of such a host is hashed (128 bits), the windows that distinct streams
of the host hold are joined back to the groups, and a group covers its own windows with
those hashes as well. So a page's text does not depend on the groups. The hashes are one row
of 40 bytes and the host's name per distinct window and group; article text never leaves its task.

Defined cases: a null or empty page has no text; a page without text gives an empty
string; unclosed elements end with the page; pages with equal streams count as one, so a
copied page is no proof of boilerplate; repeated ids and rows get a result each; a null
url is a host of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.store import settle
from tallymark.llm.words import gram_hashes, mix, signed, text_slices, word_hashes

#: Tokens that a shared substring has at least, and pages of a host judged together.
LONGEST = 8
GROUP = 96

_TEXT, _TAG = re.compile("[^<]+"), re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_COMMENT_END = re.compile("--!?>")
_GAP, _NAME, _EQUALS, _BARE = (re.compile(p) for p in (r"[\s/]*", r"=?[^\s/>=]*", r"\s*=\s*", r"[^\s>]*"))
#: Elements whose content is no markup and no text of the page.
RAW = {t: re.compile(f"</{t}(?=[\\s/>])", re.IGNORECASE) for t in "script style noscript template iframe svg textarea select title".split()}

#: Elements that begin a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head"
    " header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
MAIN = frozenset(("article", "main"))
DROPPED = frozenset("nav footer aside form button dialog menu search head".split())
#: Words of class, id and role attributes that mark what is not main text.
MARKS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies disqus footer form header masthead"
    " menu modal nav navbar navigation newsletter notice notices popup promo promotion related respond search share sharing sidebar social sponsor sponsored"
    " subscribe toolbar widget".split()
)
#: A paragraph or list item ends where the next begins.
CLOSED_BY = {"p": BLOCKS, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "tr": frozenset(("tr",)), "option": frozenset(("option",))}


#: Marks that a wrapper of a title inside the main element may carry.
HEADS = frozenset(("header", "masthead"))

#: How an element is dropped: not, by a mark that is part of a name (``with-sidebar``), by
#: a mark that is a whole name (``sidebar``), by its tag or because it is hidden.
NOT, PART, WHOLE, SURE = range(4)


#: Ids that name the readers' part of a page. Other ids inside the main element are names
#: of its sections, and say nothing.
COMMENT_IDS = frozenset(("comments", "comment-section", "disqus_thread", "respond"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

Attributes = list[tuple[str, str]]


def _attributes(page: str, at: int) -> tuple[Attributes, int, bool] | None:
    """Attributes of the tag whose name ends at ``at``, where the tag ends, and whether by a slash.

    They are read one by one and a quoted value as a whole, so what a value holds is
    neither a name nor the end of the tag. Nothing if the page ends before the tag does.
    """
    found: Attributes = []
    while True:
        gap = _GAP.match(page, at)
        at = gap.end()
        if at >= len(page):
            return None
        if page[at] == ">":
            return found, at + 1, gap.group().endswith("/")
        name = _NAME.match(page, at)
        at, value = name.end(), ""
        equals = _EQUALS.match(page, at)
        if equals:
            at = equals.end()
            quote = page[at : at + 1]
            if quote in ("'", '"'):
                end = page.find(quote, at + 1)
                if end < 0:
                    return None
                value, at = page[at + 1 : end], end + 1
            else:
                bare = _BARE.match(page, at)
                value, at = bare.group(), bare.end()
        found.append((name.group().lower(), value))


Token = tuple[str, str, Attributes, bool]


def _tokens(page: str) -> Iterator[Token]:
    """Texts and tags in order: ``text``, ``open`` or ``close``, and what goes with it.

    Every character is passed once. A tag that the page's end cuts off would be read to the end
    again from every later one, so from the first such on a tag ends at the next bracket.
    """
    at, cut_off, last = 0, False, page.rfind(">")
    while at < len(page):
        text = _TEXT.match(page, at)
        if text:
            yield "text", text.group(), [], False
            at = text.end()
            continue
        if page.startswith("<!--", at):
            end = _COMMENT_END.search(page, at + 4)
            at = end.end() if end else len(page)
            continue
        if page.startswith(("<!", "<?"), at) and at < last:
            at = page.find(">", at) + 1
            continue
        tag = _TAG.match(page, at + 1)
        if tag and tag.end() <= last:
            read = None if cut_off else _attributes(page, tag.end())
            if read is None:
                cut_off = True
                end = page.find(">", tag.end())
                read = [], end + 1, page[end - 1] == "/"
            attributes, at, by_slash = read
            name = tag[2].lower()
            yield "close" if tag[1] else "open", name, attributes, by_slash
            if name in RAW and not tag[1]:
                close = RAW[name].search(page, at)
                at = page.find(">", close.end()) + 1 if close and close.end() <= last else len(page)
            continue
        yield "text", "<", [], False
        at += 1


def _dropped(tag: str, attributes: Attributes, inside: bool) -> int:
    if tag in DROPPED or tag == "header" and not inside:
        return SURE
    kind = NOT
    for name, value in attributes:
        value = value.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return SURE
        if name == "id" and inside:
            if value.strip() in COMMENT_IDS and tag not in HEADINGS:
                kind = WHOLE
        elif name in ("class", "id", "role"):
            marks = MARKS - HEADS if inside else MARKS
            if not marks.isdisjoint(value.split()):
                kind = WHOLE
            elif not inside and not marks.isdisjoint(re.split(r"[^a-z0-9]+", value)):
                kind = max(kind, PART)
    return kind


def blocks_of(page: str | None) -> list[tuple[str, str]]:
    """Blocks in page order: what decided (``main``, ``dropped``, ``open``), and the text.

    A mark drops neither html, body nor main, nor what holds a main element. It drops an
    article, or what holds one, only as a whole name and if the page has main text besides
    (readers' comments are articles too). If marks leave nothing of a page, or of its main
    elements, those that are parts of names do not count.
    """
    spared: set[int] = set()
    blocks, wrappers, has_main, partial = _blocks(page, spared)
    sure = {e for e, (kind, tag) in wrappers.items() if tag != "article" or kind == PART}
    if sure:
        spared |= sure
        blocks, wrappers, has_main, partial = _blocks(page, spared)
    if wrappers and not any(kind == "main" for kind, _ in blocks):
        spared |= wrappers.keys()
        blocks, wrappers, has_main, partial = _blocks(page, spared)
    if partial and not any(kind == "main" if has_main else kind == "open" for kind, _ in blocks):
        blocks = _blocks(page, spared | partial)[0]
    return blocks


def _blocks(page: str | None, spared: set[int]) -> tuple[list[tuple[str, str]], dict[int, tuple[int, str]], bool, set[int]]:
    """Blocks if the marks of some elements, given by number, do not count.

    Also the marked elements that are or hold a main element (how they are marked, and
    ``main`` or ``article``; html and body as ``main``), whether any main element stays,
    and all elements with a mark that is part of a name.
    """
    wrappers: dict[int, tuple[int, str]] = {}
    partial: set[int] = set()
    has_main, number = False, -1
    marked: list[tuple[int, int]] = []  # of each element in the stack: its number, or -1 if not marked; how
    out: list[tuple[str, str]] = []
    held: list[str] = []
    lost: list[str] = []  # text of dropped elements within a line; the line goes on behind them
    kind_held = "open"
    stack: list[tuple[str, bool, bool, bool]] = []  # element, whether dropped, in the main element, dropped within a line
    dropped = inside = soft = False

    def end() -> None:
        for kind, parts in ((kind_held, held), ("dropped", lost)):
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append((kind, text))

    for what, tag, attributes, by_slash in _tokens(page or ""):
        if what == "text" or tag == "br":
            text = tag if what == "text" else " "
            if soft:
                lost.append(text)
                continue
            if not held:
                kind_held = "dropped" if dropped else "main" if inside else "open"
            held.append(text)
            continue
        if tag in RAW:
            continue
        if tag in BLOCKS or tag == "hr":
            end()
        if what == "close":
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if at is not None and (tag in BLOCKS or not any(s[0] in BLOCKS for s in stack[at:])):
                before = stack[at - 1] if at else ("", False, False, False)
                if not stack[at][3] and before[1:3] != stack[at][1:3]:
                    end()
                del stack[at:], marked[at:]
        elif tag not in VOID and not by_slash:
            if stack and tag in CLOSED_BY.get(stack[-1][0], ()):
                stack.pop()
                marked.pop()
            elif tag in BLOCKS:  # inline elements left open in a paragraph end with it
                at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCKS), None)
                if at is not None and stack[at][0] == "p":
                    del stack[at:], marked[at:]
            was = stack[-1] if stack else ("", False, False, False)
            number += 1
            kind = _dropped(tag, attributes, was[2])
            if kind in (PART, WHOLE):
                if kind == PART:
                    partial.add(number)
                if number in spared:
                    kind = NOT
                elif tag in ("html", "body"):
                    wrappers[number] = kind, "main"
            marked.append((number if kind in (PART, WHOLE) else -1, kind))
            if tag in MAIN and not any(k == SURE for _, k in marked):
                for element, how in marked:
                    if element >= 0 and wrappers.get(element, (how, ""))[1] != "main":
                        wrappers[element] = how, tag
            drop = was[1] or kind != NOT
            main = was[2] or tag in MAIN and not drop
            within = drop and (was[3] or not was[1]) and tag not in BLOCKS
            if not within and (drop != dropped or main != inside):
                end()
            stack.append((tag, drop, main, within))
            has_main = has_main or main
        else:
            continue
        dropped, inside, soft = stack[-1][1:] if stack else (False, False, False)
    end()
    return out, wrappers, has_main, partial


def shared_places(streams: list[np.ndarray], longest: int = LONGEST) -> list[np.ndarray]:
    """For each stream, which tokens lie under a substring that another stream holds too.

    The suffix array of the concatenated streams is built by prefix doubling as far as
    ``longest`` tokens: neighbours in it that agree that far share the substring.
    """
    lengths = np.array([len(s) for s in streams], dtype=np.int64)
    total = int(lengths.sum()) + len(streams)
    tokens, owner = np.zeros(total, np.int64), np.zeros(total, np.int64)
    begins, at = [], 0
    for number, stream in enumerate(streams):
        begins.append(at)
        tokens[at : at + len(stream)] = stream + len(streams)
        tokens[at + len(stream)] = number  # an end mark of its own: no match runs over it
        owner[at : at + len(stream) + 1] = number
        at += len(stream) + 1
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    size = 1
    while size < longest:
        step = min(size, longest - size)
        after = np.zeros(total, np.int64)
        after[: total - step] = rank[step:] + 1
        rank = np.unique(rank * (total + 2) + after, return_inverse=True)[1].astype(np.int64)
        size += step
    order = np.argsort(rank, kind="stable")
    sorted_rank, sorted_owner = rank[order], owner[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_rank[1:] != sorted_rank[:-1]))) if total else np.zeros(0, np.int64)
    several = np.minimum.reduceat(sorted_owner, starts) != np.maximum.reduceat(sorted_owner, starts) if total else np.zeros(0, bool)
    hit = np.zeros(total + 1, np.int64)
    counts = np.diff(np.append(starts, total))
    places = order[np.repeat(several, counts)]
    np.add.at(hit, places, 1)
    np.add.at(hit, np.minimum(places + longest, total), -1)
    covered = np.cumsum(hit)[:total] > 0
    return [covered[b : b + n] for b, n in zip(begins, lengths, strict=True)]


def window_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every ``LONGEST`` consecutive tokens of a stream."""
    hashes = word_hashes(["\n".join(words)])[0]
    return signed(gram_hashes(hashes, LONGEST)), signed(gram_hashes(mix(hashes ^ np.uint64(0x5BD1E995)), LONGEST))


def host_texts(pages: list[list[tuple[str, str]]], known: set[tuple[int, int]] | None = None) -> list[str]:
    """Text of each page of one host, from its blocks outside the main element.

    ``known`` are hashes of windows that other streams of the host hold.
    """
    numbers: dict[str, int] = {}
    streams = [np.array([numbers.setdefault(t, len(numbers)) for _, text in page for t in text.split()], dtype=np.int64) for page in pages]
    first: dict[bytes, int] = {}
    unique = [first.setdefault(s.tobytes(), i) for i, s in enumerate(streams)]
    leaders = sorted(set(unique))
    covered = dict(zip(leaders, shared_places([streams[i] for i in leaders]), strict=True))
    for leader in leaders if known else ():
        words = [w for _, text in pages[leader] for w in text.split()]
        for begin, pair in enumerate(zip(*(h.tolist() for h in window_hashes(words)), strict=True)):
            if pair in known:
                covered[leader][begin : begin + LONGEST] = True
    out = []
    for page, leader in zip(pages, unique, strict=True):
        blocks, at = [], 0
        for kind, text in page:
            words = text.split()
            shared = covered[leader][at : at + len(words)]
            at += len(words)
            if kind == "open":
                runs = np.split(np.arange(len(words)), np.flatnonzero(shared[1:] != shared[:-1]) + 1)
                blocks += [" ".join(words[r[0] : r[-1] + 1]) for r in runs if len(r) and not shared[r[0]]]
        out.append("\n\n".join(blocks))
    return out


_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Id, url and ``text`` of every page.

    Pages with a main element are finished in the scan. The streams of the blocks outside
    it, a small part of the pages, go to their host's groups; so do pages without one.
    """
    rows = pages.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{url_col}`").alias("__url"), F.col(f"`{html_col}`").alias("__text"))
    kinds = f"__id {rows.schema['__id'].dataType.simpleString()}, __url {rows.schema['__url'].dataType.simpleString()}"
    blocks_type = pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string())]))

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            read = [blocks_of(t) for t in batch.column("__text").to_pylist()]
            main = [any(kind == "main" for kind, _ in page) for page in read]
            texts = ["\n\n".join(t for kind, t in page if kind == "main") for page, m in zip(read, main, strict=True) if m]
            kept = batch.filter(pa.array(main, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("__id"), kept.column("__url"), pa.array(texts, pa.string())], names=["__id", "__url", "text"])

    def outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            read = [blocks_of(t) for t in batch.column("__text").to_pylist()]
            wanted = [not any(kind == "main" for kind, _ in page) for page in read]
            rest = [[{"kind": k, "text": t} for k, t in page if k != "main"] for page in read]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__url"), pa.array(wanted, pa.bool_()), pa.array(rest, blocks_type)], names=["__id", "__url", "wanted", "blocks"])

    done = rows.mapInArrow(finished, f"{kinds}, text string")
    streams = rows.mapInArrow(outside, f"{kinds}, wanted boolean, blocks array<struct<kind: string, text: string>>")
    streams = settle(streams.withColumn("__host", F.lower(F.regexp_extract(F.coalesce(F.col("__url").cast("string"), F.lit("")), _HOST, 1))))
    # Only hosts with a page to judge need their streams brought together. Settled, so that
    # the join has plain shuffles on both sides and a hot host is split.
    hosts = settle(streams.groupBy("__host").agg(F.count("*").alias("__n"), F.max("wanted").alias("__any")).where(F.col("__any")).select(F.col("__host").alias("__h"), "__n"))
    salt = F.pmod(F.xxhash64("__id", F.size("blocks")), F.ceil(F.col("__n") / F.lit(GROUP)))
    grouped = streams.join(hosts, F.col("__host") == F.col("__h")).withColumn("__salt", salt)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words = [w for b in batch.column("blocks")[row].as_py() for w in b["text"].split()]
                a, b = window_hashes(words)
                pair = np.unique(np.stack([a, b], axis=1), axis=0)
                stream = hashlib.blake2b("\n".join(words).encode("utf-8", "replace"), digest_size=8).digest()
                number = np.full(len(pair), np.frombuffer(stream, np.int64)[0])
                if len(pair):
                    same = lambda name, n=len(pair), row=row, batch=batch: pa.array([batch.column(name)[row].as_py()] * n, batch.schema.field(name).type)
                    yield pa.RecordBatch.from_arrays([same("__host"), same("__salt"), pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(number)], names=["h", "s", "a", "b", "stream"])

    # Windows that distinct streams of a host of several groups share. Per group first, so
    # that a window of all pages is one row per group.
    large = grouped.where(F.col("__n") > GROUP).select("__host", "__salt", "blocks")
    held = large.mapInArrow(windows, "h string, s bigint, a bigint, b bigint, stream bigint")
    held = settle(held.groupBy("h", "s", "a", "b").agg(F.min("stream").alias("lo"), F.max("stream").alias("hi")))
    shared = held.groupBy("h", "a", "b").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("groups"))
    shared = shared.where((F.col("lo") != F.col("hi")) & (F.col("groups") > 1)).select("h", "a", "b")
    known = held.join(shared, ["h", "a", "b"]).select("h", "s", "a", "b")

    def judge(pages: pd.DataFrame, hashes: pd.DataFrame) -> pd.DataFrame:
        elsewhere = set(zip(hashes["a"].tolist(), hashes["b"].tolist(), strict=True))
        texts = host_texts([[(b["kind"], b["text"]) for b in page] for page in pages["blocks"]], elsewhere)
        found = pd.DataFrame({"__id": pages["__id"], "__url": pages["__url"], "text": texts})
        return found[pages["wanted"].astype(bool)]

    sides = grouped.withColumn("h", F.col("__host")).withColumn("s", F.col("__salt")).groupBy("h", "s")
    judged = sides.cogroup(known.groupBy("h", "s")).applyInPandas(judge, f"{kinds}, text string")
    return done.unionByName(judged).select(F.col("__id").alias(id_col), F.col("__url").alias(url_col), "text")
