"""Problem 7: passages of evaluation items in documents, by greedy string tiling.

The words of the evaluation items are numbered.  Runs of ``least`` words of an item, hashed by a running Karp-Rabin
hash, are the seeds; they are kept as sorted arrays (hash, item, place).  A document's words become those numbers (0 for
words of no item), all its windows are hashed at once, and those that are seeds lead to the items.  For each (document,
item) met, the seeds that no equal word precedes begin the maximal matches, whose lengths are found by bisection over
prefix hashes.  The longest match that overlaps no tile yet is marked as a tile again and again until none of ``least``
words is left; the share of the item's words that the tiles cover shows reordered passages too.

Defined results: null and blank texts give nothing; of rows with equal ids those that hold a passage are put together (the
best coverage is kept); an item shorter than ``least`` words can't be found.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiosko.llm.consistent import consistent

LEAST = 12
#: Shorter runs, and the share of an item's words that they must cover, by which reordered passages are found.
LEAST_TILE, COVERAGE = 5, 0.5
#: Items are broadcast in blocks of so many characters; tasks hold one block at a time.  A block has at most half as many
#: words, of 24 bytes each in its arrays (hash, item, place, word), and its vocabulary: 32 MB for usual text, 300 MB at most.
BLOCK_CHARS = 4 << 20
#: Characters of documents that are searched at a time, in one block and, where there are several, in each.
BATCH, BATCH_OF_BLOCKS = 4 << 20, 32 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
_run = re.compile(r"[^\W_]+")


def plain_words(text: str) -> list[str]:
    """The words of a text in consistent form: runs of letters and digits, lower case, without accents."""
    text = text.lower()
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))
    return _run.findall(text)


def _hashes(ids: np.ndarray, least: int) -> np.ndarray:
    """The Karp-Rabin hash of each window: hash(i + 1) = (hash(i) - ids[i] * BASE**(least - 1)) * BASE + ids[i + least].

    That recurrence is unrolled into one Horner step for all windows at a time, modulo 2**64.
    """
    n = len(ids) - least + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(least):
        h = h * BASE + ids[j : j + n].astype(np.uint64)
    return h


class Index:
    """A block of items: numbered words, the items' words one after another, and the seeds, sorted by hash."""

    def __init__(self, items: list[tuple], least: int = LEAST):
        self.least = least
        self.number: dict[str, int] = {}
        self.ids = [i for i, _ in items]
        items_words, hashes, item, place = [], [], [], []
        for k, (_, text) in enumerate(items):
            words = plain_words(consistent(text, True) or "")
            x = np.array([self.number.setdefault(w, len(self.number) + 1) for w in words], np.int32)
            items_words.append(x)
            h = _hashes(x, least)
            hashes.append(h)
            item.append(np.full(len(h), k, np.int32))
            place.append(np.arange(len(h), dtype=np.int32))
        self.seeds = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        order = np.argsort(self.seeds, kind="stable")
        self.seeds = self.seeds[order]
        self.item, self.place = (np.concatenate([*x, np.zeros(0, np.int32)])[order] for x in (item, place))
        self.flat = np.concatenate([*items_words, np.zeros(1, np.int32)])
        self.start = np.cumsum([0, *map(len, items_words)])
        before = self.flat[np.maximum(self.start[self.item] + self.place - 1, 0)]
        #: The word before each seed in its item, -2 where there is none.
        self.before = np.where(self.place > 0, before, -2).astype(np.int32)


class Chunks(dict):
    """Chunk of text without blanks -> number; the numbers of a chunk's words are found once."""

    def __init__(self, number: dict[str, int]):
        super().__init__()
        self.number = number
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.flat, self.start = array("q"), array("q", [0])

    def __missing__(self, chunk: str) -> int:
        self.flat.extend(self.number.get(w, 0) for w in plain_words(chunk))
        self[chunk] = n = len(self.start) - 1
        self.start.append(len(self.flat))
        return n


def encode(texts: list[str], chunks: Chunks) -> tuple[np.ndarray, np.ndarray]:
    """(the numbers of all words, 0 after each text; the place after each text)."""
    if len(chunks) > 1 << 19:
        chunks.reset()
    mark = "\0"  # its chunk stands for the end of a text
    if mark not in chunks:
        chunks.flat.append(0)
        chunks[mark] = len(chunks.start) - 1
        chunks.start.append(len(chunks.flat))
    split = " ".join(x.replace(mark, " ") + " " + mark for x in texts).replace("\n", " ").split(" ")
    ids = np.fromiter(map(chunks.__getitem__, split), np.int64, len(split))
    start = np.array(chunks.start)
    n = np.diff(start)[ids]
    before = np.cumsum(n) - n
    at = np.repeat(start[ids] - before, n) + np.arange(int(n.sum()))
    return np.array(chunks.flat)[at], before[ids == chunks[mark]] + 1


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE, np.uint64)]))


def _prefixes(ids: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Karp-Rabin hashes of all prefixes; the hash of a run, times a power of BASE by its place, is a difference."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids.astype(np.uint64) * power[: len(ids)])])


def lengths(doc: np.ndarray, items: np.ndarray, p: np.ndarray, q: np.ndarray, most: np.ndarray, least: int) -> np.ndarray:
    """How many words, ``least`` to ``most``, follow one another alike from each place in doc and place in items, by
    bisection over hashes: those of both sides are brought to one place before they are compared."""
    power = _powers(max(len(doc), len(items)))
    a, b = _prefixes(doc, power), _prefixes(items, power)
    lo, hi = np.full(len(p), least, np.int64), most.astype(np.int64)
    while (lo < hi).any():
        n = (lo + hi + 1) // 2
        same = (a[p + n] - a[p]) * power[q] == (b[q + n] - b[q]) * power[p]
        lo, hi = np.where(same, n, lo), np.where(same, hi, n - 1)
    return lo


def _longest_free(used: np.ndarray) -> int:
    edges = np.flatnonzero(np.concatenate([[True], used, [True]]))
    return int(np.diff(edges).max()) - 1


def tiles(doc: np.ndarray, item: np.ndarray, p: np.ndarray, q: np.ndarray, n: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from the maximal matches (place in doc, in item, length): tiles as (place in doc, in item,
    length), the longest first, no two with a word of the doc or of the item in common."""
    heap = list(zip((-n).tolist(), p.tolist(), q.tolist(), strict=True))
    heapq.heapify(heap)
    used_doc, used_item = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    out = []
    while heap:
        n, p, q = heapq.heappop(heap)
        used = used_doc[p : p - n] | used_item[q : q - n]
        if not used.any():
            if np.array_equal(doc[p : p - n], item[q : q - n]):  # a hash may lie
                out.append((p, q, -n))
                used_doc[p : p - n] = True
                used_item[q : q - n] = True
                if _longest_free(used_item) < least:
                    break
            continue
        if _longest_free(used) >= least:  # what a longer tile left of the match comes up again
            edges = np.flatnonzero(np.concatenate([[True], used, [True]]))
            for first, k in zip(edges[:-1].tolist(), (np.diff(edges) - 1).tolist(), strict=True):
                if k >= least:
                    heapq.heappush(heap, (-k, p + first, q + first))
    return out


#: Pairs of places that are expanded at a time.
PAIRS = 1 << 20


def _met(index: Index, ids: np.ndarray, ends: np.ndarray, whole: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, item, place in the text, place in the item) of all seeds met that may begin a maximal match.

    A hot seed, one that many items or places hold, is expanded in slices, and only pairs that no equal word precedes are
    kept; so a phrase that a text and an item repeat in one run gives as many as its ends, not as its pairs.
    """
    left, right = np.searchsorted(index.seeds, h, side="left"), np.searchsorted(index.seeds, h, side="right")
    hit = np.flatnonzero(right > left)
    at, left, n = whole[hit], left[hit], (right - left)[hit]
    starts = np.concatenate([[0], ends])
    text = np.searchsorted(ends, at, side="right")
    before = np.where(at > starts[text], ids[np.maximum(at - 1, 0)], -1)  # -1: no word precedes
    word = index.before
    total = np.cumsum(n)
    out = []
    i = 0
    while i < len(at):
        to = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PAIRS, side="right")))
        k = n[i:to]
        rep = np.repeat(np.arange(i, to), k)
        seed = left[rep] + np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        keep = (before[rep] != word[seed]) | (before[rep] <= 0)
        rep, seed = rep[keep], seed[keep]
        out.append((text[rep], index.item[seed].astype(np.int64), at[rep], index.place[seed].astype(np.int64)))
        i = to
    return tuple(np.concatenate([o[j] for o in out]) if out else np.zeros(0, np.int64) for j in range(4))


def found(texts: list[str], index: Index, chunks: Chunks) -> Iterator[tuple[int, int, float, int, int]]:
    """(number of the text, of the item, share of the item's words covered, longest tile, number of tiles)."""
    least = index.least
    ids, ends = encode([consistent(x, True) for x in texts], chunks)
    if len(ids) < least or not len(index.seeds):
        return
    gaps = np.cumsum(ids == 0)
    whole = np.flatnonzero(gaps[least - 1 :] - np.concatenate([[0], gaps[:-least]]) == 0)  # windows of item words only
    h = np.zeros(len(whole), np.uint64)
    for j in range(least):
        h = h * BASE + ids[whole + j].astype(np.uint64)
    doc, item, p, q = _met(index, ids, ends, whole, h)
    flat = index.start[item] + q
    same = np.ones(len(p), bool)  # a hash may lie
    for j in range(least):
        same &= ids[p + j] == index.flat[flat + j]
    doc, item, p, q, flat = doc[same], item[same], p[same], q[same], flat[same]
    if not len(doc):
        return
    n = lengths(ids, index.flat, p, flat, np.minimum(ends[doc] - 1 - p, index.start[item + 1] - flat), least)
    order = np.lexsort((item, doc))
    doc, item, p, q, n = doc[order], item[order], p[order], q[order], n[order]
    edges = np.flatnonzero((np.diff(doc) != 0) | (np.diff(item) != 0)) + 1
    for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(doc)], strict=True):
        d, k = int(doc[i]), int(item[i])
        first = int(ends[d - 1]) if d else 0
        words = index.flat[index.start[k] : index.start[k + 1]]
        if marked := tiles(ids[first : ends[d]], words, p[i:j] - first, q[i:j], n[i:j], least):
            sizes = [x for _, _, x in marked]
            yield d, k, sum(sizes) / len(words), max(sizes), len(sizes)


def _parts(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Slices of texts of about ``most`` characters."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= most):
            size += len(texts[last])
            last += 1
        yield first, last
        first = last


def _gathered(frames: Iterator[pd.DataFrame], most: int) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of about ``most`` characters."""
    ids, texts, size = [], [], 0
    for f in frames:
        for i, x in zip(f["doc_id"].tolist(), f["text"].fillna("").tolist(), strict=True):
            if texts and size + len(x) > most:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(x)
            size += len(x)
    if texts:
        yield ids, texts


def leaks(
    documents: DataFrame, items: DataFrame, least: int = LEAST, coverage: float = 0.0, longest: int = LEAST, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """(doc_id, item_id, cobertura, mayor, teselas): each document with each item of which it holds a passage: tiles of
    ``least`` words or more that cover at least ``coverage`` of the item's words, or one of ``longest`` words.

    The documents are scanned once; each task meets one block of items after another.
    """
    spark = documents.sparkSession
    stated = items.select("item_id", "text").where("item_id is not null and text is not null").distinct()
    size = stated.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_chars))
    held = []
    for b in range(blocks):
        block = stated if blocks == 1 else stated.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        held.append(spark.sparkContext.broadcast(Index([tuple(r) for r in block.collect()], least)))
    kinds = [f.schema[c].dataType.simpleString() for f, c in ((documents, "doc_id"), (items, "item_id"))]

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunks = Chunks(held[0].value.number) if len(held) == 1 else None
        for ids, texts in _gathered(frames, BATCH if len(held) == 1 else BATCH_OF_BLOCKS):
            rows = []
            for shared in held:
                index = shared.value
                own = Chunks(index.number) if chunks is None else chunks
                for first, last in _parts(texts, BATCH):
                    met = found(texts[first:last], index, own)
                    rows += [(ids[first + d], index.ids[k], c, most, n) for d, k, c, most, n in met if c >= coverage or most >= longest]
                if len(held) > 1:
                    shared.__dict__.pop("_value", None)  # one block at a time; it is read again from the worker's disk
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "cobertura", "mayor", "teselas"])

    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, cobertura double, mayor int, teselas int"
    return (
        documents.select("doc_id", "text")
        .where("doc_id is not null")
        .mapInPandas(search, schema)
        .groupBy("doc_id", "item_id")
        .agg(F.max("cobertura").alias("cobertura"), F.max("mayor").alias("mayor"), F.max("teselas").alias("teselas"))
    )


def leaked_documents(documents: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(documents, items).select("doc_id", "item_id")
