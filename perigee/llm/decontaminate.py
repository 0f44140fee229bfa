"""Benchmark decontamination: item-sized windows, SimHash, multi-index Hamming blocks, exact check.

Every document's five-word shingles are looked up among the items' shingles; a window without any item shingle has
similarity 0 to all items, so only windows that hold one are fingerprinted. For each such window of an item's own
length the SimHash of its shingles is compared through a multi-index: the fingerprint is cut into blocks, and two
fingerprints within the radius must differ by at most one bit in some block, so a table per block that holds each
item under all keys one bit away finds every item within the radius. Those are checked exactly: weighted Jaccard
similarity of the two shingle multisets.

Items are taken in blocks of bounded size, each held against all documents; documents are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import map_rows, table

SHINGLE, LEAST = 5, 0.75
#: Radius of the fingerprints: at the least similarity about 11 of 64 bits differ, with a deviation of 3.
BITS, RADIUS = 64, 21
BLOCKS = (RADIUS + 2) // 2
#: Benchmark items and their characters of one pass over the documents, and windows handled at a time.
ITEMS_AT_ONCE, CHARS_AT_ONCE, WINDOWS_AT_ONCE = 5000, 20_000_000, 1024
_WORD = re.compile(r"\w+")
_P = np.uint64(0x9E3779B97F4A7C15)
_WORDS_REMEMBERED = 300_000


class _WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > _WORDS_REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _shingles(text: str | None, words: _WordHash) -> np.ndarray:
    """Fingerprints of the five-word shingles in order; none for fewer words."""
    found = _WORD.findall((text or "").lower())
    n = len(found) - SHINGLE + 1
    if n < 1:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    total = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        total = total * _P + h[i : i + n]
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def _signs(s: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """The signs of shingles; each further occurrence of one in a window counts as a shingle of its own."""
    h = s + occurrence.astype(np.uint64) * _P
    again = occurrence > 0
    h[again] = (h[again] ^ (h[again] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    h[again] ^= h[again] >> np.uint64(30)
    return ((h[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.int32) * 2 - 1


def _simhash(s: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of `size` shingles at these (sorted) starts, over shingles numbered inside each window.

    So equal bits follow the weighted similarity. A window that moves by one shingle loses the last occurrence of the
    shingle it leaves and gains the next one of the shingle it takes in.
    """
    low, high = int(starts[0]), int(starts[-1]) + size
    part = s[low:high]
    n, steps = len(part), len(part) - size
    value = np.unique(part, return_inverse=True)[1].astype(np.int64)
    places = np.sort(value * (n + 1) + np.arange(n))

    def count(v: np.ndarray, first: np.ndarray | int, end: np.ndarray) -> np.ndarray:
        return np.searchsorted(places, v * (n + 1) + end) - np.searchsorted(places, v * (n + 1) + first)

    at = np.arange(steps)
    sums = np.empty((steps + 1, BITS), np.int32)
    sums[0] = _signs(part[:size], count(value[:size], 0, np.arange(size))).sum(axis=0)
    sums[1:] = _signs(part[size:], count(value[size:], at + 1, at + size))
    sums[1:] -= _signs(part[:steps], count(value[:steps], at, at + size) - 1)
    ones = np.cumsum(sums, axis=0, dtype=np.int32)[starts - low] > 0
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64)[:, 0]


class _Length:
    """Items of one length (in shingles) with their multi-index."""

    def __init__(self, size: int, items: list[tuple[int, np.ndarray]]):
        self.size, self.ids = size, [i for i, _ in items]
        self.counts = [np.unique(s, return_counts=True) for _, s in items]
        self.prints = np.concatenate([_simhash(s, np.array([0]), size) for _, s in items])
        cuts = np.linspace(0, BITS, BLOCKS + 1).astype(int)
        self.cuts = list(zip(cuts[:-1].tolist(), np.diff(cuts).tolist(), strict=True))
        self.tables = []
        for at, width in self.cuts:
            keys = self._keys(self.prints, at, width)
            under = np.zeros((1 << width, len(items)), bool)
            for flip in [0, *(1 << b for b in range(width))]:
                under[keys ^ flip, np.arange(len(items))] = True
            self.tables.append(under)

    @staticmethod
    def _keys(prints: np.ndarray, at: int, width: int) -> np.ndarray:
        return ((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items within the radius."""
        candidates = np.zeros((len(prints), len(self.ids)), bool)
        for (at, width), under in zip(self.cuts, self.tables, strict=True):
            candidates |= under[self._keys(prints, at, width)]
        window, item = np.nonzero(candidates)
        close = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[close], item[close]

    def similarity(self, window: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of two shingle multisets."""
        values, counts = np.unique(window, return_counts=True)
        own, weights = self.counts[item]
        at = np.minimum(np.searchsorted(own, values), len(own) - 1)
        both = int(np.minimum(counts, np.where(own[at] == values, weights[at], 0)).sum())
        return both / (len(window) + int(weights.sum()) - both)


class BenchmarkIndex:
    """All items of a bounded block. Items of fewer than five words have no shingle and match nothing."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.words = _WordHash()
        by_size: dict[int, list] = {}
        for number, (_, text) in enumerate(items):
            s = _shingles(text, self.words)
            if len(s):
                by_size.setdefault(len(s), []).append((number, s))
        self.items = items
        self.lengths = [_Length(size, group) for size, group in sorted(by_size.items())]
        pairs = [(x, k) for k, length in enumerate(self.lengths) for values, _ in length.counts for x in values.tolist()]
        self.known = np.unique(np.array([x for x, _ in pairs], np.uint64))
        self.maybe = np.zeros(1 << 22, bool)  # a coarse first look
        self.maybe[(self.known >> np.uint64(42)).astype(np.int64)] = True
        self.in_length = np.zeros((len(self.known), len(self.lengths)), bool)
        if pairs:
            self.in_length[np.searchsorted(self.known, np.array([x for x, _ in pairs], np.uint64)), [k for _, k in pairs]] = True

    def matches(self, text: str | None) -> dict[int, tuple[float, int, int]]:
        """Number of each item found in the text: best similarity, first word and number of words of its window."""
        best: dict[int, tuple[float, int, int]] = {}
        s = _shingles(text, self.words)
        places = np.flatnonzero(self.maybe[(s >> np.uint64(42)).astype(np.int64)])
        if not len(places):
            return best
        at = np.minimum(np.searchsorted(self.known, s[places]), len(self.known) - 1)
        hit = self.known[at] == s[places]
        places, at = places[hit], at[hit]
        for k in np.flatnonzero(self.in_length[at].any(axis=0)) if len(places) else []:
            length = self.lengths[k]
            size = min(length.size, len(s))
            mine = places[self.in_length[at, k]]
            covered = np.zeros(len(s) - size + 2, np.int32)
            np.add.at(covered, np.maximum(mine - size + 1, 0), 1)
            np.add.at(covered, np.minimum(mine, len(s) - size) + 1, -1)
            starts = np.flatnonzero(np.cumsum(covered)[:-1] > 0)
            for first in range(0, len(starts), WINDOWS_AT_ONCE):
                some = starts[first : first + WINDOWS_AT_ONCE]
                for run in np.split(some, np.flatnonzero(np.diff(some) > size) + 1):
                    for window, item in zip(*length.near(_simhash(s, run, size)), strict=True):
                        start = int(run[window])
                        similarity = length.similarity(s[start : start + size], item)
                        number = length.ids[item]
                        if similarity >= LEAST and similarity > best.get(number, (0.0,))[0]:
                            best[number] = (similarity, start, size + SHINGLE - 1)
        return best


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """The different items in blocks of about ITEMS_AT_ONCE and CHARS_AT_ONCE, dealt by a hash of their rows."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.char_length("text")), F.lit(0)).alias("chars")).first()
    parts = max(1, -(-size["n"] // ITEMS_AT_ONCE), -(-size["chars"] // CHARS_AT_ONCE))
    for part in range(parts):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield [(r["item_id"], r["text"]) for r in block.collect()]  # bounded by the block


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and item found in it: doc_id, item_id, similarity, first_word, n_words.

    Windows have as many words as the item (or the whole text if that is shorter). Null and empty texts hold
    nothing; an empty benchmark gives no rows; repeated rows are each reported; of items with one id the best counts.
    """

    def one(items: list[tuple[int, str | None]]) -> DataFrame:
        def task():
            index = BenchmarkIndex(items)

            def work(columns):
                out: dict[str, list] = {k: [] for k in ("doc_id", "item_id", "similarity", "first_word", "n_words")}
                for doc, text in zip(*columns, strict=True):
                    best: dict[int, tuple] = {}
                    for number, found in index.matches(text).items():
                        key = items[number][0]
                        best[key] = max(best.get(key, found), found)
                    for key, (similarity, first, size) in sorted(best.items(), key=lambda x: (x[0] is None, x[0])):
                        for name, value in zip(out, (doc, key, similarity, first, size), strict=True):
                            out[name].append(value)
                return out

            return work

        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return map_rows(rows, task, "doc_id long, item_id long, similarity double, first_word long, n_words long")

    result = None
    for items in _blocks(benchmark):
        found = one(items)
        result = found if result is None else result.union(found)
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of docs, all columns, in whose text no item is found; a filter inside the scan, block after block."""
    for items in _blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = BenchmarkIndex(items)
            for batch in batches:
                place = batch.schema.get_field_index("text")
                clean = []
                for at in range(0, batch.num_rows, 256):
                    clean += [not index.matches(t) for t in batch.column(place).slice(at, 256).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
