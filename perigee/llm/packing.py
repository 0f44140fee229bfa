"""Packing of documents into windows by minimum bin slack.

A document's whole windows are cut off first; what remains is a length below the window. All lengths are counted,
which is a table of at most one row per length whatever the corpus. On these counts windows are planned one kind after
the other: a window takes the largest length left and the multiset of other lengths whose sum is closest to what is
free, found by subset sums as bits and traced back to counts; the same multiset is then used as often as the counts
allow. Where the best sum leaves slack, one more remainder is cut there, and its rest is a length like the others. So
only the very last window has padding.

A remainder is found in the plan by its length and its rank among those of its length. Ranks are counted inside parts
of the written token table and shifted by the counts of the parts before, so that no length, however common, is
ordered or gathered in one task.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perigee.llm.bytebpe import byte_bpe
from perigee.llm.common import ROWS_AT_ONCE, map_rows, table, tokenizer_path, written

#: Tokens of a window, id at the end of each document.
WINDOW, END_ID = 1024, 0
#: Numbers of sequences below this belong to planned windows; whole windows of part p begin at (p + 1) times it.
PART_STEP = 1 << 40


def closest(left: Sequence[int], room: int) -> dict[int, int]:
    """Copies of each length, of left[length] there are, whose sum is as close below room as any.

    Bit s of reach says that the lengths looked at so far can sum to s. A length's copies enter in groups of 1, 2, 4
    and so on; what reach was before each group leads back from the best sum to the counts. Groups that entered late
    are used only where the sum needs them, so long remainders go first.
    """
    reach, trail, mask = 1, [], (2 << room) - 1
    for length in range(min(room, len(left) - 1), 0, -1):
        n, group = min(left[length], room // length), 1
        while n > 0:
            copies = min(group, n)
            trail.append((reach, length, copies))
            reach |= (reach << length * copies) & mask
            n, group = n - copies, group * 2
        if reach >> room & 1:
            break
    best, take = reach.bit_length() - 1, {}
    for before, length, copies in reversed(trail):
        if not before >> best & 1:
            take[length] = take.get(length, 0) + copies
            best -= length * copies
    return take


@dataclass(frozen=True)
class Plan:
    """Where remainders go: rows sorted by length and first rank.

    From a row's first rank on, `copies` remainders of its length share a window: number `sequence` and up, at `offset`
    and up. Of each, `placed` tokens lie there; where that is less than the length, the rest is a remainder with rank
    `rest` and up of its own length.
    """

    shift: int
    key: np.ndarray
    rows: np.ndarray
    windows: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Pieces of remainders in rounds: which remainder, tokens, sequence, offset."""
        which = np.flatnonzero(length)
        length, rank = length[which], rank[which]
        while len(which):
            at = np.searchsorted(self.key, (length << self.shift) + rank, "right") - 1
            first, copies, sequence, offset, placed, rest = self.rows[at].T
            window, slot = np.divmod(rank - first, copies)
            yield which, placed, sequence + window, offset + slot * placed
            go = placed < length
            which, length, rank = which[go], (length - placed)[go], (rest + rank - first)[go]


def fill(counts: Sequence[int], window: int = WINDOW) -> Plan:
    """Plan of all remainders, counts[length] of each length below window."""
    left = [0] * (window + 1)
    for length, n in enumerate(counts):
        left[length] = int(n) if length else 0
    first = [0] * (window + 1)
    steps, sequence, top = [], 0, window
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            break
        left[top] -= 1
        take = closest(left, window - top)
        left[top] += 1
        take[top] = take.get(top, 0) + 1
        slack = window - sum(length * n for length, n in take.items())
        cut = next((x for x in range(top, slack, -1) if left[x] > take.get(x, 0)), 0) if slack else 0
        times = min(left[x] // (take.get(x, 0) + (x == cut)) for x in {*take, *([cut] if cut else [])})
        offset = 0
        for length, n in sorted(take.items(), reverse=True):
            steps.append((length, first[length], n, sequence, offset, length, 0))
            first[length] += n * times
            left[length] -= n * times
            offset += length * n
        if cut:
            rest = cut - slack
            steps.append((cut, first[cut], 1, sequence, offset, slack, first[rest] + left[rest]))
            first[cut] += times
            left[cut] -= times
            left[rest] += times
        sequence += times
    rows = np.array(sorted(steps), np.int64).reshape(-1, 7)
    shift = 62 - window.bit_length()
    return Plan(shift, (rows[:, 0] << shift) + rows[:, 1], rows[:, 1:], sequence)


def _tokens(docs: DataFrame, path: str, window: int, end: int, text: str, key: str) -> DataFrame:
    """Ids of each document (little-endian unsigned 16-bit where they fit, else 32-bit), and its place among those of its part."""

    def task():
        bpe, part = byte_bpe(path), TaskContext.get().partitionId()
        ranks, whole = [0] * window, 0

        def work(columns):
            nonlocal whole
            out: dict[str, list] = {"key": columns[0], "part": [part] * len(columns[0]), "size": [], "tail": [], "rank": [], "whole": [], "ids": []}
            for t in columns[1]:
                ids = bpe.ids(t or "")
                ids.append(end)
                n, tail = divmod(len(ids), window)
                out["ids"].append(array("H" if max(ids) < 1 << 16 else "I", ids).tobytes())
                out["size"].append(len(ids))
                out["tail"].append(tail)
                out["rank"].append(ranks[tail])
                out["whole"].append(whole)
                ranks[tail] += 1
                whole += n
            return out

        return work

    kind = docs.schema[key].dataType.simpleString()
    return map_rows(docs.select(key, text), task, f"key {kind}, part long, size long, tail int, rank long, whole long, ids binary")


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END_ID, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pieces of documents in sequences of at most window tokens.

    Columns: key, start and length (tokens of the document), ids (binary, little-endian unsigned 32-bit), doc_tokens,
    sequence_id and offset (place there, gapless from 0). Each document's ids end with `end`; null and empty texts
    have that id only. Special strings inside texts count as the library does by default. Repeated rows and null keys
    are documents of their own; other columns are left out; no documents give no pieces. The token table is written
    once to the shared folder; which documents share a sequence follows from its parts, padding does not.
    """
    tokens = written(_tokens(docs, path, window, end, text, key), "tokens")
    counts = tokens.groupBy("part", "tail").agg(F.count("*").alias("n"))
    histogram = [0] * window
    for tail, n in tokens.groupBy("tail").count().collect():  # at most one row per length
        histogram[tail] = n
    plan = fill(histogram, window)
    before = W.partitionBy("tail").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select("part", "tail", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, ROWS_AT_ONCE):
                batch = whole_batch.slice(at, ROWS_AT_ONCE)
                part, size, tail, rank, whole = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(1, 6))
                ids = [np.frombuffer(x, f"<u{len(x) // n}").astype("<u4") for x, n in zip(batch.column(6).to_pylist(), size.tolist(), strict=True)]
                n = size // window
                row = np.repeat(np.arange(len(n)), n)
                i = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                found = [(row, i * window, np.full(len(row), window), (part[row] + 1) * PART_STEP + whole[row] + i, np.zeros(len(row), np.int64))]
                start = n * window
                for which, placed, sequence, offset in plan.place(tail, rank):
                    found.append((which, start[which], placed, sequence, offset))
                    start[which] += placed
                row, start, placed, sequence, offset = map(np.concatenate, zip(*found, strict=True))
                cut = [ids[r][s : s + k].tobytes() for r, s, k in zip(row.tolist(), start.tolist(), placed.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(placed), pa.array(cut, pa.binary()), pa.array(size[row]),
                     pa.array(sequence), pa.array(offset)],
                    names=[key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    placed = tokens.join(base, ["part", "tail"]).select("key", "part", "size", "tail", (F.col("rank") + F.col("base")).alias("rank"), "whole", "ids")
    return placed.mapInArrow(run, schema)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of all documents in windows of 1024 tokens, with the checksum of its ids."""
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
