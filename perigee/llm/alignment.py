"""Alignment of two tokenizers' tokens, scored over the corpus with inverted pair bitmaps.

Every text is encoded by both tokenizers. Places where tokens of both end cut them into groups; a token of one and a
token of the other are linked where their bytes overlap. Documents are numbered inside chunks of bounded size. For
each pair of ids a chunk has a compressed bitmap of the documents that hold it linked (places as 16-bit numbers while
they are few, a plain bitmap beyond) and, for the links beyond a document's first, multiplicity planes: bitmap p holds
the documents in whose number of further links bit p is set. Chunks hold different documents, so the OR of a pair's
bitmaps is their concatenation and its popcount the sum of theirs: the corpus-wide count. The same bitmaps are the
postings over which counts go back to documents, chunk by chunk. Links are never listed as rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.bytebpe import byte_bpe
from perigee.llm.common import table, tokenizer_path, written

#: Documents of a chunk at most (places fit 16 bits), and postings after which a chunk ends early.
CHUNK, POSTINGS = 8192, 2_000_000
#: Texts encoded at a time.
TEXTS = 64


class PieceModel:
    """Encoder of a sentencepiece file, with the bytes of each piece."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = [self._bytes(i) for i in range(self.model.get_piece_size())]
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def batch(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


class Aligner:
    """Groups and links of texts between a byte-level BPE (A, given space and text) and a piece model (B, adds space)."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_bpe(path_a, literal=True), PieceModel(path_b)
        a, b = range(len(self.a.bytes_of)), range(len(self.b.bytes_of))
        # a token's text inside its group and at its group's end, for A and for B
        self.written = [*(f"{i}," for i in a), *(f"{i}|" for i in a), *(f"{i}," for i in b), *(f"{i};" for i in b)]

    def align(self, text: str | None, pieces: list[int]) -> tuple[int, int, int, int, str, np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups, n_links, groups, linked pairs (A id << 32 | B id, sorted) and how often each is linked."""
        nothing = np.empty(0, np.int64)
        if not text:
            return 0, 0, 0, 0, "", nothing, nothing
        spaced = " " + text
        ids, whole = self.a.ids(spaced), spaced.encode()
        if b"".join(map(self.b.bytes_of.__getitem__, pieces)) != whole:  # A gives every text back
            return 0, 0, 0, 0, "", nothing, nothing
        a, b = np.array(ids, np.int64), np.array(pieces, np.int64)
        ends_a, ends_b = self.a.length[a].cumsum(), self.b.length[b].cumsum()
        last = ends_b.searchsorted(ends_a)  # B token in which an A token ends
        first = ends_b.searchsorted(ends_a - self.a.length[a], "right")  # B token in which it begins
        shut_a = ends_b[last] == ends_a
        shut_b = np.zeros(len(b), bool)
        shut_b[last[shut_a]] = True
        group_a, group_b = shut_a.cumsum() - shut_a, shut_b.cumsum() - shut_b
        n_groups = int(shut_a.sum())
        before_b = np.concatenate([[0], np.bincount(group_b, minlength=n_groups).cumsum()])
        until_a = np.bincount(group_a, minlength=n_groups).cumsum()
        code = np.empty(len(a) + len(b), np.int64)
        size_a, size_b = len(self.a.bytes_of), len(self.b.bytes_of)
        code[np.arange(len(a)) + before_b[group_a]] = a + shut_a * size_a
        code[np.arange(len(b)) + until_a[group_b]] = b + 2 * size_a + shut_b * size_b
        groups = "".join(map(self.written.__getitem__, code.tolist()))[:-1]
        links = last - first + 1
        n_links = int(links.sum())
        at = np.repeat(first - (links.cumsum() - links), links) + np.arange(n_links)
        pairs, times = np.unique(np.repeat(a, links) << 32 | b[at], return_counts=True)
        return len(a), len(b), n_groups, n_links, groups, pairs, times


@functools.lru_cache(1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of two files, once per Python worker."""
    return Aligner(path_a, path_b)


def _binaries(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of data (bytes) as an Arrow binary array, without a copy."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _plain(places: np.ndarray, chunk: int) -> np.ndarray:
    marks = np.zeros(chunk, np.uint8)
    marks[places] = 1
    return np.packbits(marks)


def compressed(places: np.ndarray, starts: np.ndarray, chunk: int = CHUNK) -> pa.Array:
    """Bitmaps of runs of places (ascending in each run; run i begins at starts[i]), each in its shorter form.

    A plain bitmap has chunk / 8 bytes, a list of places always fewer.
    """
    plain = chunk // 8
    ends = np.append(starts[1:], len(places))
    n = ends - starts
    dense = np.flatnonzero(2 * n >= plain)
    size = np.where(2 * n >= plain, plain, 2 * n)
    bounds = np.concatenate([[0], size.cumsum()])
    data = np.empty(bounds[-1], np.uint8)
    few = np.ones(len(places), bool)
    room = np.ones(bounds[-1], bool)
    for i in dense:
        few[starts[i] : ends[i]] = False
        room[bounds[i] : bounds[i + 1]] = False
        data[bounds[i] : bounds[i + 1]] = _plain(places[starts[i] : ends[i]], chunk)
    data[room] = places[few].astype("<u2").view(np.uint8)
    return _binaries(data, bounds)


def decoded(bitmaps: pa.Array, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Places of all bitmaps, and which bitmap each is from."""
    plain = chunk // 8
    bitmaps = bitmaps.cast(pa.binary())
    if not len(bitmaps):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bounds = np.frombuffer(bitmaps.buffers()[1], np.int32)[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1].astype(np.int64)
    data = np.frombuffer(bitmaps.buffers()[2] or b"", np.uint8)
    size = np.diff(bounds)
    few = np.repeat(size < plain, size)
    places = [data[bounds[0] : bounds[-1]][few].view("<u2").astype(np.int64)]
    source = [np.repeat(np.arange(len(size)), np.where(size < plain, size // 2, 0))]
    for i in np.flatnonzero(size >= plain):
        places.append(np.flatnonzero(np.unpackbits(data[bounds[i] : bounds[i + 1]])))
        source.append(np.full(len(places[-1]), i))
    return np.concatenate(places), np.concatenate(source)


def popcount(bitmap: Column, chunk: int = CHUNK) -> Column:
    return F.when(F.octet_length(bitmap) < chunk // 8, F.octet_length(bitmap) / 2).otherwise(F.bitmap_count(bitmap)).cast("long")


def _postings(pairs: list[np.ndarray], times: list[np.ndarray], size: int) -> dict:
    """Columns of one chunk's pairs: ids, the bitmap of their documents, multiplicity planes and their bitmaps."""
    place = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
    pair, more = np.concatenate(pairs), np.concatenate(times) - 1
    order = pair.argsort(kind="stable")
    pair, place, more = pair[order], place[order], more[order]
    new = np.append(True, pair[1:] != pair[:-1])
    starts, row = np.flatnonzero(new), new.cumsum() - 1
    at, plane, where = [], [], []
    for p in range(int(more.max()).bit_length()):
        hit = np.flatnonzero(more >> p & 1)
        at.append(row[hit])
        plane.append(np.full(len(hit), p))
        where.append(place[hit])
    if at:
        at, plane, where = (np.concatenate(x) for x in (at, plane, where))
        order = np.lexsort((where, plane, at))
        at, plane, where = at[order], plane[order], where[order]
        begin = np.append(True, (at[1:] != at[:-1]) | (plane[1:] != plane[:-1]))
        begin = np.flatnonzero(begin)
        extra, owner, planes = compressed(where, begin, size), at[begin], plane[begin]
    else:
        extra, owner, planes = pa.array([], pa.binary()), np.empty(0, np.int64), np.empty(0, np.int64)
    offsets = np.concatenate([[0], np.bincount(owner, minlength=len(starts)).cumsum()])
    lists = lambda values: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
    a, b = pair[starts] >> 32, pair[starts] & 0xFFFFFFFF
    return {"a": pa.array(a), "b": pa.array(b), "docs": compressed(place, starts, size), "planes": lists(pa.array(planes, pa.int32())), "extra": lists(extra)}


_FIELDS = pa.schema([
    ("chunk", pa.int64()), ("place", pa.int32()), ("key", pa.null()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("docs", pa.binary()),
    ("planes", pa.list_(pa.int32())), ("extra", pa.list_(pa.binary()))])
_SCHEMA = ("chunk long, place int, key {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
           "a long, b long, docs binary, planes array<int>, extra array<binary>")


def _indexed(docs: DataFrame, path_a: str, path_b: str, text: str, key: str, with_groups: bool, size: int, most: int) -> DataFrame:
    """Written table with a row per document (place is not null) and a row per chunk and pair (a is not null)."""
    from pyspark.sql.pandas.types import to_arrow_type

    key_type = to_arrow_type(docs.schema[key].dataType)
    fields = pa.schema([pa.field("key", key_type) if f.name == "key" else f for f in _FIELDS])

    def batch_of(n: int, columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in fields], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align_text, pieces_of, chunk = aligner(path_a, path_b).align, aligner(path_a, path_b).b.batch, TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        pairs: list[np.ndarray] = []
        times: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", *(["groups"] if with_groups else [])]
            made = {n: pa.array([r[i + 1] for r in rows], fields.field(n).type) for i, n in enumerate(names)}
            yield batch_of(len(rows), {"chunk": pa.array([chunk] * len(rows), pa.int64()), "place": pa.array(range(len(rows)), pa.int32()),
                                       "key": pa.array([r[0] for r in rows], key_type), **made})
            if held:
                found = _postings(pairs, times, size)
                n = len(found["a"])
                whole = batch_of(n, {"chunk": pa.array(np.full(n, chunk)), **found})
                for at in range(0, n, 20_000):
                    yield whole.slice(at, 20_000)

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for k, t, pieces in zip(part.column(0).to_pylist(), texts, pieces_of(texts), strict=True):
                    *counts, groups, pair, time = align_text(t, pieces)
                    rows.append((k, *counts, hashlib.sha256(groups.encode()).hexdigest() if counts[0] else "", groups))
                    if not with_groups:
                        rows[-1] = rows[-1][:-1]
                    pairs.append(pair)
                    times.append(time)
                    held += len(pair)
                    if len(rows) == size or held >= most:
                        yield from flush()
                        chunk, held = chunk + 1, 0
                        rows, pairs, times = [], [], []
        if rows:
            yield from flush()

    schema = _SCHEMA.format(docs.schema[key].dataType.simpleString())
    return written(docs.select(key, text).mapInArrow(run, schema), "alignment")


def _scores(postings: DataFrame, size: int) -> DataFrame:
    """chunk, place, n_best and count_sum of documents, from rows (chunk, docs, planes, extra, n, best)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[int, int] = {}
        total = np.zeros((2, 0), np.int64)
        for batch in batches:
            chunks, inverse = np.unique(batch.column("chunk").to_numpy(), return_inverse=True)
            mine = np.array([number.setdefault(c, len(number)) for c in chunks.tolist()], np.int64)
            if len(number) * size > total.shape[1]:
                total = np.pad(total, ((0, 0), (0, len(number) * size - total.shape[1])))
            base = mine[inverse] * size
            count, best = batch.column("n").to_numpy(), batch.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
            places, source = decoded(batch.column("docs"), size)
            np.add.at(total[0], base[source] + places, best[source])
            np.add.at(total[1], base[source] + places, count[source])
            planes = batch.column("planes").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(planes):
                owner = np.repeat(np.arange(batch.num_rows), np.asarray(batch.column("planes").value_lengths()))
                places, source = decoded(batch.column("extra").flatten(), size)
                at, weight = base[owner[source]] + places, np.int64(1) << planes[source]
                np.add.at(total[0], at, best[owner[source]] * weight)
                np.add.at(total[1], at, count[owner[source]] * weight)
        for chunk, i in number.items():
            sums = total[:, i * size : (i + 1) * size]
            hit = np.flatnonzero(sums[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), chunk)), pa.array(hit, pa.int32()), pa.array(sums[0][hit]), pa.array(sums[1][hit])],
                                             names=["chunk", "place", "n_best", "count_sum"])

    dealt = postings.select("chunk", "docs", "planes", "extra", "n", "best").repartition("chunk")
    return dealt.mapInArrow(run, "chunk long, place int, n_best long, count_sum long")


def align(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id", groups: bool = True, chunk: int = CHUNK, most: int = POSTINGS
) -> tuple[DataFrame, DataFrame]:
    """Documents and pairs of an alignment between tokenizer A (byte-level BPE) and B (piece model).

    Documents: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if asked for, groups
    (a1,a2|b1;a3|b2,b3). Pairs: a, b, n (documents that hold the pair linked), links. Null and empty texts, and texts
    that a tokenizer doesn't give back byte for byte, have zeros and empty strings. Repeated rows and null keys are
    documents of their own; other columns are left out. Tokenizer files are read by path in the tasks. A chunk has `chunk` documents
    (at most 65,536) or ends at `most` postings; results don't depend on either.
    """
    index = _indexed(docs, path_a, path_b, text, key, groups, chunk, most)
    postings = index.filter("a is not null").select("chunk", "a", "b", "docs", "planes", "extra")
    more = F.aggregate(F.arrays_zip("planes", "extra"), F.lit(0).cast("long"), lambda acc, x: acc + F.call_function("shiftleft", popcount(x["extra"], chunk), x["planes"]))
    pairs = written(postings.groupBy("a", "b").agg(F.sum(popcount(F.col("docs"), chunk)).alias("n"), F.sum(popcount(F.col("docs"), chunk) + more).alias("links")), "pairs")
    highest = pairs.groupBy("a").agg(F.max("n").alias("highest"))  # one row per id of vocabulary A
    judged = pairs.join(F.broadcast(highest), "a").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))
    scores = _scores(postings.join(judged.hint("merge"), ["a", "b"]), chunk)
    counted = ["n_a", "n_b", "n_groups", "n_links"]
    documents = index.filter("place is not null").select("chunk", "place", "key", *counted, "groups_sha256", *(["groups"] if groups else []))
    out = documents.join(scores, ["chunk", "place"], "left").select(
        F.col("key").alias(key), *counted, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups_sha256",
        *(["groups"] if groups else []))
    return out, pairs


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment digests and corpus-wide scores of every document."""
    return align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), groups=False)[0]
