"""MinHash near-duplicates with odd sketches, confirmed on full shingle sets.

1. Each text becomes its set of five-word shingles (64-bit fingerprints). Equal sets are one class from here on.
2. MinHash bands put classes into buckets. A bucket's members are first paired with its smallest member only.
3. A pair's odd sketch (parity bitmap of a coordinated MinHash sample of each set, whole sets when small) bounds its
   similarity: the population count of the XOR estimates the symmetric difference. Pairs below the bound minus
   4.5 standard deviations go, all others are confirmed exactly on the full sets.
4. Confirmed links are contracted to components. Buckets that still hold several components are compared in blocks
   of bounded size, sketch against sketch: first a forest of the most similar pairs across components, then, of
   the components that are left, all pairs that pass. These are confirmed and contracted as well.

So links are complete for all pairs that share a bucket, and no group of any size is listed pair by pair.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import map_rows, packed, table
from perigee.session import stable

#: Words of a shingle, least similarity in percent.
SHINGLE, PERCENT = 5, 75
#: 32 bands of 4 MinHash values: a pair at the limit shares no bucket with a probability of 5e-6.
BANDS, BAND_ROWS = 32, 4
#: Bits of a sketch; sets above SAMPLE shingles are sampled by halving until the sample is below it.
SKETCH_BITS, SAMPLE, DEVIATIONS = 2048, 512, 4.5
#: Members of a bucket that are compared with each other in one block.
BLOCK = 512
#: Rows of a partition of tables with two numbers a row.
NARROW_ROWS = 100_000
_WORDS_REMEMBERED = 300_000

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = np.random.default_rng(20240229).integers(1, 2**63, (BANDS * BAND_ROWS, 2), np.uint64)
_MIX[:, 0] |= np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS_REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: _WordHash) -> np.ndarray:
    """Sorted distinct fingerprints of the five-word shingles; fewer words are one shingle, none give none."""
    found = (text or "").encode().translate(LOWER).split()
    if not found:
        return np.empty(0, np.uint64)
    if len(found) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b"\0" + b" ".join(found))], np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = len(h) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        total = total * _P + h[i : i + n]
    return np.unique(_mixed(total))


def bands(s: np.ndarray) -> np.ndarray:
    """Bucket keys: one per band, of BAND_ROWS MinHash values each."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 2048):  # bounded memory for very long texts
        least = np.minimum(least, ((s[None, at : at + 2048] ^ _MIX[:, 1:]) * _MIX[:, :1]).min(axis=1))
    key = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND_ROWS).T:
        key = _mixed(key * _P + column)
    return key.view(np.int64)


def _sketch(s: np.ndarray, level: int) -> tuple[int, np.ndarray]:
    """Size and parity bitmap of the sample at a level: fingerprints whose mixed value has `level` leading zero bits."""
    x = _mixed(s + _P)
    if level:
        x = x[(x >> np.uint64(64 - level)) == 0]
    odd = np.bincount((x & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return len(x), np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(s: np.ndarray) -> dict:
    """Sketch at the set's own level and, where a larger partner may need it, at the next."""
    level = max(0, math.ceil(math.log2(max(1, len(s)) / SAMPLE)))
    own = _sketch(s, level)
    near_edge = len(s) * 100 >= PERCENT * (SAMPLE << level) * 0.99
    nxt = _sketch(s, level + 1) if near_edge else (0, np.empty(0, np.int64))
    return {"level": level, "c0": own[0], "s0": own[1].tolist(), "c1": nxt[0], "s1": nxt[1].tolist()}


def _limit(size, sampled, sqrt, exp, least):
    """Largest population count for two samples of this total size at the least similarity."""
    most = size * ((100.0 - PERCENT) / (100.0 + PERCENT))
    count = (1.0 - exp(most * (-2.0 / SKETCH_BITS))) * (SKETCH_BITS / 2)
    spread = sqrt(most * most * (2.0 / SKETCH_BITS) + most * sampled * 2.0) + 1.0
    return least(count + spread * DEVIATIONS)


def _profiles(docs: DataFrame) -> DataFrame:
    def task():
        words = _WordHash()

        def work(columns):
            out = {"doc_id": columns[0], "n_shingles": [], "set_key": [], "bands": []}
            for text in columns[1]:
                s = shingles(text, words)
                out["n_shingles"].append(len(s))
                out["set_key"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                out["bands"].append(bands(s).tolist() if len(s) else None)
            return out

        return work

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), task,
                    "doc_id long, n_shingles long, set_key binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Full sets and sketches of the wanted classes (cid, set_key, low), from one of their documents."""

    def task():
        words = _WordHash()

        def work(columns):
            out: dict[str, list] = {"set_key": [], "shingles": []}
            for text in columns[0]:
                s = shingles(text, words)
                out["set_key"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                out["shingles"].append(s.view(np.int64).tolist())
                for k, v in sketches(s).items():
                    out.setdefault(k, []).append(v)
            return out

        return work

    low = wanted.select(F.col("low").alias("__low")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").join(low.hint("shuffle_hash"), F.col("__id").eqNullSafe(F.col("__low")), "left_semi")
    sets = map_rows(rows.select("text"), task, "set_key binary, shingles array<long>, level int, c0 int, s0 array<long>, c1 int, s1 array<long>")
    one = sets.groupBy("set_key").agg(*[F.first(c).alias(c) for c in ("shingles", "level", "c0", "s0", "c1", "s1")])
    return _with(wanted.select("cid", "set_key"), one, "set_key").drop("set_key")


def _side(info: DataFrame, name: str, *columns: str) -> DataFrame:
    return info.select(F.col("cid").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])


def _passing(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sketches allow the least similarity."""
    columns = ("level", "c0", "s0", "c1", "s1")
    df = _with(_with(pairs, _side(info, "a", *columns), "a"), _side(info, "b", *columns), "b")
    la, lb = F.col("a_level"), F.col("b_level")

    def at(side: str, other: Column, what: str) -> Column:
        return F.when(F.col(f"{side}_level") >= other, F.col(f"{side}_{what}0")).otherwise(F.col(f"{side}_{what}1"))

    bits = F.aggregate(F.zip_with(at("a", lb, "s"), at("b", la, "s"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    size = (at("a", lb, "c") + at("b", la, "c")).cast("double")
    sampled = F.when(F.greatest(la, lb) > 0, 1.0).otherwise(0.0)
    near = (F.abs(la - lb) <= 1) & (F.size(at("a", lb, "s")) == F.size(at("b", la, "s")))
    return df.filter(F.when(near, bits <= _limit(size, sampled, F.sqrt, F.exp, lambda x: x)).otherwise(False)).select("a", "b")


def _confirmed(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    df = _with(_with(pairs, _side(info, "a", "shingles"), "a"), _side(info, "b", "shingles"), "b")
    a, b = F.col("a_shingles"), F.col("b_shingles")
    both = F.size(F.array_intersect(a, b))
    return df.select("a", "b", both.alias("both"), (F.size(a) + F.size(b)).alias("sizes")).filter(
        F.col("both") * 100 >= PERCENT * (F.col("sizes") - F.col("both"))).select("a", "b")


def _with(df: DataFrame, other: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A sorted join. Tables of classes and links grow with the corpus, so none is broadcast, however small here."""
    return df.join(other.hint("merge"), on, how)


def _few(df: DataFrame, rows: int) -> DataFrame:
    """df in partitions for so many narrow rows: each file of a shuffle takes room, and small tables have many shuffles."""
    return df.coalesce(max(1, math.ceil(rows / NARROW_ROWS)))


def contract(edges: DataFrame) -> DataFrame:
    """Columns node and root (smallest node reachable) for all nodes of edges (a, b); tables only, nothing collected.

    Large and small stars in turn: first the larger neighbours of each node move to its smallest neighbour, then the
    smaller ones and the node itself, until no edge changes. One saved table a round.
    """
    first = e = stable(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    nodes = first.select(F.col("u").alias("node")).union(first.select("v")).distinct()
    before = None
    while True:
        e = e if e is first else stable(e)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before, e = now, _few(e, now[0])
        both = e.union(_few(e.select("v", "u"), now[0]))
        least = _few(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), 2 * now[0])
        large = _few(_with(both, least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), now[0])
        least = _few(large.groupBy("u").agg(F.min("v").alias("m")), now[0])
        small = _with(large, least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = _few(_few(small, now[0]).union(least).distinct(), now[0])
    return _with(nodes, e.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _merged(labels: DataFrame, links: DataFrame, rows: int) -> DataFrame:
    """labels (cid, root), so many rows, after the links (a, b) between classes."""
    a = _few(_with(links, labels.select(F.col("cid").alias("a"), F.col("root").alias("ra")), "a"), rows)
    roots = _few(_with(a, labels.select(F.col("cid").alias("b"), F.col("root").alias("rb")), "b"), rows)
    step = _few(contract(roots.select(F.col("ra").alias("a"), F.col("rb").alias("b"))), rows)
    moved = _with(labels, step.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
    return stable(_few(moved.select("cid", F.coalesce("next", "root").alias("root")), rows))


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    side = lambda n: labels.select(F.col("cid").alias(n), F.col("root").alias(f"r{n}"))
    return _with(_with(pairs, side("a"), "a"), side("b"), "b").filter("ra != rb").select("a", "b")


def _blocked_pairs(buckets: DataFrame, labels: DataFrame, info: DataFrame, bands: DataFrame, spanning: bool) -> DataFrame:
    """Pairs across components, inside buckets (bucket, cid) that hold several, whose sketches pass.

    The members of a bucket's largest component are cut into blocks, and every block meets the members outside it;
    those outside are cut into blocks as well and meet each other. So a bucket that is one component but for a few
    costs its size. With spanning, a class enters its largest such bucket only and each block emits just a forest
    over its components, the most similar pairs first. Else all pairs are looked at, each in the first bucket that it
    shares (half a bucket's key tells buckets of a band apart, wrongly for one pair in 10^8).
    """
    members = _with(buckets, labels, "cid")
    parts = members.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    opened = parts.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("k")).filter("k > 1 and n > 2")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    opened = opened.select("bucket", F.col("top.root").alias("top"), blocks(F.col("top.n")).alias("ins"), blocks(F.col("n") - F.col("top.n")).alias("outs"))
    if spanning:
        largest = _with(members, opened.select("bucket", (F.col("ins") + F.col("outs")).alias("size")), "bucket")
        members = _with(members, largest.groupBy("cid").agg(F.max_by("bucket", F.struct("size", "bucket")).alias("bucket")), ["cid", "bucket"])
    mine = _with(members, opened, "bucket").withColumn("inside", F.col("root") == F.col("top")).withColumn(
        "mine", F.pmod(F.xxhash64("cid"), F.when(F.col("inside"), F.col("ins")).otherwise(F.col("outs"))).cast("int"))
    # places (i, j, side): rows of one side meet those of the other, and each other where i = j
    place = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("mine"))
    all_of = lambda n, f: F.transform(F.sequence(F.lit(0), F.col(n) - 1), f)
    met = F.when(F.col("inside"), all_of("outs", lambda x: place(-F.col("mine") - 1, x, F.lit(0))))
    places = met.otherwise(F.concat(all_of("ins", lambda x: place(-x - 1, F.col("mine"), F.lit(1))),
                                    all_of("outs", lambda x: place(F.least("mine", x), F.greatest("mine", x), F.col("mine")))))
    dealt = mine.select("bucket", "cid", "root", F.explode(places).alias("p")).select("bucket", "p.i", "p.j", "p.mine", "cid", "root")
    rows = _with(_with(dealt, info.select("cid", "level", "c0", "s0", "c1", "s1"), "cid"), bands, "cid")

    def compare(block: list[tuple]) -> list[tuple[int, int]]:
        bucket, i, j = block[0][:3]
        side = np.array([r[3] for r in block])
        cid, root = np.array([r[4] for r in block]), np.array([r[5] for r in block])
        level = np.array([r[6] for r in block])
        keys = np.array([r[11] for r in block], np.int32)
        band = 0 if spanning else int(np.flatnonzero(keys[0] == bucket >> 32)[0])
        out: list[tuple[float, int, int]] = []
        for lv in range(level.min(), level.max() + 1):
            # partners at this level: own sketches of the level, next-level sketches of the level below
            own, below = np.flatnonzero(level == lv), [k for k in np.flatnonzero(level == lv - 1) if len(block[k][10])]
            use = np.concatenate([own, np.array(below, np.int64)])
            if not len(own) or len(use) < 2:
                continue
            bits = np.array([block[k][8] for k in own] + [block[k][10] for k in below], np.int64).view(np.uint64)
            size = np.array([block[k][7] for k in own] + [block[k][9] for k in below], np.float64)
            for x in range(len(own)):
                y = np.arange(x + 1, len(use))
                y = y[root[use[y]] != root[use[x]]]
                if i != j:
                    y = y[side[use[y]] != side[use[x]]]
                if not len(y):
                    continue
                share = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1) / _limit(size[y] + size[x], float(lv > 0), np.sqrt, np.exp, lambda v: v)
                y, share = y[share <= 1], share[share <= 1]
                first = (keys[use[y]][:, :band] != keys[use[x]][:band]).all(axis=1)
                out += [(float(d), int(use[x]), int(use[k])) for d, k in zip(share[first], y[first], strict=True)]
        if spanning:
            over: dict[int, int] = {}

            def top(r: int) -> int:
                while over.get(r, r) != r:
                    r = over[r]
                return r

            forest = []
            for d, x, y in sorted(out):
                rx, ry = top(int(root[x])), top(int(root[y]))
                if rx != ry:
                    over[max(rx, ry)] = min(rx, ry)
                    forest.append((d, x, y))
            out = forest
        return [(int(min(cid[x], cid[y])), int(max(cid[x], cid[y]))) for _, x, y in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    yield from zip(*[c.to_pylist() for c in batch.slice(at, 256).columns], strict=True)

        for _, block in itertools.groupby(stream(), key=lambda r: r[:3]):
            pairs = compare(list(block))
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], names=["a", "b"])

    ordered = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return ordered.select("bucket", "i", "j", "mine", "cid", "root", "level", "c0", "s0", "c1", "s1", "bands").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    Texts without words have no shingles and are linked with nothing. Rows that share a doc_id count as documents
    of that id each; a row is kept if its doc_id is its component's. Null ids are never smallest; a component
    without any id has none and its rows are all kept. Other columns are left out.
    """
    profiles = stable(_profiles(docs))
    own = profiles.filter("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("low"), F.first("bands").alias("bands")).withColumn("cid", F.monotonically_increasing_id())
    classes = stable(own)
    entries = classes.select("cid", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.min("cid").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    buckets = stable(_with(entries, shared, "bucket"))
    stars = stable(buckets.filter("cid != leader").groupBy(F.col("cid").alias("a"), F.col("leader").alias("b")).agg(F.count("*").alias("shared")))
    member = buckets.select("cid").distinct()
    wanted = _with(classes.select("cid", "set_key", "low"), member, "cid", "left_semi")
    info = stable(_sets(docs, wanted))
    best = stars.groupBy("a").agg(F.max_by("b", F.struct("shared", -F.col("b"))).alias("b"))
    n = info.count()
    labels = stable(_few(info.select("cid", F.col("cid").alias("root")), n))
    labels = _merged(labels, _few(stable(_confirmed(_passing(best, info), info)), n), n)
    labels = _merged(labels, _few(stable(_confirmed(_passing(_across(stars.select("a", "b"), labels), info), info)), n), n)
    keys = classes.select("cid", F.transform("bands", lambda k: F.shiftright(k, 32).cast("int")).alias("bands"))
    for spanning in (True, False):
        pairs = _blocked_pairs(buckets.select("bucket", "cid"), labels, info, keys, spanning)
        links = _few(stable(_confirmed(_across(pairs, labels), info)), n)
        labels = _merged(labels, links, n)

    lows = _with(labels, classes.select("cid", "low"), "cid")
    smallest = lows.groupBy("root").agg(F.min("low").alias("component"), F.count("*").alias("n")).filter("n > 1")
    merged = _with(lows, smallest.select("root", "component"), "root").select("cid", "component", F.lit(True).alias("linked"))
    of_class = _with(classes.select("cid", "set_key", "low"), merged, "cid", "left").select(
        "set_key", F.when(F.col("linked"), F.col("component")).otherwise(F.col("low")).alias("component"))
    out = _with(profiles.select("doc_id", "n_shingles", "set_key"), of_class, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("component_id").isNull() | F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of docs, all columns, that near_duplicates keeps."""
    kept = near_duplicates(docs.select("doc_id", "text")).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = packed(docs, F.col("doc_id").cast("long").alias("own_id"))
    return rows.join(kept.hint("shuffle_hash"), F.col("own_id").eqNullSafe(F.col("kept_id")), "left_semi").select("row.*")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))
