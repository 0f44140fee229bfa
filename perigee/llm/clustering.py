"""Exact centroid clustering over zone maps of vectors in Hilbert order.

Integer vectors are put in the order of a Hilbert curve through all their components (two bits each, cut at the mean
and at 0.67 deviations from it) and written as blocks with a box of least and largest components. In every round a
block first bounds its distance to each centroid by its box: a centroid whose least possible distance is above the
smallest largest-possible one can be nearest to none of the block's vectors. Only the others are compared, exactly, in
one vectorised step. A task returns sums and counts by centroid, so a round moves a few rows per task however many
vectors there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.llm.common import table, written
from perigee.session import stable

#: Components, centroids, rounds, steps of a component's unit.
COMPONENTS, CENTROIDS, ROUNDS, SCALE = 64, 40, 5, 256
#: Vectors of a block.
BLOCK = 128
#: Components beyond this have squared distances that no long holds.
LARGEST = 2**27
#: Up to here products and their sums are exact in double precision, which has a faster matrix product.
_EXACT = 2**22
ASSIGNED = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])


def hilbert_keys(cells: np.ndarray, bits: int = 2) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (rows x dimensions, values below 2 ** bits), as fixed bytes.

    The cells' bits are turned into the curve's transposed index by exchanging and inverting lower bits from the top
    level down, then Gray-decoded across dimensions; packed level by level they sort as the curve runs.
    """
    x = cells.astype(np.uint8).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = np.uint8(level - 1)
        for d in range(dims):
            high = (x[d] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & low).astype(np.uint8)
            x[0] ^= np.where(high, low, swap).astype(np.uint8)
            x[d] ^= swap
        level >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where((x[-1] & level) != 0, np.uint8(level - 1), np.uint8(0))
        level >>= 1
    x ^= turn
    planes = [(x >> b) & 1 for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T, axis=1)


def box_candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector inside the box."""
    below, above = low - centroids, centroids - high
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=1)
    most = (np.maximum(-below, -above) ** 2).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def nearest(vectors: np.ndarray, centroids: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest of the numbered centroids (the smaller number of equals) to each vector, and the squared distance."""
    c = centroids[numbers]
    if max(np.abs(vectors).max(), np.abs(c).max()) < _EXACT:
        product = (vectors.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
        square = (vectors * vectors).sum(axis=1)[:, None] - 2 * product + (c * c).sum(axis=1)
    else:
        square = np.stack([((vectors - one) ** 2).sum(axis=1) for one in c], axis=1)
    at = square.argmin(axis=1)
    return numbers[at], square[np.arange(len(at)), at]


def integer_vectors(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id and v (longs, floor(scale * x)) of the rows whose embedding has so many components, all finite.

    Rows with a component of LARGEST or more in absolute value are left out as well: their distances fit no long.
    """
    x = F.transform("embedding", lambda e: F.floor(e.cast("double") * scale))
    usable = (F.size("embedding") == components) & F.forall(
        "embedding", lambda e: F.coalesce(F.abs(e.cast("double")) < LARGEST // scale, F.lit(False)) & ~F.isnan(e))
    return rows.filter(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v"))


def first_centroids(vectors: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of prefix and vec_id; equal ids by components, null ids never."""
    named = vectors.filter("vec_id is not null").select(F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256).alias("h"), "v")
    return np.array([r["v"] for r in named.orderBy("h", "v").limit(k).collect()], np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), width)


def blocks_in_order(vectors: DataFrame, components: int, block: int = BLOCK) -> DataFrame:
    """Written table of blocks: ids, vectors (long arrays laid end to end) and the box, in Hilbert order.

    Equal vectors are dealt by row number, so that a very common one fills many blocks in many partitions.
    """
    spark = vectors.sparkSession
    d = components
    stats = vectors.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread")).orderBy("d").collect()  # one row per component
    mean, spread = (np.array([r[c] for r in stats], np.float64) for c in ("mean", "spread"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = (_matrix(batch.column("v"), d) - mean) / np.maximum(spread, 1e-9)
                cells = np.digitize(z, [-0.67, 0.0, 0.67])
                keys = pa.array([k.tobytes() for k in hilbert_keys(cells)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), keys], names=["vec_id", "v", "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                v = _matrix(part.column("v"), d)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())), pa.array([v.ravel()], pa.list_(pa.int64())),
                     pa.array([v.min(axis=0)], pa.list_(pa.int64())), pa.array([v.max(axis=0)], pa.list_(pa.int64()))],
                    names=["ids", "v", "low", "high"])

    numbered = written(vectors.mapInArrow(keyed, "vec_id long, v array<long>, place binary"), "vectors").withColumn("row", F.monotonically_increasing_id())
    ordered = numbered.repartitionByRange("place", F.xxhash64("row")).sortWithinPartitions("place")
    return written(ordered.select("vec_id", "v").mapInArrow(cut, "ids array<long>, v array<long>, low array<long>, high array<long>"), "blocks") if stats else (
        spark.createDataFrame([], "ids array<long>, v array<long>, low array<long>, high array<long>"))


def _compared(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Per block: ids, vectors, nearest centroids, distances, and how many centroids were compared."""
    d = centroids.shape[1]
    for ids, v, low, high in zip(*(batch.column(c) for c in ("ids", "v", "low", "high")), strict=True):
        vectors = np.asarray(v.values, np.int64).reshape(-1, d)
        numbers = box_candidates(np.asarray(low.values, np.int64), np.asarray(high.values, np.int64), centroids)
        cluster, distance = nearest(vectors, centroids, numbers)
        yield ids.values, vectors, cluster, distance, len(numbers)


def _round(blocks: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, float]:
    """Centroids after one round, and the share of centroids that boxes left to compare."""
    k, d = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of each centroid: components summed, vectors, comparisons made, comparisons without boxes
        total = np.zeros((k, d + 3), np.int64)
        for batch in batches:
            for _, vectors, cluster, _, compared in _compared(batch, centroids):
                np.add.at(total[:, :d], cluster, vectors)
                n = np.bincount(cluster, minlength=k)
                total[:, d] += n
                total[:, d + 1] += n * compared
                total[:, d + 2] += n * k
        hit = np.flatnonzero(total[:, d])
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(list(total[hit]), pa.list_(pa.int64()))], names=["cluster", "total"])

    parts = blocks.mapInArrow(sums, "cluster int, total array<long>").select("cluster", F.posexplode("total").alias("d", "x"))
    summed = np.zeros((k, d + 3), object)
    for number, i, x in parts.groupBy("cluster", "d").agg(F.sum(F.col("x").cast("decimal(38,0)"))).collect():  # k * (d + 3) rows at most
        summed[number, i] = int(x)
    moved = centroids.copy()
    for number in np.flatnonzero(summed[:, d]):
        moved[number] = summed[number, :d] // summed[number, d]
    return moved, float(summed[:, d + 1].sum() / max(1, summed[:, d + 2].sum()))


def cluster(
    rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE, prefix: str = "2:"
) -> tuple[DataFrame, np.ndarray]:
    """Per usable vector of rows (vec_id, embedding): vec_id, cluster and squared distance; and the final centroids.

    Unusable rows are those integer_vectors leaves out (null, short, long, non-finite or huge vectors). Repeated rows
    and null ids are vectors of their own; a null id is never a first centroid. Fewer than k vectors give fewer
    centroids, none give no rows. Ties go to the smaller number. Other columns are left out.
    """
    vectors = integer_vectors(rows, components, scale)
    centroids = first_centroids(vectors, k, prefix)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], ASSIGNED), np.empty((0, components), np.int64)
    blocks = blocks_in_order(vectors, components)
    for _ in range(rounds):
        centroids, _ = _round(blocks, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, _, number, distance, _ in _compared(batch, centroids):
                yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(distance)], names=ASSIGNED.names)

    return blocks.mapInArrow(assign, ASSIGNED), centroids


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and distance of every usable vector of embeddings, with the inertia and its final centroid's digest."""
    assigned, centroids = cluster(table(spark, sf_dir, "embeddings"))
    assigned = stable(assigned)
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    named = inertia.join(spark.createDataFrame(digests, "cluster int, centroid_sha256 string"), "cluster")
    every = assigned.agg(F.sum("distance").alias("inertia"))
    return assigned.join(F.broadcast(named.crossJoin(every)), "cluster").select(  # one row per centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
