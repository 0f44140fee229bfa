"""The object table: one row per id, kept by upserts that rewrite only the buckets they touch.

Rows lie in buckets by a hash of their id. A version is a manifest: which folder holds each bucket, the number of
buckets, the schema, and the last batch that each source has brought. Writing the manifest is the commit; what an
interrupted upsert left in the data folder is not part of any version.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee.session import stable

#: Rows of a bucket; their number doubles when buckets hold twice as many on average.
BUCKET_ROWS = 250_000
_MANIFEST = ("buckets int, key string, schema string, files array<struct<bucket: int, folder: string, rows: long>>, "
             "applied map<string, long>")


def last_per_key(batch: DataFrame, seq: str, key: str = "id") -> DataFrame:
    """The last row of each key. Each task keeps one row per key before the shuffle."""
    latest = W.partitionBy(key).orderBy(F.desc(seq))
    return batch.withColumn("_n", F.row_number().over(latest)).where(F.col("_n") == 1).drop("_n")


def upsert(target: DataFrame, batch: DataFrame, seq: str, key: str = "id") -> DataFrame:
    """Target after the batch: known keys take all columns of the batch's last row, new keys are added."""
    fresh = last_per_key(batch, seq, key).select(*target.columns)
    # one pass over both sides: a full join by key, where the batch's row wins
    pair = target.select(key, F.struct(*target.columns).alias("old")).join(
        fresh.select(key, F.struct(*target.columns).alias("new")), key, "full_outer")
    return pair.select(F.coalesce("new", "old").alias("row")).select("row.*")


@dataclass
class Manifest:
    """One version of the table. `files` maps a bucket to its folder and row count."""

    buckets: int
    key: str
    schema: T.StructType
    files: dict[int, tuple[str, int]] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.files.values())


def snapshot_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version}"


def _glob(spark: SparkSession, pattern: str) -> list:
    """Hadoop paths that a pattern finds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [f.getPath() for f in found]


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions in order."""
    return sorted(int(p.getParent().getName().partition("=")[2])
                  for p in _glob(spark, f"{snapshot_path(root, '*')}/_SUCCESS"))


def latest_version(spark: SparkSession, root: str) -> int:
    """The last version whose commit was completed, 0 if there is none."""
    return max(_versions(spark, root), default=0)


def read_manifest(spark: SparkSession, root: str, version: int) -> Manifest:
    row = spark.read.schema(_MANIFEST).parquet(snapshot_path(root, version)).first()
    return Manifest(row["buckets"], row["key"], T.StructType.fromJson(json.loads(row["schema"])),
                    {f["bucket"]: (f["folder"], f["rows"]) for f in row["files"]}, row["applied"])


def _commit(spark: SparkSession, root: str, version: int, manifest: Manifest) -> None:
    """Write the manifest as one file; over what an interrupted commit of this version left there."""
    files = [(b, folder, n) for b, (folder, n) in sorted(manifest.files.items())]
    row = (manifest.buckets, manifest.key, manifest.schema.json(), files, manifest.applied)
    spark.createDataFrame([row], _MANIFEST).coalesce(1).write.mode("overwrite").parquet(snapshot_path(root, version))


def _read_files(spark: SparkSession, root: str, manifest: Manifest, buckets: list[int] | None = None) -> DataFrame:
    """Rows of the given buckets (all by default)."""
    wanted = manifest.files if buckets is None else [b for b in buckets if b in manifest.files]
    if not wanted:
        return spark.createDataFrame([], manifest.schema)
    return spark.read.schema(manifest.schema).parquet(*[f"{root.rstrip('/')}/{manifest.files[b][0]}" for b in wanted])


def read_snapshot(spark: SparkSession, root: str, version: int) -> DataFrame:
    return _read_files(spark, root, read_manifest(spark, root, version))


def bucket_of(key: str, buckets: int) -> Column:
    """Bucket of a row; rows without an id share one."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write_buckets(df: DataFrame, root: str) -> dict[int, tuple[str, int]]:
    """Write rows that carry `_bucket` into a folder of their own; folder and rows of each bucket."""
    folder = f"data/{uuid.uuid4().hex}"
    path = f"{root.rstrip('/')}/{folder}"
    df.write.partitionBy("_bucket").parquet(path)
    counts = df.sparkSession.read.schema("_bucket int").parquet(path).groupBy("_bucket").count()
    return {r["_bucket"]: (f"{folder}/_bucket={r['_bucket']}", r["count"]) for r in counts.collect()}


def _enough_buckets(buckets: int, rows: int, bucket_rows: int) -> int:
    while rows > 2 * buckets * bucket_rows:
        buckets *= 2
    return buckets


def write_snapshot(df: DataFrame, root: str, version: int, key: str = "id", bucket_rows: int = BUCKET_ROWS) -> str:
    """Write a whole table (one row per id) as a version; writing the same version again replaces it."""
    spark = df.sparkSession
    buckets = _enough_buckets(1, df.count(), bucket_rows)
    placed = df.withColumn("_bucket", bucket_of(key, buckets)).repartition("_bucket")
    _commit(spark, root, version, Manifest(buckets, key, df.schema, _write_buckets(placed, root)))
    return snapshot_path(root, version)


def upsert_snapshot(batch: DataFrame, seq: str, root: str, key: str = "id", source: str | None = None, number: int = 0,
                    bucket_rows: int = BUCKET_ROWS) -> int:
    """Apply a batch to the latest version and return the version that holds it.

    Only buckets with an id of the batch are read and written; the new manifest takes the others' folders over. Rows
    without an id are one object. Batches of a `source` are numbered upwards; one that was applied before changes
    nothing, so a repeated batch of a stream is safe. A batch without rows changes nothing but its source's number. A
    table has one writer at a time.
    """
    spark = batch.sparkSession
    version = latest_version(spark, root)
    old = read_manifest(spark, root, version) if version else Manifest(1, key, batch.schema)
    if old.key != key:
        raise ValueError(f"the table's key is {old.key}, not {key}")
    if source is not None and old.applied.get(source, -1) >= number:
        return version
    names = old.schema.fieldNames()
    fresh = stable(last_per_key(batch, seq, key).select(*names))
    buckets = _enough_buckets(old.buckets, old.rows + fresh.count(), bucket_rows)
    grown = buckets != old.buckets
    # at most one number per bucket comes back
    touched = None if grown else [r[0] for r in fresh.select(bucket_of(key, buckets)).distinct().collect()]
    rows = _read_files(spark, root, old, touched).withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    newest = W.partitionBy("_bucket", key).orderBy(F.desc("_new"))  # one shuffle by bucket serves window and files
    merged = (rows.withColumn("_bucket", bucket_of(key, buckets)).repartition("_bucket")
              .withColumn("_n", F.row_number().over(newest)).where(F.col("_n") == 1).select(*names, "_bucket"))
    files = {**({} if grown else old.files), **_write_buckets(merged, root)}
    applied = old.applied if source is None else {**old.applied, source: number}
    _commit(spark, root, version + 1, Manifest(buckets, key, old.schema, files, applied))
    return version + 1


def drop_unreferenced(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove all but the last `keep` versions and every bucket folder none of them uses; how many folders went.

    Manifests go first, so that no version is seen without its files. Not to be run during an upsert.
    """
    if keep < 1:
        raise ValueError("at least one version is kept")
    versions = _versions(spark, root)
    root = root.rstrip("/")
    conf = spark._jsc.hadoopConfiguration()
    for path in _glob(spark, f"{root}/version=*"):
        if path.getName() not in {f"version={v}" for v in versions[-keep:]}:
            path.getFileSystem(conf).delete(path, True)
    used = {folder for v in versions[-keep:] for folder, _ in read_manifest(spark, root, v).files.values()}
    dropped = 0
    for path in _glob(spark, f"{root}/data/*"):
        inside = _glob(spark, f"{path}/_bucket=*")
        unused = [p for p in inside if f"data/{path.getName()}/{p.getName()}" not in used]
        for p in unused:
            p.getFileSystem(conf).delete(p, True)
        if len(unused) == len(inside):
            path.getFileSystem(conf).delete(path, True)
        dropped += len(unused)
    return dropped
