"""The issue index as a table in hash buckets, so that a batch rewrites only the buckets it touches.

A version is a manifest: for each bucket the version that last wrote it. The data of version
n lies in data/v<n>/bucket=<b>, its manifest in manifest/v<n>, written last. A manifest has one row
per bucket, however large the index is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressline.session import discard_paths, noting, stored
from pressline.sources import schemas as S
from pressline.sources.readers import _exists
from pressline.sources.writers import upsert_index

#: Buckets of a new index, and manifests that stay readable.
BUCKETS, KEEP = 256, 5
MANIFEST = "bucket int, version long, buckets int"


class IndexTable:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, keep: int = KEEP):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), max(2, keep)
        newest = max(self.versions(), default=None)
        held = self.spark.read.schema(MANIFEST).parquet(self._manifest(newest)).first() if newest is not None else None
        # an index keeps the number it was made with
        self.buckets = held["buckets"] if held else buckets

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifest/v{version}"

    def _bucket(self, bucket: int, version: int) -> str:
        return f"{self.path}/data/v{version}/bucket={bucket}"

    def bucket_of(self, issue_id: Column) -> Column:
        return F.pmod(F.xxhash64(issue_id), F.lit(self.buckets)).cast("int")

    def _listed(self, pattern: str) -> list:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        found = folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(folder) or []
        return [f.getPath() for f in found]

    def versions(self) -> list[int]:
        """Numbers of the versions that are complete."""
        return [int(p.getParent().getName()[1:]) for p in self._listed("manifest/v*/_SUCCESS")]

    def manifest(self, version: int) -> dict[int, int]:
        """bucket -> version that holds it. A version that is not there fails."""
        return {r["bucket"]: r["version"] for r in self.spark.read.schema(MANIFEST).parquet(self._manifest(version)).where("bucket >= 0").collect()}

    def read(self, version: int | None = None, buckets: set[int] | None = None) -> DataFrame:
        """The index of a version, the newest by default, or some buckets of it; empty before the first."""
        version = max(self.versions(), default=-1) if version is None else version
        held = self.manifest(version) if version >= 0 else {}
        paths = [self._bucket(b, v) for b, v in sorted(held.items()) if buckets is None or b in buckets]
        return self.spark.read.schema(S.ISSUE_INDEX).parquet(*paths) if paths else self.spark.createDataFrame([], S.ISSUE_INDEX)

    def upsert(self, new: DataFrame, version: int, reconcile: Callable[[DataFrame], DataFrame] | None = None) -> set[int]:
        """Write version from the one before it and the rows of new; the buckets that were rewritten.

        A version that is written again comes out the same, as it starts from the one before. reconcile
        sees the whole index; only buckets in which it changes a row are rewritten too."""
        with noting() as made:
            new = stored(new, "batch")
            bucket = self.bucket_of(F.col("issue_id"))
            touched = {r["b"] for r in new.select(bucket.alias("b")).distinct().collect()}
            if reconcile is None:
                rows = upsert_index(self.read(version - 1, touched), new)
            else:
                merged = stored(upsert_index(self.read(version - 1), new), "merged")
                settled = stored(reconcile(merged).select(*merged.columns), "settled")
                both = settled.join(merged.select("issue_id", F.struct(*merged.columns).alias("__old")), "issue_id")
                moved = both.where(~F.struct(*merged.columns).eqNullSafe(F.col("__old")))
                touched |= {r["b"] for r in moved.select(bucket.alias("b")).distinct().collect()}
                rows = settled.where(bucket.isin(touched))
            names = [f.split(" ")[0] for f in S.ISSUE_INDEX.split(", ")]
            rows.select(*names, bucket.alias("bucket")).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/v{version}")
        discard_paths(self.spark, made)
        held = (self.manifest(version - 1) if version > 0 else {}) | dict.fromkeys(touched, version)
        # a row without a bucket keeps the number of buckets where no bucket has rows
        rows = [(b, v, self.buckets) for b, v in sorted(held.items())] or [(-1, version, self.buckets)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(self._manifest(version))
        self.expire()
        return touched

    def expire(self) -> None:
        """Delete all manifests but the newest `keep`, and buckets that none of these names."""
        kept = sorted(self.versions())[-self.keep :]
        named = {(b, v) for version in kept for b, v in self.manifest(version).items()}
        for path in self._listed("manifest/v*"):
            if int(path.getName()[1:]) < kept[0]:
                self._delete(path)
        for path in self._listed("data/v*/bucket=*"):
            place = int(path.getName().split("=")[1]), int(path.getParent().getName()[1:])
            if place not in named and place[1] <= kept[-1]:
                self._delete(path)

    def _delete(self, path) -> None:
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def first_version(table: IndexTable, checkpoint: str) -> int:
    """Version of the checkpoint's batch 0: after the newest there was when the checkpoint was first used."""
    spark, kept = table.spark, f"{checkpoint.rstrip('/')}-first-version"
    if not _exists(spark, f"{kept}/_SUCCESS"):
        spark.range(1).select(F.lit(max(table.versions(), default=-1) + 1).cast("long").alias("first")).write.mode("overwrite").parquet(kept)
    return spark.read.schema("first long").parquet(kept).first().first
