"""Signed reference and existence counts maintained from a stream of change deltas.

Every micro-batch is reduced to one net delta per key before it is merged, so the
state has one row a key, whatever the number of changes.  The state lies in buckets
by a hash of the key; a batch reads and writes only the buckets its keys fall in,
as a new version, and a manifest tells which version of each bucket holds.  A batch
that is run again after a failure starts from the manifest before it and
writes the same version again.  Versions that no manifest in use names are deleted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

STATE = "ref_key string, refs long, alive long"
#: Buckets of the state: a batch rewrites at most as many as it has keys.
BUCKETS = 256


def merged(state: DataFrame, deltas: DataFrame) -> DataFrame:
    """The counts after a batch of deltas (ref_key, refs, alive); keys whose counts are both zero are forgotten."""
    net = deltas.where("ref_key is not null").groupBy("ref_key").agg(F.sum("refs").alias("refs"), F.sum("alive").alias("alive"))
    return state.unionByName(net).groupBy("ref_key").agg(F.sum("refs").alias("refs"), F.sum("alive").alias("alive")).where("refs <> 0 or alive <> 0")


def orphans(state: DataFrame) -> DataFrame:
    """Keys that are referred to and don't exist."""
    return state.where("refs > 0 and alive = 0").select("ref_key", "refs")


def _manifest(spark: SparkSession, path: str, before: int | None = None) -> tuple[int, dict[int, int]]:
    """(batch, version of each bucket) of the newest manifest, at most one row a bucket; (-1, {}) without any."""
    try:
        rows = spark.read.schema("bucket int, version long, batch long").parquet(f"{path}/manifest")
    except AnalysisException:
        return -1, {}
    rows = rows if before is None else rows.where(F.col("batch") < before)
    last = rows.agg(F.max("batch").alias("b")).first()["b"]
    return (-1, {}) if last is None else (last, {r["bucket"]: r["version"] for r in rows.where(F.col("batch") == last).where("bucket >= 0").collect()})


def _buckets(spark: SparkSession, path: str, versions: dict[int, int]) -> DataFrame:
    """The state of some buckets; a bucket whose keys are all forgotten has no folder any more."""
    by_version: dict[int, list[int]] = {}
    for bucket, version in versions.items():
        by_version.setdefault(version, []).append(bucket)
    out = spark.createDataFrame([], STATE)
    for version, buckets in sorted(by_version.items()):
        out = out.unionByName(spark.read.schema(f"{STATE}, bucket int").parquet(f"{path}/version={version}").where(F.col("bucket").isin(buckets)).drop("bucket"))
    return out


def latest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The newest state, or the one before a batch; empty at the beginning."""
    return _buckets(spark, path, _manifest(spark, path, before)[1])


def _bucket(n_buckets: int):
    return F.pmod(F.xxhash64("ref_key"), F.lit(n_buckets)).cast("int")


def batch_writer(path: str, n_buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function that keeps the state under ``path``; the number of buckets stays for the life of a state."""

    def write(deltas: DataFrame, batch: int) -> None:
        spark = deltas.sparkSession
        last, versions = _manifest(spark, path, batch)
        deltas = deltas.where("ref_key is not null")
        touched = sorted(r["bucket"] for r in deltas.select(_bucket(n_buckets).alias("bucket")).distinct().collect())  # at most n_buckets rows
        state = _buckets(spark, path, {b: versions[b] for b in touched if b in versions})
        merged(state, deltas).withColumn("bucket", _bucket(n_buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={batch}")
        now = versions | dict.fromkeys(touched, batch)
        # A first row without a bucket keeps the manifest of an empty state.
        spark.createDataFrame([(-1, batch), *now.items()], "bucket int, version long").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/batch={batch}")
        # The batch before stays readable, as this one may be run again.
        _drop_unused(spark, path, last, set(versions.values()) | set(now.values()) | {batch})

    return write


def _drop_unused(spark: SparkSession, path: str, last: int, used: set[int]) -> None:
    """Delete versions and manifests that neither this batch nor the one before needs; only where the session reaches the file system."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return
    home = jvm.org.apache.hadoop.fs.Path(path)
    files = home.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder, keep in ((home, lambda v: v in used), (jvm.org.apache.hadoop.fs.Path(f"{path}/manifest"), lambda v: v >= last)):
        for status in files.listStatus(folder):
            name, equals, number = status.getPath().getName().partition("=")
            if equals and name in ("version", "batch") and not keep(int(number)):
                files.delete(status.getPath(), True)


def maintain(deltas: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep the counts of a stream of deltas (ref_key, refs, alive) under ``path``."""
    return deltas.writeStream.foreachBatch(batch_writer(path)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
