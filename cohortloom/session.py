"""Session set-up and the few places where the engine touches cluster settings."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def get_spark(app: str = "cohortloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    ``caseSensitive`` is on because sample characteristics carry columns that
    differ by case only; AQE coalesces small and splits skewed shuffle partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.caseSensitive": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Folders made by this process for sessions that name none, by application.
_OWN_FOLDERS: dict[str, str] = {}
#: Folders of intermediate tables by application, with the session that can delete them.
_TABLES: dict[str, tuple[str, SparkSession]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors share.

    Only where it is unset and the master is local is a temporary one made; the session's
    own settings aren't touched.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = _OWN_FOLDERS.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="cohortloom-checkpoint-")
        _OWN_FOLDERS[spark.sparkContext.applicationId] = folder
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back.

    A lost executor then costs a read and not the work before; Parquet keeps the
    table a fraction of what a checkpoint of rows takes.  The tables of an application lie
    in one folder, which ``release`` or the end of the process deletes.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    home = f"{shared_folder(spark).rstrip('/')}/cohortloom-{app}"
    _TABLES[app] = (home, spark)
    path = f"{home}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables of at most so many rows and bytes are broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A side of a join that is expected to be small, computed once: held by the driver and broadcast up to ``limit`` rows and 64 MB, beyond that written and shuffled."""
    rows = df.limit(limit + 1).toArrow()
    if rows.num_rows > limit or rows.nbytes > BROADCAST_BYTES:
        return cut_lineage(df)
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def in_slots(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with a column ``__slot``: ranges of its rows in an order, cut at sampled quantiles and numbered in that order.

    A group of any size is cut into as many slots as its share asks for.  The result is written, so
    that a row's slot is the same for all who read it.
    """
    return cut_lineage(df.repartitionByRange(*order).withColumn("__slot", F.spark_partition_id()))


def ranked_in(df: DataFrame, keys: list[str], order: list[str], rank: str) -> DataFrame:
    """``df`` with the place of each row among those of its keys, from 1; no window holds a whole group."""
    slotted = in_slots(df, *keys, *order)
    sizes = slotted.groupBy(*keys, "__slot").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = bounded(sizes.select(*keys, "__slot", before.alias("__before")))
    inside = F.row_number().over(Window.partitionBy(*keys, "__slot").orderBy(*order))
    return slotted.withColumn(rank, inside).join(offsets, [*keys, "__slot"]).withColumn(rank, F.col(rank) + F.col("__before")).drop("__slot", "__before")


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables of this session's application; frames built on them can't be read any more."""
    app = spark.sparkContext.applicationId
    home, _ = _TABLES.pop(app, (None, None))
    if home is not None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(home)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    own = _OWN_FOLDERS.pop(app, None)
    if own:
        shutil.rmtree(own, ignore_errors=True)


@atexit.register
def _release_all() -> None:
    for _, spark in list(_TABLES.values()):
        with contextlib.suppress(Exception):  # the engine may be gone already
            release(spark)
    for own in _OWN_FOLDERS.values():
        shutil.rmtree(own, ignore_errors=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files give fewer partitions than there are cores.

    For maps that spend far more on a row than moving it costs; tables of many files
    are left as they lie.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once, so that they need no installation of it."""
    context = spark.sparkContext
    if getattr(context, "_cohortloom_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="cohortloom-package-")  # on the driver, which serves it to the executors
    package = shutil.make_archive(os.path.join(folder, "cohortloom"), "zip", os.path.dirname(here), os.path.basename(here))
    context.addPyFile(package)
    context._cohortloom_shipped = True


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
