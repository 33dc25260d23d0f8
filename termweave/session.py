"""Session helpers: table access and tables staged in the cluster's shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, for sessions whose workers neither have it installed nor find it on their path."""
    if spark.sparkContext.applicationId not in _shipped:
        _shipped.add(spark.sparkContext.applicationId)
        folder = tempfile.mkdtemp(prefix="termweave-")  # the driver serves it to workers that start later, so it stays
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/termweave", "zip", os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "termweave"))


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a folder of our own only where none is set (tests, one machine)."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='termweave-')}"
        sc.setCheckpointDir(found)
        _made.append((spark, found))
    return found.rstrip("/")


def shared_path(spark: SparkSession, kind: str = "table") -> str:
    """A new path in the shared folder; what is written there goes when the program ends."""
    path = f"{shared_dir(spark)}/termweave-{kind}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts the lineage: later jobs read files that outlive any executor. The files go with ``release``, or when the program ends.
    """
    spark = df.sparkSession
    path = shared_path(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def bucketed(df: DataFrame, cols: list[str]) -> DataFrame:
    """``df`` written once to the shared folder, hash-partitioned by ``cols`` into as many buckets as shuffles have partitions.

    Joins and aggregations on ``cols`` then read it without a shuffle, however often it is read. The files go when the program ends.
    """
    spark = df.sparkSession
    path, name = shared_path(spark), f"termweave_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, *cols).write.bucketBy(n, *cols).sortBy(*cols).option("path", path).saveAsTable(name)
    return spark.table(name)


def small(df: DataFrame) -> bool:
    """Whether a staged frame may be broadcast: its files, taken to be compressed four times, are within Spark's own threshold."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._staged_at)
    size = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    most = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 4 * size <= most


def release(*frames: DataFrame) -> None:
    """Delete the files of staged frames that nothing reads any more. Frames that aren't staged are left alone."""
    for df in frames:
        path = getattr(df, "_staged_at", None)
        if path and (df.sparkSession, path) in _made:
            _made.remove((df.sparkSession, path))
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    if path.startswith("file:/") and os.path.isdir(local := "/" + path[5:].lstrip("/")):
        shutil.rmtree(local, ignore_errors=True)
    else:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _drop() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone
            pass
