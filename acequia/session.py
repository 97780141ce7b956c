"""Session helpers: where intermediate tables go and how lineage is cut."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """Folder shared by all executors, from ``spark.checkpoint.dir``.

    Only where that is unset and all runs in one machine, as in local tests,
    a temporary folder is made and put into the session's settings. On a
    cluster each executor would write to a disk of its own, so there an unset
    folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir isn't set: it must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="acequia-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def materialize(df: DataFrame, label: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` below the checkpoint folder and return a reader of it.

    The table is columnar, so later steps read only the columns they use; it
    outlives any executor; and the plan behind it isn't run twice.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/acequia/{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._acequia_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and nothing reads any more; others are left alone."""
    for df in tables:
        path = getattr(df, "_acequia_path", None)
        if path in _written:
            _written.remove(path)
            sc = df.sparkSession.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where it came in fewer parts, as one small file does; others as they are.

    For the work of Python functions, which takes longer than moving the rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


@atexit.register
def _clean() -> None:
    """Remove the tables of this run, as far as a context still stands."""
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    if sc is None or sc._jsc is None:
        return
    try:
        for path in _written:
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:
        pass
