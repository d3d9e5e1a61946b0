"""Shared helpers: the cluster's shared folder, staged tables, private column names."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local master, whose executors are the driver itself, may fall back to a
    temporary folder; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="kindred-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        sc.setCheckpointDir(root)
        return "file://" + root
    return root.rstrip("/")


def new_dir(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/kindred/{uuid.uuid4().hex}/{tag}"


def delete_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, whatever store holds it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_dir(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstage(df: DataFrame) -> None:
    """Free a staged table that nothing reads any more."""
    if path := getattr(df, "_staged_at", None):
        delete_dir(df.sparkSession, path)


#: Spark's setting for the bytes of an Arrow batch, its default, and what these operators use instead.
_BATCH_KEY, _BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4m"


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of a few MB, whatever the rows' size; a session's own setting is kept."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        conf.set(_BATCH_KEY, BATCH_BYTES)
    return df.mapInArrow(function, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names for internal use that clash with none of ``df``'s columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
