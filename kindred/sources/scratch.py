"""Scratch folders that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Stages written in this process: application, input files and name to path.
_STAGES: dict[tuple[str, tuple, str], str] = {}


def new_folder(spark: SparkSession, tag: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``; a local master without one uses a temporary folder."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="kindred-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        sc.setCheckpointDir(root)
        root = "file://" + root
    return f"{root.rstrip('/')}/kindred/{uuid.uuid4().hex}/{tag}"


def _contents(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the tables in a folder and of their files, through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [x for t in fs.listStatus(where) for x in (fs.listStatus(t.getPath()) if t.isDirectory() else [t])]
    return tuple(sorted((x.getPath().toString(), x.getLen(), x.getModificationTime()) for x in files))


def cached_path(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The shared folder that ``write`` filled on first use in a session, and again when the input has changed."""
    key = (spark.sparkContext.applicationId, _contents(spark, sf_dir), name)
    if key not in _STAGES:
        path = new_folder(spark, name)
        write(path)
        _STAGES[key] = path
    return _STAGES[key]


def cached_stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A pipeline stage as a Parquet table in a shared folder, see ``cached_path``."""
    return spark.read.parquet(cached_path(spark, sf_dir, name, lambda path: build().write.option("compression", "zstd").parquet(path)))
