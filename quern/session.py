"""Session helpers: a local session for tests and benchmarks, and shared scratch space."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def local_session(cores: int = 8, app: str = "quern") -> SparkSession:
    """Session for tests and local benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("QUERN_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


@functools.cache
def _local_folder() -> str:
    """One temporary folder of this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="quern-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


_written: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path not used before in the shared folder; ``remove_scratch`` removes what is there."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


_kept: dict[tuple, str] = {}


def kept(spark: SparkSession, key: tuple, make: Callable[[str], None]) -> str:
    """The path of a table that ``make(path)`` writes the first time this session asks for ``key``.

    For indexes that several callers use. Put what the table is made of into the key, such as
    ``source_version`` of its files.
    """
    full = (spark.sparkContext.applicationId, *key)
    if full not in _kept or not _exists(spark, _kept[full]):
        path = f"{shared_dir(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
        make(path)
        _kept[full] = path
    return _kept[full]


def source_version(*tables: DataFrame) -> int:
    """A number that changes with the files of tables that were read: their paths, sizes and times of change."""
    files = [t.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct() for t in tables]
    number = F.sum(F.xxhash64("file_path", "file_size", "file_modification_time").cast("decimal(38,0)")) % 2**61
    return hash(tuple(int(f.agg(number).first()[0] or 0) for f in files))


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def remove_scratch(spark: SparkSession, kept_too: bool = False) -> None:
    """Removes the scratch tables of this process; call it when their results were consumed.

    Indexes that were written to be used again stay, unless ``kept_too``.
    """
    if kept_too:
        _written.extend(_kept.values())
        _kept.clear()
    while _written:
        system, target = _file_system(spark, _written.pop())
        system.delete(target, True)


def stable(df: DataFrame, **options: str) -> DataFrame:
    """Writes ``df`` to the shared folder, as Parquet with ``options``, and goes on from the written table.

    For rows that are read several times, where computing them again would be slow or
    could give other partitions. Unlike cached blocks the table survives lost executors,
    and Spark knows its size. ``remove_scratch`` removes it.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
