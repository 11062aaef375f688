"""Sessions for tests and benches, and the shared scratch area long jobs cut lineage into."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Folders of written tables, and those that the open blocks of `scratch_tables` have written, the innermost block last.
_PLACES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_OPEN: ContextVar[tuple[list[tuple[SparkSession, str]], ...]] = ContextVar("open", default=())


def local_session(app: str = "tributary", cpus: str | int = "*", memory: str = "8g") -> SparkSession:
    """A single-JVM session with the settings the test and bench runs use."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, or a temporary one in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tributary-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    return os.path.join(scratch_root(spark), "tributary", f"{name}-{uuid.uuid4().hex}")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """For writes: the shuffle files of each go when it is done, not when the driver happens to collect its garbage. A write
    plans its rows anew, so nothing reads them later."""
    before = spark.conf.get(_SHUFFLES, None)
    spark.conf.set(_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES)
        else:
            spark.conf.set(_SHUFFLES, before)


def write_and_reload(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Cut lineage with a written table: loops stay flat, a lost executor re-reads files,
    and later joins see the true size of the data."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    if blocks := _OPEN.get():
        blocks[-1].append((spark, path))
    with shuffles_freed(spark):
        df.write.parquet(path, compression=compression)
    table = spark.read.schema(schema).parquet(path)
    _PLACES[table] = path
    return table


def drop(*tables: DataFrame) -> None:
    """Delete tables of `write_and_reload` that nothing reads any more, nor will read if what comes next is repeated.
    Frames that are no such table are left alone."""
    for table in tables:
        if path := _PLACES.pop(table, None):
            _delete(table.sparkSession, path)


@contextmanager
def scratch_tables() -> Iterator[None]:
    """Tables that `write_and_reload` writes in the block are deleted at its end, also when it fails. What leaves the block
    must not rest on them."""
    written: list[tuple[SparkSession, str]] = []
    token = _OPEN.set((*_OPEN.get(), written))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for spark, path in written:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
