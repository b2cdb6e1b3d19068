"""Session settings and working tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Settings the operators are written for.  Partition counts are left to AQE: the
# initial number only has to be high enough, coalescing brings it down.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # A handful of kinds of change are written side by side instead of sorted apart.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # No Python call site for every Column: plans here have thousands.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "lakestrata") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for name, value in RECOMMENDED.items():
        builder = builder.config(name, value)
    spark = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, folder: str | None = None) -> str:
    """The folder all executors see: ``folder``, else that of the enclosing
    ``working_tables``, else the checkpoint folder of the context or of
    ``spark.checkpoint.dir``.  A private folder is made in local mode only, where
    driver and executors are one process.
    """
    found = (
        folder
        or _folder.get()
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get(CHECKPOINT_DIR, None)
        or _private.get(spark.sparkContext.applicationId)
    )
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(
                f"set {CHECKPOINT_DIR} to a folder that driver and executors share"
            )
        found = tempfile.mkdtemp(prefix="lakestrata-")
        _private[spark.sparkContext.applicationId] = found
    return found.rstrip("/")


_private: dict[str, str] = {}  # by application, local mode only
_folder: ContextVar[str | None] = ContextVar("folder of working tables", default=None)
_open: ContextVar[tuple[list[str], ...]] = ContextVar("open working tables", default=())


@contextmanager
def working_tables(spark: SparkSession, folder: str | None = None) -> Iterator[None]:
    """Delete the working tables made inside, once nothing can read them any more; with
    ``folder``, they are made below it."""
    made: list[str] = []
    token = _open.set((*_open.get(), made))
    place = _folder.set(folder or _folder.get())
    try:
        yield
    finally:
        _folder.reset(place)
        _open.reset(token)
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: Counter[int] = Counter()  # by session
_freeing_lock = Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of DataFrames made and run inside are deleted when their query ends, unless
    the session was told otherwise; else they stay until the driver's memory is collected.  Who
    runs such a DataFrame once more makes them again."""
    with _freeing_lock:
        ours = _freeing[id(spark)] > 0 or spark.conf.get(FREE_SHUFFLES, None) is None
        if ours:
            _freeing[id(spark)] += 1
            spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            if ours:
                _freeing[id(spark)] -= 1
                if not _freeing[id(spark)]:
                    spark.conf.unset(FREE_SHUFFLES)


def materialize(
    df: DataFrame | Sequence[DataFrame],
    partition_by: str | None = None,
    path: str | None = None,
    compression: str = "snappy",
) -> DataFrame:
    """Write ``df`` once to a working table and read it back.

    Used where one expensive result feeds several later plans, or where row
    numbers must not change when a task is run again.  Unlike a cache it does not
    die with an executor.  ``path`` puts it where the caller wants to keep it; without it, the
    files are compressed by ``compression``, else as the session says.  Several tables of one
    schema are written one after the other, into one; the shuffle files of each go with its end.
    """
    blocks = [df] if isinstance(df, DataFrame) else df
    df, spark = blocks[0], blocks[0].sparkSession
    temporary = path is None
    if temporary:
        path = f"{shared_dir(spark)}/work/{uuid.uuid4().hex}"
        if _open.get():
            _open.get()[-1].append(path)
    for i, block in enumerate(blocks):
        writer = block.write.mode("append" if i else "errorifexists")
        if temporary:
            writer = writer.option("compression", compression)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        with shuffles_freed(spark):
            writer.parquet(path)
    names = df.columns
    return spark.read.schema(df.schema).parquet(path).select(*names)


def side_by_side(spark: SparkSession, *works: Callable[[], T]) -> list[T]:
    """Results of works that need nothing of each other, each on a thread that sees this one's
    working tables and Spark properties.  All end before a failure is raised."""
    with ThreadPoolExecutor(len(works)) as pool:
        started = [
            pool.submit(inheritable_thread_target(spark)(copy_context().run), work)
            for work in works
        ]
    return [one.result() for one in started]
