"""Session helpers: a local session for tests, and tables in the cluster's shared folder."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_shipped: set[str] = set()
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def local_session(cores: str = "8", shuffle_partitions: int = 8, name: str = "custlens") -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; a temporary folder only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _local_folders[app] = tempfile.mkdtemp(prefix="custlens-")
    return _local_folders[app]


def materialize(df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/custlens/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _scopes.get():
        _scopes.get()[-1].append(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.stage_path = path
    return written


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(df: DataFrame) -> None:
    """Delete the table that `materialize` wrote for this frame."""
    _delete(df.sparkSession, df.stage_path)


@contextmanager
def stage_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that `materialize` writes inside are deleted at the end, but for those written by the function this yields.

    What is needed later must be written by that function: frames that still read the others can not be used any more.
    """
    own: list[str] = []
    outer = _scopes.get()
    token = _scopes.set((*outer, own))

    def keep(df: DataFrame) -> DataFrame:
        inner = _scopes.set(outer)  # belongs to the scope around this one, if there is one
        try:
            return materialize(df)
        finally:
            _scopes.reset(inner)

    try:
        yield keep
    finally:
        _scopes.reset(token)
        for path in own:
            _delete(spark, path)


def release_memory() -> None:
    """Give memory that this process has freed back to the system: allocators keep it otherwise."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run`, for `mapInArrow`, that releases memory at the end of each task: workers wait for the next one beside those of other stages."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: executors need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="custlens-"), "custlens.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("custlens", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
