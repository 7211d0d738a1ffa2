"""SparkSession helpers: test session, the shared folder and lineage cuts.

Library code never creates its own session; it uses the active one.
"""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[tuple[SparkSession, str]] = []
_SHIPPED: set[str] = set()
_PASSING: contextvars.ContextVar[list | None] = contextvars.ContextVar("passing", default=None)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "riskloom") -> SparkSession:
    """A local-mode session tuned for small tests (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RISKLOOM_DRIVER_MEM", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    A cluster must name it; a missing setting raises there, because a folder
    of one machine would lose data.  Only a ``local`` master, where driver
    and executors are one process, gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-ckpt-"))
    return sc.getCheckpointDir()


ensure_checkpoint_dir = shared_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable (executor-loss safe) checkpoint; never ``localCheckpoint``."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, compression: str = "zstd", kept: bool = False, rows_per_file: int = 0) -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read back.

    Cuts the lineage like a checkpoint, but keeps columnar pruning and
    compression for tables that are read more than once.  The files go when
    the driver ends, or with `passing_tables` unless ``kept``.  With
    ``rows_per_file`` a task writes several files, which readers share evenly.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/written-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_remove)
    _WRITTEN.append((spark, path))
    df.write.option("compression", compression).option("maxRecordsPerFile", rows_per_file).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    if _PASSING.get() is not None and not kept:
        _PASSING.get().append(out)
    return out


@contextlib.contextmanager
def passing_tables() -> Iterator[None]:
    """Tables that this thread writes (`written`) inside are deleted at the end: nothing may read them later."""
    tables: list[DataFrame] = []
    token = _PASSING.set(tables)
    try:
        yield
    finally:
        _PASSING.reset(token)
        for table in tables:
            if (table.sparkSession, table.written_path) in _WRITTEN:
                discard(table)


def discard(df: DataFrame) -> None:
    """Deletes the files of a `written` table whose last reader has ended."""
    spark, path = df.sparkSession, df.written_path
    _delete(spark, path)
    _WRITTEN.remove((spark, path))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Operators with Python tasks need it wherever the executors do not have the
    package installed.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="riskloom-py-")), "riskloom_workers.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def _delete(spark: SparkSession, path: str) -> None:
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(hadoop).delete(at, True)


def _remove() -> None:
    for spark, path in _WRITTEN:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001, S112 - a session that has gone can't clean; others still can
            continue
