"""Session settings and the scratch folder for lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cpus: str | int = "*", memory: str = "8g", partitions: int = 8, **settings: str
) -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pressgauge")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_dirs: dict[str, str] = {}
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, wherever the driver was started; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Executors fetch the file from the driver when their first task starts, so it stays to the end.
    folder = tempfile.TemporaryDirectory(prefix="pressgauge-")
    path = os.path.join(os.path.realpath(folder.name), "pressgauge.zip")
    with zipfile.ZipFile(path, "w") as out:
        for where, _, names in os.walk(os.path.join(root, "pressgauge")):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(where, name)
                    out.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _shipped[app] = folder


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder, one per
    application. On a cluster a missing setting is an error, because a machine-local
    folder dies with its executor.
    """
    configured = spark.sparkContext.getConf().get(CHECKPOINT_CONF) or spark.conf.get(
        CHECKPOINT_CONF, None
    )
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"{CHECKPOINT_CONF} must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="pressgauge-")
    return _local_dirs[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """Fresh sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages restart from files that outlive a lost executor, and a
    non-deterministic plan (range sampling, partition ids) is fixed once.
    """
    path = scratch_dir(df.sparkSession, label)
    scopes = getattr(_scopes, "open", ())
    # Whole rows go through the tables of a scope, and texts pack better this way.
    (df.write.option("compression", "zstd") if scopes else df.write).parquet(path)
    for scope in scopes:
        scope.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_scopes = threading.local()


class Cuts:
    """The tables that :func:`cut_lineage` wrote in a scope of :func:`dropped_cuts`."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def drop(self, keep: int = 0) -> None:
        """Delete the scope's tables but the last ``keep``; what is read of them must have been written already."""
        last = len(self.paths) - keep
        gone, self.paths = self.paths[:last], self.paths[last:]
        jvm, hadoop = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in gone:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(hadoop).delete(folder, True)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """:func:`cut_lineage` for a table that leaves the scope; scopes around this one drop it at their end."""
        whole = cut_lineage(df, label)
        self.paths.pop()
        return whole

    def replace(self, df: DataFrame, label: str) -> DataFrame:
        """:func:`cut_lineage`, and the tables that ``df`` was made from go."""
        whole = cut_lineage(df, label)
        self.drop(keep=1)
        return whole


@contextmanager
def dropped_cuts(spark: SparkSession) -> Iterator[Cuts]:
    """What this thread's :func:`cut_lineage` writes inside is deleted at the end; nothing that still reads it may leave the scope."""
    scope = Cuts(spark)
    _scopes.open = [*getattr(_scopes, "open", ()), scope]
    try:
        yield scope
    finally:
        _scopes.open = _scopes.open[:-1]
        scope.drop()
