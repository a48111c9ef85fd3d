"""Session helpers: time zone, and the folder shared by driver and executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable
from typing import Any, TypeVar

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
_local_dirs: dict[str, str] = {}
_roots: set[str] = set()
_made: dict[tuple[str, str], Any] = {}
_locks: dict[tuple[str, str], threading.Lock] = {}
_guard = threading.Lock()


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks. Clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stationflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """All clocks are UTC: zone-less input timestamps are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root for staged tables and checkpoints: ``spark.checkpoint.dir``, or the folder the context was given.

    A machine-local folder is used only with a local master and only when
    neither is set; on a cluster that is an error, because executors could not
    see each other's files.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="stationflow-")
        context.setCheckpointDir(_local_dirs[app])
        atexit.register(shutil.rmtree, _local_dirs[app], True)
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, deleted when the program ends."""
    root = f"{shared_dir(spark)}/stationflow-{spark.sparkContext.applicationId}"
    if root not in _roots:
        _roots.add(root)
        atexit.register(_delete, spark, root)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, root: str) -> None:
    """Works while the session does; a session that was stopped before leaves its folder."""
    if spark.sparkContext._jsc is not None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def version(spark: SparkSession, path: str) -> str:
    """A mark of the files below ``path``: it changes when one of them is written, replaced or removed."""
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path", "length", "modificationTime").alias("h"))
    count, mark = files.agg(F.count("*"), F.bit_xor("h")).first()
    return f"{path} {count} {mark}"


def once(spark: SparkSession, what: str, make: Callable[[], T]) -> T:
    """``make()``, or what it gave before in this session under the same name. Threads that ask together wait for one result."""
    key = (spark.sparkContext.applicationId, what)
    with _guard:
        lock = _locks.setdefault(key, threading.Lock())
    with lock:
        if key not in _made:
            _made[key] = make()
        return _made[key]
