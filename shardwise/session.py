"""Session helpers: a configured SparkSession and the shared scratch folder.

Scratch data (materialised log stores, stream checkpoints, sink output)
lives under the folder the cluster names in ``spark.checkpoint.dir``.  Only
when that setting is absent (unit tests on a laptop) do we create one.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                driver_memory: str | None = None) -> SparkSession:
    """A session tuned for this library; reuses an active one if present.

    ``master``, ``shuffle_partitions`` and ``driver_memory`` are set only when
    given (local runs, tests, the bench): on a cluster the deployment decides
    them, and AQE sizes shuffle partitions from the advisory partition size."""
    b = SparkSession.builder.appName("shardwise")
    if master:
        b = b.master(master)
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set one only where the session has none."""
    root = spark.conf.get(_CKPT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        # only where none is named and everything runs on one machine (tests);
        # Spark 4 refuses ``conf.set`` of this core setting at run time, so the
        # folder is given to the context, which is where it is read above
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="shardwise-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A folder below the shared checkpoint root; fresh per call by default.
    Fresh folders go when the driver's interpreter ends (results that were not
    copied elsewhere are read from them until then)."""
    suffix = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    path = f"{checkpoint_root(spark)}/shardwise/{suffix}"
    if unique:
        if not _SCRATCH:
            atexit.register(_clean_scratch)
        _SCRATCH.append((spark, path))
    return path


def _clean_scratch() -> None:
    for spark, path in _SCRATCH:
        with contextlib.suppress(Exception):  # the JVM or the file system may be gone by now
            _file_system(spark, path).delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this application made."""
    _file_system(spark, path).delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster file system (works for any Hadoop FS)."""
    return bool(_file_system(spark, path).exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)))
