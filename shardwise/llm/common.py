"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import shardwise
from shardwise.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application:
    a zip in the shared checkpoint folder, fetched by Spark like any file of
    ``--py-files``."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(shardwise.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    folder = scratch_dir(spark, "package")
    target = sc._jvm.org.apache.hadoop.fs.Path(f"{folder}/{root.name}.zip")
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(packed.getvalue())
    out.close()
    sc.addPyFile(f"{folder}/{root.name}.zip")
    _shipped.add(sc.applicationId)


def materialise(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: the
    lineage ends there, ids given by the plan are fixed, and a lost executor
    costs a re-read instead of a recomputation."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def spread(df: DataFrame) -> int:
    """Partitions for a shuffle whose size is not known beforehand."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def collect_bounded(df: DataFrame, most: int, what: str) -> list:
    """Rows of a control table whose size has a stated bound; exceeding the
    bound is an error, never a silent cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what}: more than {most} rows")
    return rows


def hash_sample(df: DataFrame, by: Column, most: int) -> DataFrame:
    """At most ``most`` rows with the smallest hashes of ``by`` (column ``_h``).
    A bound on the hash, from the row count, leaves about half as many rows
    again to be ordered, so tasks do not each send ``most`` rows."""
    n = df.count()
    out = df.withColumn("_h", F.xxhash64(by))
    if n > 2 * most:
        out = out.where(F.col("_h") < int(-(2**63) + 2**64 * 1.5 * most / n))
    return out.orderBy("_h").limit(most)


def slices(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items with about ``most`` units of length each
    (a longer single item stands alone), so that memory in a task is bounded."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if lengths:
        yield start, len(lengths)


def text_slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int, list[str]]]:
    """An Arrow string array in ranges of about ``most`` bytes: start, end and
    the texts of the range, so only these are Python strings at a time.  Nulls
    come as empty texts."""
    for a, b in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), most):
        yield a, b, [t or "" for t in texts.slice(a, b - a).to_pylist()]
