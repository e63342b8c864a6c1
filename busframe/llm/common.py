"""Helpers shared by the operators: intermediate tables, columns, links."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_base: dict[str, str] = {}


def _base(spark: SparkSession) -> str:
    """The folder that all executors share. Where the session names none, a local master gets a new one; others get a ValueError."""
    if base := spark.conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_base:
        _local_base[app] = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, _local_base[app], True)
    return "file://" + _local_base[app]


_kept: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps from one task to the next, until a task comes that doesn't name it."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def _lean(f: Callable, uses: tuple[str, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for name in [n for n in _kept if n not in uses]:
        del _kept[name]
    try:
        yield from f(batches)
    finally:  # workers live on: what is free goes back to the system
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)


def lean(f: Callable, *uses: str) -> Callable:
    """f for mapInArrow, in a worker that keeps nothing but `uses` (names of kept()) of earlier tasks and gives memory back at its end."""
    return partial(_lean, f, uses)


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's size of Arrow batches to 8 MB, where it is Spark's default of 64: rows here hold whole texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864b", "67108864", "64m", "64MB"):
        spark.conf.set(key, "8m")


class Scratch:
    """Intermediate tables of one run, as Parquet in the shared folder: a lost executor costs no recomputation of what was written."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, f"{_base(spark)}/busframe-{label}-{uuid.uuid4().hex[:12]}"
        self._known: dict[str, str] = {}
        bound_batches(spark)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_dealt(self, df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
        """As write, in buckets by `key`: a join on it in as many partitions doesn't shuffle this side."""
        path, known = f"{self.root}/{name}", "busframe_" + self.root.rpartition("-")[2] + "_" + name.replace("-", "_")
        df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(parts, key).saveAsTable(known)
        self._known[name] = known
        return self.spark.table(known)

    def drop(self, *names: str) -> None:
        """Deletes tables that no later step reads."""
        for name in names:
            if known := self._known.pop(name, None):
                self.spark.sql(f"DROP TABLE IF EXISTS {known}")
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def need(df: DataFrame, *columns: str) -> None:
    """Raises ValueError if a column is missing."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_runs(batches: Iterator[pa.RecordBatch], key: tuple[str, ...], enough: int) -> Iterator[pa.Table]:
    """Sorted rows in tables of about `enough` bytes or more; a table ends where the key changes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.nbytes
        if size < enough:
            continue
        t = pa.Table.from_batches(held)
        changes = np.zeros(len(t) - 1, bool)
        for c in key:
            x = t.column(c).to_numpy()
            changes |= x[1:] != x[:-1]
        if not (ends := np.flatnonzero(changes)).size:
            continue
        yield t.slice(0, int(ends[-1]) + 1)
        held = t.slice(int(ends[-1]) + 1).to_batches()
        size = sum(x.nbytes for x in held)
    if held:
        yield pa.Table.from_batches(held)


def connected_components(scratch: Scratch, edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """Components of undirected links (u, v), both long: (node, root) for each linked node; root is the component's smallest node.

    Alternates large-star and small-star steps until the links no longer change; each step is two grouped joins, and only
    two numbers per step reach the driver. Null ends are ignored, loops and repeated links have no effect.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    e = scratch.write(e, f"{label}-0")
    before = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
    for i in range(1, max_rounds + 1):
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        e = scratch.write(small.union(low).distinct(), f"{label}-{i}")
        scratch.drop(f"{label}-{i - 1}")
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components didn't settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())
