"""Parsed Parquet tables, and the folder that jobs share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Files whose name holds one of these stand beside a table but aren't part of it.
SIDE_FILES = ("metadata", "TMATS")
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder's path below spark.checkpoint.dir; where the session names none, of a local master's own machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master, app = spark.sparkContext.master, spark.sparkContext.applicationId
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if app not in _local:
            _local[app] = tempfile.mkdtemp(prefix="spark-")
            atexit.register(shutil.rmtree, _local[app], True)
        base = "file://" + _local[app]
    return f"{base.rstrip('/')}/busframe-{label}-{uuid.uuid4().hex[:12]}"


def listing(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path below `path`, size) of the files in a directory of any file system, hidden ones left out; names only."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    top = fs.makeQualified(root).toString().rstrip("/")
    found, files = [], fs.listFiles(root, True)
    while files.hasNext():
        f = files.next()
        name = f.getPath().toString()[len(top) + 1 :] or f.getPath().getName()
        if not any(x[0] in "._" for x in name.split("/")):
            found.append((name, f.getLen()))
    return sorted(found)


def read_parsed(spark: SparkSession, path: str, schema: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """A file, or a directory of one table's Parquet files; side files (other suffixes, hidden names, SIDE_FILES) are left out.

    With a schema, missing columns raise. Files whose types contradict each other are refused, by a Spark job over their
    footers. Only `columns` are read.
    """
    names = [n for n, _ in listing(spark, path)]
    own = [n for n in names if n.endswith(".parquet") and not any(x in n for x in SIDE_FILES)]
    # Spark skips side files by itself unless they are Parquet files too.
    lone = len(names) == 1 and path.rstrip("/").endswith("/" + names[0])
    files = [path] if lone or len(own) == len(names) else [f"{path.rstrip('/')}/{n}" for n in own]
    df = spark.read.option("mergeSchema", "true").parquet(*files)
    if schema:
        wanted = spark.createDataFrame([], schema).schema
        require_columns(df, [f.name for f in wanted])
        if wrong := [f.name for f in wanted if df.schema[f.name].dataType != f.dataType]:
            raise TypeError(f"columns of another type: {', '.join(wrong)}")
    if columns:
        require_columns(df, columns)
        df = df.select(*columns)
    return df


def same_schema(spark: SparkSession, paths: list[str]) -> bool:
    """Whether Parquet files or directories have one schema; only footers are read."""
    first, *rest = [spark.read.option("pathGlobFilter", "*.parquet").parquet(p).schema for p in paths]
    return all([(f.name, f.dataType) for f in s] == [(f.name, f.dataType) for f in first] for s in rest)


def require_columns(df: DataFrame, columns: list[str]) -> None:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
