"""Table I/O: bronze/silver/gold reads and writes, format fallback, shared work folders."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class TableNotFound(LookupError):
    pass


def remove(spark: SparkSession, path: str) -> None:
    """Delete a work folder that this library has written and nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir`` (never a machine-local temp dir).

    Raises when the session names no checkpoint dir; tests set one where it is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = "/".join([base.rstrip("/"), "shopmetrics", *parts])
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``df.checkpoint()`` usable: reuse the configured dir, set one only where it is unset."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, dynamic_overwrite: bool = False) -> None:
    """Write one table. ``dynamic_overwrite`` replaces only the partitions present in ``df``.

    A partitioned write is preceded by a ``rebalance`` on the partition columns: rows of one
    partition value meet in few tasks (few files per folder instead of one per task), and AQE
    splits a value that holds a large share of the rows over several tasks instead of one.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    if fmt == "delta":
        w = w.option("overwriteSchema", "true") if mode == "overwrite" else w.option("mergeSchema", "true")
    w.save(path)


def read_table(spark: SparkSession, path: str, fmt: str | tuple[str, ...] = "parquet",
               merge_schema: bool = False) -> DataFrame:
    """Read a table; try each format in turn (e.g. ``("delta", "parquet")``); clear error if missing."""
    fmts = (fmt,) if isinstance(fmt, str) else tuple(fmt)
    last: Exception | None = None
    for f in fmts:
        try:
            r = spark.read.format(f)
            if merge_schema and f == "parquet":
                r = r.option("mergeSchema", "true")
            return r.load(path)
        except AnalysisException as e:  # missing path or unknown format: try the next one; anything else is a real fault
            if e.getCondition() not in ("PATH_NOT_FOUND", "DATA_SOURCE_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            last = e
        except Py4JJavaError as e:  # a format whose jar is absent
            if "ClassNotFoundException" not in str(e.java_exception) and "DATA_SOURCE_NOT_FOUND" not in str(e.java_exception):
                raise
            last = e
    raise TableNotFound(f"table not found: {path} ({type(last).__name__})")


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write a table beside ``path`` and move it there when complete: readers see the old or the new one.
    The table before it stays as ``<path>__old`` until the next replacement, for readers that have begun."""
    spark = df.sparkSession
    jvm = spark._jvm
    new, old, here = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}__new-{uuid.uuid4().hex}", f"{path}__old", path))
    write_table(df, new.toString(), fmt=fmt, partition_by=partition_by)
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(here):
        fs.delete(old, True)
        fs.rename(here, old)
    if not fs.rename(new, here):
        raise OSError(f"could not move the new table to {path}")


def write_gold(tables: dict[str, DataFrame], root: str, formats: tuple[str, ...] = ("parquet",), replace: bool = False) -> dict[str, str]:
    """Write each gold table; parquet goes to ``{root}/{name}_parquet``, other formats to ``{root}/{name}``.
    With two or more formats the (small) table is checkpointed once instead of recomputed per format."""
    paths = {}
    for name, df in tables.items():
        if len(formats) > 1:
            df = checkpointed(df)
        for fmt in formats:
            path = f"{root}/{name}_parquet" if fmt == "parquet" else f"{root}/{name}"
            (replace_table if replace else write_table)(df, path, fmt=fmt)
            paths[f"{name}:{fmt}"] = path
    return paths


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, f"{root}/{name}_parquet", fmt="parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into ``spark.checkpoint.dir``: cuts lineage and survives executor
    loss (never ``localCheckpoint``). Meant for small, reused intermediate results."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_silver(spark: SparkSession, path: str, since: tuple[int, int] | None = None,
                until: tuple[int, int] | None = None, fmt: str = "parquet") -> DataFrame:
    """Silver rows, optionally limited to (Year, Month) >= ``since`` and <= ``until``.

    The bounds are predicates on the partition columns, so only the matching ``Year=/Month=``
    folders are listed and read (partition pruning); rows with no date are outside any range.
    """
    from pyspark.sql import functions as F
    df = read_table(spark, path, fmt=fmt)
    y, m = F.col("Year"), F.col("Month")
    if since is not None:
        df = df.where((y > since[0]) | ((y == since[0]) & (m >= since[1])))
    if until is not None:
        df = df.where((y < until[0]) | ((y == until[0]) & (m <= until[1])))
    return df
