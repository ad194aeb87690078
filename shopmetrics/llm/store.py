"""Intermediate tables in the shared folder that the session names: they cut lineage and outlive executors."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shopmetrics.sources.tables import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema_with(df: DataFrame, more: str) -> StructType:
    """The schema of ``df`` and the columns that the DDL text ``more`` adds."""
    return StructType(df.schema.fields + StructType.fromDDL(more).fields)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name, unique=True)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kept_at = path  # noqa: SLF001
    return out


def drop(*frames: DataFrame) -> None:
    """Remove kept tables that nothing reads any more, and let Spark's cleaner drop old shuffle files."""
    for df in frames:
        path = getattr(df, "_kept_at", None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    if frames:
        frames[0].sparkSession.sparkContext._jvm.System.gc()


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a cluster that ships it otherwise loses nothing)."""
    root = str(Path(__file__).resolve().parents[2])
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (have, root) if x)


#: Rows that a column reader and bytes that an Arrow batch hold at once. By default both hold thousands of rows, however long.
SHORT = {"spark.sql.parquet.columnarReaderBatchSize": "512", "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 22)}


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run in this block read and send texts in batches of bounded size; the session's own settings hold again after it."""
    before = {k: spark.conf.get(k, None) for k in SHORT}
    try:
        for k, v in SHORT.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
