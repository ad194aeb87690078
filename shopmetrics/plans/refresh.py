"""Rebuild silver and gold from the whole bronze table (``incremental`` does it for what a batch changed)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .. import schema as S
from ..operators import silver as SV
from ..sources import tables as TB
from . import medallion as MD

BATCH_COLUMN = "_batch_id"
STREAM_COLUMN = "_stream"


@dataclass(frozen=True)
class LakePaths:
    bronze: str
    silver: str
    gold: str
    state: str = ""
    rejected: str = ""
    partials: str = ""
    scaling: str = ""

    @classmethod
    def under(cls, root: str) -> "LakePaths":
        return cls(f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/refresh", f"{root}/rejected", f"{root}/partials", f"{root}/scaling")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a stream's checkpoint: the same after a restart, another for another checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]  # one row


def read_bronze(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Bronze rows without the stream and batch partition columns.

    Parquet bronze is read with the fixed bronze schema: no schema inference and no footer merge
    over the many small files a stream leaves behind."""
    if fmt == "parquet":
        try:
            df = spark.read.schema(S.BRONZE_SCHEMA).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            raise TB.TableNotFound(f"table not found: {path}") from e
    else:
        df = TB.read_table(spark, path, fmt=fmt)
    return df.select(*S.BRONZE_COLUMNS)


def refresh_tables(spark: SparkSession, paths: LakePaths, keys: Sequence[str] = ("Category",),
                   order: Sequence[str] | None = None, formats: Sequence[str] = ("parquet",)) -> dict[str, str]:
    """bronze -> silver (overwrite, partitioned by Year, Month) -> gold (six tables, overwrite).

    Silver is written and read back before gold, so the gold jobs start from the stored table
    instead of re-running the dedupe shuffle for each of them.
    """
    return publish_tables(spark, paths, SV.build_silver(read_bronze(spark, paths.bronze), order=order, vectors=True), keys, formats)


def publish_tables(spark: SparkSession, paths: LakePaths, silver: DataFrame, keys: Sequence[str], formats: Sequence[str]) -> dict[str, str]:
    """Write silver and the gold tables made of it; each table is replaced whole by a rename, so a
    reader finds the old one until the new one is complete."""
    TB.replace_table(silver, paths.silver, fmt=formats[0], partition_by=["Year", "Month"])
    gold = MD.gold_from_silver(TB.read_table(spark, paths.silver, fmt=formats[0]), keys)
    return TB.write_gold(gold, paths.gold, formats=tuple(formats), replace=True)


def compact_bronze(spark: SparkSession, path: str, target: str) -> None:
    """Bronze with few, even files: all its rows rewritten under ``target`` (for a lake whose streams are stopped)."""
    read_bronze(spark, path).hint("rebalance").write.mode("errorifexists").parquet(target)
