"""Change detection for retraining (STR-8, STR-9): file and content fingerprints, changed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import checkpointed

FINGERPRINT_COLUMNS = ["table_name", "rows", "hash"]


def file_fingerprint(spark: SparkSession, name: str, path: str, glob: str = "*.parquet") -> DataFrame:
    """(table_name, rows = file count, hash) over the paths and modification times of the data
    files under ``path``. The binary-file source lists files without reading their content.
    Evaluated eagerly (a one-row checkpoint): a fingerprint is a snapshot of the folder now."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path).select("path", "modificationTime"))
    return checkpointed(files.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64("path", "modificationTime").cast("decimal(38,0)")).alias("_s"),
    ).select(F.lit(name).alias("table_name"), "rows", F.xxhash64("rows", "_s").cast("string").alias("hash")))


def canonical_text(df: DataFrame):
    """One text for each row that any engine can write: columns by name; numbers with six decimals (or, beyond a decimal's
    reach, as they print), NULL as ``~``."""
    texts = []
    for c, kind in sorted(df.dtypes):
        x = F.col(f"`{c}`")
        if kind in ("float", "double") or kind.startswith("decimal"):
            x = F.coalesce(x.try_cast("decimal(38,6)").cast("string"), x.cast("string"))
        texts.append(F.coalesce(x.cast("string"), F.lit("~")))
    return F.concat_ws("|", *texts)


def content_fingerprint(df: DataFrame, name: str) -> DataFrame:
    """(table_name, rows, hash): order-insensitive hash of the table content (duplicates counted),
    one distributed aggregate: the sum of 60 bits of each row's md5, as a decimal, so no overflow."""
    row_hash = F.conv(F.substring(F.md5(canonical_text(df)), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_hash), F.lit(0)).cast("string").alias("hash")).select(
        F.lit(name).alias("table_name"), "rows", "hash")


def changed_tables(old: DataFrame, new: DataFrame, only_changes: bool = False) -> DataFrame:
    """Full outer join of two fingerprint tables: status new / gone / changed / unchanged."""
    o = old.select(F.col("table_name").alias("_o_name"), F.col("rows").alias("_o_rows"), F.col("hash").alias("_o_hash"))
    n = new.select(F.col("table_name").alias("_n_name"), F.col("rows").alias("_n_rows"), F.col("hash").alias("_n_hash"))
    j = o.join(n, o["_o_name"].eqNullSafe(n["_n_name"]), "full_outer")
    status = (F.when(F.col("_o_name").isNull(), "new")
               .when(F.col("_n_name").isNull(), "gone")
               .when(F.col("_o_rows").eqNullSafe(F.col("_n_rows")) & F.col("_o_hash").eqNullSafe(F.col("_n_hash")),
                     "unchanged")
               .otherwise("changed"))
    out = j.select(F.coalesce("_n_name", "_o_name").alias("table_name"), status.alias("status"))
    return out.where(F.col("status") != "unchanged") if only_changes else out


def should_retrain(changes: DataFrame, seconds_since_last: float, min_interval: float, in_progress: bool) -> bool:
    """The coordinator's decision: never while a run is in progress; skip only when the minimum
    interval has not passed AND nothing changed (the reference's rule). One tiny probe job."""
    if in_progress:
        return False
    changed = not changes.where(F.col("status") != "unchanged").isEmpty()
    return not (seconds_since_last < min_interval and not changed)
