"""Data-quality profile (PRF-1..5): row count, NULL counts, sales statistics, ordered samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count, row_count) for every column, from ONE aggregate job.

    The wide one-row result is unpivoted; its size is the number of columns, not of rows.
    """
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("row_count"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n_{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("null_count"))
             for i, c in enumerate(cols)]
    return (wide.select(F.explode(F.array(*pairs)).alias("p"), "row_count")
                .select("p.column_name", "p.null_count", "row_count"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def sales_stats(layers: dict[str, DataFrame], col: str = "Sales") -> DataFrame:
    """round(avg,2), min, max of Sales per layer (e.g. bronze before cleaning, silver after)."""
    out = None
    for name, df in layers.items():
        one = df.agg(F.round(F.avg(col), 2).alias("avg_sales"),
                     F.min(F.col(col).cast("double")).alias("min_sales"),
                     F.max(F.col(col).cast("double")).alias("max_sales")).select(
            F.lit(name).alias("layer"), "avg_sales", "min_sales", "max_sales")
        out = one if out is None else out.unionByName(one)
    return out


def sales_stats_once(bronze: DataFrame, order: Sequence[str], rule, key: str = "ProductID", col: str = "Sales") -> DataFrame:
    """``sales_stats`` of the raw records and of the latest cleaned record of each product, from one scan:
    the dedupe's aggregate carries the sums that the raw layer needs. ``rule`` is the cleaning of the column."""
    x = F.col(col).cast("double")
    per = bronze.groupBy(key).agg(F.max(F.struct(*order, col))[col].cast("double").alias("_last"), F.sum(x).alias("_sum"),
                                  F.count(x).alias("_n"), F.min(x).alias("_min"), F.max(x).alias("_max"))
    clean = rule(F.col("_last"))
    mean = F.try_divide(F.sum("_sum"), F.sum("_n"))
    stats = "avg_sales", "min_sales", "max_sales"
    row = lambda layer, *e: F.struct(F.lit(layer).alias("layer"), *[v.alias(n) for n, v in zip(stats, e, strict=True)])
    one = per.agg(F.array(row("bronze", F.round(mean, 2), F.min("_min"), F.max("_max")),
                          row("silver", F.round(F.avg(clean), 2), F.min(clean), F.max(clean))).alias("layers"))
    return one.select(F.inline("layers"))


def sample_rows(df: DataFrame, cols: Sequence[str], n: int = 5, order: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows of a projection under an explicit order (a top-n report: the limit is the feature)."""
    order = list(order or cols)
    return df.select(*dict.fromkeys([*cols, *order])).orderBy(*order).limit(n).select(*cols)
