"""Derived bronze table: one product record per lineitem row (see FIXTURES.md §5).

The same expressions are written in DuckDB SQL in ``plans/oracle.py``; only the date formatting differs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S

# Columns kept until the dedupe is done, to make the survivor unique at every scale.
TIE_BREAK = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
DEDUPE_ORDER = ["ProcessedTimestamp"] + TIE_BREAK


def read_tpch(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_from_tpch(spark: SparkSession, sf_dir: str, category: str = "type",
                     tie_break: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """Bronze product rows derived from lineitem ⋈ part ⋈ supplier ⋈ nation.

    ``category="brand"`` takes ``p_brand`` (25 values) instead of ``p_type`` (6 values), for
    gold at a finer grain. With ``tie_break`` the four lineitem tie-break columns are kept.
    Each dimension is joined straight to lineitem, so the planner checks each one's own size
    against the broadcast threshold (a pre-joined supplier ⋈ nation is over-estimated as the
    product of both sizes, which forced a full shuffle of lineitem). Above the threshold, e.g.
    ``part`` at large scale, the join is a shuffle join, split by AQE when a key is skewed.

    ``columns`` keeps those product columns (and the dedupe's ProductID and ProcessedTimestamp);
    a dimension is joined only when a kept column comes from it. Every lineitem row has exactly one
    row in each dimension, so leaving one out changes no row count.
    """
    wanted = set(S.BRONZE_COLUMNS if columns is None else columns) | {"ProductID", "ProcessedTimestamp"}
    cat_src = {"type": "p_type", "brand": "p_brand"}[category]
    joined = read_tpch(spark, sf_dir, "lineitem")
    if wanted & {"ProductName", "Category"}:
        joined = joined.join(read_tpch(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "City" in wanted:
        joined = (joined.join(read_tpch(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
                        .join(read_tpch(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")))
    cols = [
        F.col("l_partkey").cast("int").alias("ProductID"),
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("ProductName"),
        F.concat(F.lit(" "), F.lower(F.col(cat_src)), F.lit(" ")).alias("Category"),
        (F.col("l_extendedprice") / 200 - 10).alias("Price"),
        (F.lit(0.5) + F.round(F.col("l_tax") * 100) * 0.6).alias("Rating"),
        (F.col("l_quantity") * 110 - 200).cast("int").alias("NumReviews"),
        (F.col("l_quantity") * 22 - 30).cast("int").alias("StockQuantity"),
        ((F.col("l_quantity") - 5) / 2.0).alias("Sales"),
        (F.round(F.col("l_discount") * 100) * 15 - 15).cast("int").alias("Discount"),
        F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("DateAdded"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit("!")).alias("City"),
        (F.col("l_linestatus") == "O").alias("StockStatus"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("ProcessedTimestamp"),
    ]
    kept = [e for e, name in zip(cols, S.BRONZE_COLUMNS, strict=True) if name in wanted]
    return joined.select(*kept, *(TIE_BREAK if tie_break else ()))


def drop_tie_break(df: DataFrame) -> DataFrame:
    return df.drop(*TIE_BREAK)


def _q(c):
    """A quoted CSV field."""
    return F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))


def product_csv_lines(bronze: DataFrame) -> DataFrame:
    """Raw CSV text lines (no header) from fixture bronze rows, with defects chosen by line number:

    ``l_linenumber`` 3: Discount written as ``<n>.0`` (not an int: rejected);
    4: only 10 fields (rejected although every number parses); 5: Price ``x`` (rejected);
    6: StockStatus missing, 11 fields (kept, StockStatus false). ProductName is always quoted.
    """
    ln = F.col("l_linenumber")
    s = lambda c: F.col(c).cast("string")
    fields = [
        s("ProductID"), _q(F.col("ProductName")), F.col("Category"),
        F.when(ln == 5, F.lit("x")).otherwise(s("Price")),
        s("Rating"), s("NumReviews"), s("StockQuantity"), s("Sales"),
        F.when(ln == 3, F.concat(s("Discount"), F.lit(".0"))).otherwise(s("Discount")),
        F.col("DateAdded"),
    ]
    city = F.col("City")
    status = F.when(F.col("StockStatus"), F.lit("TRUE")).otherwise(F.lit("FALSE"))
    head = F.concat_ws(",", *fields)
    line = (F.when(ln == 4, head)
             .when(ln == 6, F.concat_ws(",", head, city))
             .otherwise(F.concat_ws(",", head, city, status)))
    return bronze.select(line.alias("value"))
