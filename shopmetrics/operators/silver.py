"""Bronze -> silver: dedupe, retype, clean, range rules, date parts, scaled features (SLV-1..15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def latest_per_product(df: DataFrame, key: str = "ProductID", order: Sequence[str] | None = None,
                       keep: Sequence[str] | None = None) -> DataFrame:
    """One row per ``key``: the row that is greatest by ``order`` (default: ProcessedTimestamp,
    then every other column), all descending, NULLs lowest.

    Written as ``groupBy(key).agg(max(struct(order..., rest...)))`` rather than a
    ``row_number`` window: the aggregate combines map-side, so a hot key that holds a large
    share of the rows is reduced to one row per map task before the shuffle, where the window
    would sort all of that key's rows in a single task.

    That aggregate sorts its rows (a struct with texts has no hash aggregate), and a scan's task holds more wide rows than its
    share of memory once the files compress well. A batch is therefore rebalanced by the key's hash first: the rows of a product
    meet in tasks of even size, which sort them in memory and leave about one row per product for the second shuffle.
    By a hash and not by the key itself, as adaptive execution may then split what a hot key fills over several tasks.

    The optimizer can't drop fields of a struct under ``max``, so ``keep`` names the columns that are
    needed beside the key and the order; nothing else goes through the sort and the shuffle.
    """
    if keep is not None and order:
        df = df.select(*[c for c in df.columns if c == key or c in order or c in keep])
    order = list(order) if order else ["ProcessedTimestamp"] + [
        c for c in df.columns if c not in (key, "ProcessedTimestamp")]
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    met = df if df.isStreaming else df.withColumn("_near", F.xxhash64(key)).hint("rebalance", "_near")
    return (met.groupBy(key)
              .agg(F.max(packed).alias("_latest"))
              .select(F.col(key), *[F.col("_latest")[c].alias(c) for c in df.columns if c != key]))


#: Silver column -> the bronze column that it is made of.
SILVER_SOURCES = {c: c for c in S.BRONZE_COLUMNS} | {"Year": "DateAdded", "Month": "DateAdded"}


def sales_rule(sales):
    """Negative sales are 0; sales up to 1 are in thousands."""
    return (F.when(sales < 0, F.lit(S.SALES_FLOOR))
             .when(sales <= S.SALES_SMALL_LIMIT, sales * S.SALES_SMALL_FACTOR)
             .otherwise(sales))


def clean_products(df: DataFrame) -> DataFrame:
    """Retype and clean deduplicated bronze rows into silver columns (one flat projection).

    Rule order follows the reference: Sales and Discount are fixed before the range rules;
    Price/Rating are float32; Discount becomes double (the /100 branch); bad dates are NULL.
    Of a bronze frame with fewer columns, the silver columns that come from those are made.
    """
    have = set(df.columns)
    price = F.col("Price").try_cast("float")
    rating = F.col("Rating").try_cast("float")
    reviews = F.col("NumReviews").try_cast("int")
    stock = F.col("StockQuantity").try_cast("int")
    sales = F.col("Sales").try_cast("double")
    disc = F.col("Discount")
    date = F.try_to_date(F.col("DateAdded").cast("string"))
    passthrough = [c for c in df.columns if c not in S.BRONZE_COLUMNS]
    rules = dict(zip(SILVER_SOURCES, [
        F.col("ProductID"),
        F.trim(F.col("ProductName")).alias("ProductName"),
        F.upper(F.trim(F.col("Category"))).alias("Category"),
        F.when(price < S.PRICE_MIN, F.lit(None)).when(price > S.PRICE_MAX, F.lit(None))
         .otherwise(F.round(price, 2)).cast("float").alias("Price"),
        F.when(rating < S.RATING_MIN, F.lit(None)).when(rating > S.RATING_MAX, F.lit(None))
         .otherwise(rating).cast("float").alias("Rating"),
        F.when(reviews < 0, F.lit(0)).when(reviews > S.REVIEWS_MAX, F.lit(None))
         .otherwise(reviews).cast("int").alias("NumReviews"),
        F.when(stock < 0, F.lit(0)).when(stock > S.STOCK_MAX, F.lit(None))
         .otherwise(stock).cast("int").alias("StockQuantity"),
        sales_rule(sales).alias("Sales"),
        F.when(disc > S.DISCOUNT_FRACTION_LIMIT, disc / 100)
         .when(disc < 0, F.lit(0))
         .when(disc > S.DISCOUNT_CAP, F.lit(S.DISCOUNT_CAP))
         .otherwise(disc).cast("double").alias("Discount"),
        date.alias("DateAdded"),
        F.trim(F.regexp_replace(F.col("City"), S.CITY_DROP_PATTERN, "")).alias("City"),
        F.col("StockStatus"),
        F.col("ProcessedTimestamp"),
        F.year(date).alias("Year"),
        F.month(date).alias("Month"),
    ], strict=True))
    return df.select(*[rule for name, rule in rules.items() if SILVER_SOURCES[name] in have],
                     *[F.col(c) for c in passthrough])


def scale_columns(df: DataFrame, cols: Sequence[str] = tuple(S.SCALED_COLUMNS),
                  prefix: str = "scaled_", vectors: bool = False) -> DataFrame:
    """Divide each column by its sample standard deviation over the whole table (no centring);
    a zero (or undefined) deviation gives 0.0, as Spark ML's StandardScaler does. NULL stays NULL.

    The deviations come from one global aggregate: a single row, joined by broadcast (its size
    is fixed at one row whatever the input size). With ``vectors`` the arrays ``features`` and
    ``scaled_features`` are added as ``array<double>``.
    """
    stats = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(f"_sd_{c}") for c in cols])
    joined = df.crossJoin(F.broadcast(stats))
    scaled = []
    for c in cols:
        sd = F.coalesce(F.col(f"_sd_{c}"), F.lit(0.0))
        x = F.col(c).cast("double")
        scaled.append(F.when(x.isNull(), F.lit(None).cast("double"))
                      .when(sd == 0, F.lit(0.0)).otherwise(x / sd).alias(f"{prefix}{c}"))
    out = joined.select(*df.columns, *scaled)
    if vectors:
        out = out.withColumns({
            "features": F.array(*[F.col(c).cast("double") for c in cols]),
            "scaled_features": F.array(*[F.col(f"{prefix}{c}") for c in cols]),
        }).drop(*[f"{prefix}{c}" for c in cols])
    return out


def build_silver(bronze: DataFrame, order: Sequence[str] | None = None,
                 drop: Sequence[str] = (), vectors: bool = False) -> DataFrame:
    """Full bronze -> silver: dedupe, clean, optional scaled vectors; ``drop`` removes helper columns."""
    silver = clean_products(latest_per_product(bronze, order=order).drop(*drop))
    return scale_columns(silver, vectors=True) if vectors else silver
