"""Silver -> six gold tables (GLD-1..19).

Five tables are keyed by Category: their aggregates are computed in one fused ``groupBy``
(``category_stats``) and each table is a projection of it. Column pruning removes the
aggregates a single table does not use, so asking for one table costs one table's work.
``price_satisfaction`` needs the global mean price first: a one-row aggregate joined by
broadcast (its size is one row, whatever the input), never collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.safe import safe_corr, sum_null_as_zero

KEYS = ("Category",)

# Discount and Sales are decimal quantities (parsed from text); their averages are taken over an
# exact DECIMAL sum, so a mean that falls exactly on a rounding tie is rounded HALF_UP the same way
# under any partitioning (a double sum of values such as 1.05 depends on the summation order).
# A group that holds a value the decimal can't carry (NaN, too large, too many digits) has the plain double average.
DISCOUNT_DECIMAL = "decimal(20,4)"
SALES_DECIMAL = "decimal(20,6)"


def revenue_expr(price="Price", sales="Sales", discount="Discount"):
    """Per-row revenue after discount, rounded to cents (same formula as DiscountedRevenue)."""
    return F.round(F.col(price) * F.col(sales) * (F.lit(1.0) - F.col(discount) / 100), 2)


def exact_avg2(value, kind: str, only=None):
    """round(avg(value), 2) as double, over exact decimals where they carry every value of the group."""
    value = value.cast("double")
    exact = value.try_cast(kind)
    if only is not None:
        value, exact = F.when(only, value), F.when(only, exact)
    lost = F.count_if(value.isNotNull() & ~F.coalesce(exact.cast("double") == value, F.lit(False)))
    return F.when(lost > 0, F.round(F.avg(value), 2)).otherwise(F.round(F.avg(exact), 2).cast("double"))


#: The silver columns that each table keyed by Category needs.
NEEDS = {
    "revenue_per_category": ("Price", "Sales", "Discount"),
    "discount_impact": ("Sales", "Discount"),
    "discount_effectiveness": ("Price", "Sales", "Discount"),
    "price_rating_correlation": ("Price", "Rating", "NumReviews"),
    "price_satisfaction": ("Price", "Rating", "Sales", "NumReviews"),
    "review_sales_ratio": ("Sales", "Rating", "NumReviews"),
}


def category_stats(silver: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All per-category aggregates of the five Category-keyed gold tables, in one pass.

    Of a silver frame with fewer columns (see ``NEEDS``), the aggregates that those allow."""
    price, sales, disc = F.col("Price"), F.col("Sales"), F.col("Discount")
    stats = {
        "_sum_revenue": (("Price", "Sales", "Discount"), F.sum(revenue_expr())),
        "_sum_full_revenue": (("Price", "Sales"), F.sum(F.round(price * sales, 2))),
        "_sum_sales": (("Sales",), F.sum(sales)),
        "_sum_sales_nz": (("Sales",), sum_null_as_zero("Sales")),
        "_avg_price": (("Price",), F.avg(price)),
        "_count": ((), F.count(F.lit(1))),
        "_avg_discount": (("Discount",), exact_avg2(disc, DISCOUNT_DECIMAL)),
        "_avg_sales": (("Sales",), exact_avg2(sales, SALES_DECIMAL)),
        "_avg_sales_no_discount": (("Sales", "Discount"), exact_avg2(sales, SALES_DECIMAL, only=disc == 0)),
        "_corr_price_rating": (("Price", "Rating"), safe_corr("Price", "Rating")),
        "_avg_rating": (("Rating",), F.avg("Rating")),
        "_avg_reviews": (("NumReviews",), F.avg("NumReviews")),
        "_sum_reviews": (("NumReviews",), F.sum("NumReviews")),
        "_high_rating": (("Rating",), F.count_if(F.col("Rating") >= S.HIGH_RATING)),
    }
    return silver.groupBy(*keys).agg(*[e.alias(n) for n, (needs, e) in stats.items() if set(needs) <= set(silver.columns)])


def revenue_per_category(stats: DataFrame, keys: Sequence[str] = KEYS, ordered: bool = True) -> DataFrame:
    out = stats.select(
        *keys,
        F.round("_sum_revenue", 2).alias("TotalRevenue"),
        F.col("_sum_sales").alias("TotalSales"),
        F.round("_avg_price", 2).alias("AveragePrice"),
        F.col("_count").alias("ProductCount"),
        F.col("_avg_discount").alias("AvgDiscountPercentage"),
    )
    return out.orderBy(F.col("TotalRevenue").desc(), *keys) if ordered else out


def discount_impact(stats: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    with_d = F.col("_avg_sales")
    without = F.col("_avg_sales_no_discount")
    return stats.select(
        *keys,
        F.col("_avg_discount").alias("AvgDiscountPercentage"),
        F.col("_sum_sales").alias("TotalSales"),
        with_d.alias("AvgSalesWithDiscount"),
        without.alias("AvgSalesWithoutDiscount"),
        F.when(without > 0, F.round((with_d - without) / without * 100, 2))
         .otherwise(F.lit(0.0)).alias("DiscountImpactPercentage"),
    )


def discount_effectiveness(stats: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    discounted = F.round("_sum_revenue", 2)
    potential = F.round("_sum_full_revenue", 2)
    loss = F.round(potential - discounted, 2)
    return stats.select(
        *keys,
        F.col("_avg_discount").alias("AvgDiscountPercentage"),
        discounted.alias("TotalDiscountedRevenue"),
        potential.alias("PotentialRevenue"),
        F.col("_avg_sales").alias("AvgSales"),
        loss.alias("RevenueLossFromDiscount"),
        F.when(loss > 0, F.round(F.try_divide(discounted, loss), 3))
         .otherwise(F.lit(0.0)).alias("DiscountROI"),
    )


def price_rating_correlation(stats: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    corr = F.round("_corr_price_rating", 3)
    strong_pos, strong_neg, weak = S.RELATIONSHIP_LABELS
    return stats.select(
        *keys,
        corr.alias("PriceRatingCorrelation"),
        F.round("_avg_price", 2).alias("AvgPrice"),
        F.round("_avg_rating", 2).alias("AvgRating"),
        F.round("_avg_reviews", 0).alias("AvgReviews"),
        F.when(corr > S.CORRELATION_STRONG, strong_pos)
         .when(corr < -S.CORRELATION_STRONG, strong_neg)
         .otherwise(weak).alias("PriceRatingRelationship"),
    )


def review_sales_ratio(stats: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    total_sales = F.col("_sum_sales_nz")
    ratio = F.when(total_sales > 0, F.round(F.try_divide(F.col("_sum_reviews"), total_sales), 4)) \
             .otherwise(F.lit(0.0))
    high, medium, low = S.ENGAGEMENT_LABELS
    hi_lim, med_lim = S.ENGAGEMENT_LIMITS
    return stats.select(
        *keys,
        F.col("_sum_reviews").alias("TotalReviews"),
        total_sales.alias("TotalSales"),
        F.round("_avg_rating", 2).alias("AvgRating"),
        F.col("_high_rating").alias("HighRatingCount"),
        ratio.alias("ReviewToSalesRatio"),
        F.when(ratio > hi_lim, high).when(ratio > med_lim, medium).otherwise(low)
         .alias("CustomerEngagementLevel"),
    )


def price_range(price, mean_price):
    """Budget/Economy/Premium/Luxury against the global mean; a NULL price falls to Luxury (as the reference)."""
    f1, f2, f3 = S.PRICE_RANGE_FACTORS
    l1, l2, l3, l4 = S.PRICE_RANGE_LABELS
    p, m = F.col(price), F.col(mean_price)
    return (F.when(p < m * f1, l1).when(p < m * f2, l2).when(p < m * f3, l3).otherwise(l4))


def price_satisfaction(silver: DataFrame, keys: Sequence[str] = KEYS, ordered: bool = True) -> DataFrame:
    mean = silver.agg(F.avg("Price").alias("_mean_price"))
    ranged = silver.crossJoin(F.broadcast(mean)).withColumn("PriceRange", price_range("Price", "_mean_price"))
    out = ranged.groupBy("PriceRange", *keys).agg(
        F.round(F.avg("Rating"), 2).alias("AvgRating"),
        F.round(F.avg("Price"), 2).alias("AvgPrice"),
        sum_null_as_zero("Sales").alias("TotalSales"),
        F.count(F.lit(1)).alias("ProductCount"),
        F.round(F.avg("NumReviews"), 0).alias("AvgReviews"),
    )
    return out.orderBy(*keys, "PriceRange") if ordered else out


def gold_tables(silver: DataFrame, keys: Sequence[str] = KEYS, stats: DataFrame | None = None) -> dict[str, DataFrame]:
    """All six gold tables; pass a materialised ``stats`` to share one aggregate between them."""
    st = category_stats(silver, keys) if stats is None else stats
    return {
        "revenue_per_category": revenue_per_category(st, keys),
        "discount_impact": discount_impact(st, keys),
        "discount_effectiveness": discount_effectiveness(st, keys),
        "price_rating_correlation": price_rating_correlation(st, keys),
        "price_satisfaction": price_satisfaction(silver, keys),
        "review_sales_ratio": review_sales_ratio(st, keys),
    }
