"""Feature engineering over gold (FEA-1..19), as DataFrame operators.

Every global constant (means, sample deviations, quantile edges) comes from one global
aggregate: a single row joined by broadcast, never collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.safe import one_if_zero, safe_div
from .quantiles import exact_quantiles

KEYS = ("Category",)

# Quantile probabilities of pandas.qcut (numpy.linspace(0, 1, q + 1) without the ends).
QUINTILES = (0.2, 0.4, 0.6000000000000001, 0.8)
TERCILES = (0.3333333333333333, 0.6666666666666666)


def join_gold(revenue: DataFrame, discount: DataFrame, correlation: DataFrame, reviews: DataFrame,
              keys: Sequence[str] = KEYS) -> DataFrame:
    """Inner join of four gold tables on the keys (NULL keys match each other, as pandas merge).

    On a name clash the left keeps its name and the right gets ``_disc`` / ``_price`` / ``_review``.
    """
    out = revenue
    for right, suffix in ((discount, "_disc"), (correlation, "_price"), (reviews, "_review")):
        clash = [c for c in right.columns if c in out.columns and c not in keys]
        r = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                         *[F.col(c).alias(c + suffix if c in clash else c) for c in right.columns if c not in keys])
        cond = None
        for k in keys:
            e = out[k].eqNullSafe(r[f"_k_{k}"])
            cond = e if cond is None else cond & e
        out = out.join(r, cond, "inner").drop(*[f"_k_{k}" for k in keys])
    return out


def fill_numeric_nulls(df: DataFrame) -> DataFrame:
    """NULL -> 0 in numeric columns (pandas fillna(0)); string columns keep their NULLs."""
    return df.fillna(0)


def quantile_bin(x, edges, labels: Sequence[str]):
    """Label by right-closed bins over ascending ``edges`` (lowest value included in the first bin).
    Equal edges collapse instead of raising."""
    expr = None
    for edge, label in zip(edges, labels[:-1]):
        expr = F.when(x <= edge, label) if expr is None else expr.when(x <= edge, label)
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(labels[-1]))


def _quantiles(x, probs, approx: bool, accuracy: int):
    arr = F.array(*[F.lit(q) for q in probs])
    return F.percentile_approx(x, arr, accuracy) if approx else F.percentile(x, arr)


def exact_edges(df: DataFrame) -> dict[str, list[float | None]]:
    """The bin edges of ``add_features`` by counting passes: exact, and no buffer grows with the rows (``operators.quantiles``)."""
    roi = F.greatest(F.col("DiscountROI"), F.lit(0.0))
    return exact_quantiles(df, {"price": F.col("AveragePrice"), "roi": roi}, {"price": QUINTILES, "roi": TERCILES})


def add_features(df: DataFrame, approx: bool = False, accuracy: int = 10000, edges: dict | None = None) -> DataFrame:
    """All derived features of the model input (FEA-3..19).

    Quantile edges are exact (``percentile``, interpolating like pandas) by default; exact
    percentiles buffer the values of the whole frame in one aggregate, which is right for the
    per-category feature rows. With ``approx=True`` (features at product grain) they come from
    ``percentile_approx``, whose buffer is bounded by ``accuracy``; with ``edges`` (see ``exact_edges``) they are given, and exact.
    """
    def quantiles(x, probs, name):
        if edges is not None:
            return F.any_value(F.array(*[F.lit(v).cast("double") for v in edges[name]]))
        return _quantiles(x, probs, approx, accuracy)

    roi = F.greatest(F.col("DiscountROI"), F.lit(0.0))
    g = df.agg(
        F.avg("AveragePrice").alias("_m_ap"), F.stddev_samp("AveragePrice").alias("_s_ap"),
        F.avg("TotalRevenue").alias("_m_tr"), F.stddev_samp("TotalRevenue").alias("_s_tr"),
        F.avg("TotalSales").alias("_m_ts"), F.stddev_samp("TotalSales").alias("_s_ts"),
        quantiles(F.col("AveragePrice").cast("double"), QUINTILES, "price").alias("_q_ap"),
        quantiles(roi, TERCILES, "roi").alias("_q_roi"),
    )
    x = df.crossJoin(F.broadcast(g))
    c = F.col
    ap, adp, ar = c("AveragePrice"), c("AvgDiscountPercentage"), c("AvgRating")
    pc, tr, ts = c("ProductCount"), c("TotalRevenue"), c("TotalSales")
    loss, tdr = c("RevenueLossFromDiscount"), c("TotalDiscountedRevenue")
    reviews_per_sale = safe_div(c("TotalReviews"), one_if_zero(ts))
    high_ratio = safe_div(c("HighRatingCount"), one_if_zero(pc))
    effectiveness = safe_div(tdr, c("PotentialRevenue"))
    feats = {
        "PriceToAvgRatio": safe_div(ap, c("_m_ap")),
        "PriceVariance": safe_div(F.abs(ap - c("_m_ap")), c("_s_ap")),
        "PriceCategory": quantile_bin(ap, [c("_q_ap")[i] for i in range(4)], S.PRICE_CATEGORY_LABELS),
        "DiscountEfficiency": F.when(loss > 0, safe_div(tdr, loss)).otherwise(F.lit(0.0)),
        "DiscountROICategory": quantile_bin(roi, [c("_q_roi")[i] for i in range(2)], S.ROI_CATEGORY_LABELS),
        "DiscountEffectiveness": effectiveness,
        "ReviewsPerSale": reviews_per_sale,
        "HighRatingRatio": high_ratio,
        "EngagementScore": reviews_per_sale * high_ratio * ar,
        "CustomerSatisfaction": safe_div(ar * high_ratio, effectiveness + 1),
        "RevenuePerProduct": safe_div(tr, pc),
        "SalesEfficiency": safe_div(ts, pc * adp + 1),
        "PriceRatingInteraction": ap * ar,
        "DiscountRatingInteraction": adp * ar,
        "PriceDiscountInteraction": ap * adp,
        "MarketPerformance": safe_div(tr, pc * ap),
        "CustomerEngagementIndex": safe_div(c("TotalReviews") * ar, ts),
        "ProfitabilityScore": tr * (1 - adp / 100),
        "Normalized_TotalRevenue": safe_div(tr - c("_m_tr"), c("_s_tr")),
        "Normalized_TotalSales": safe_div(ts - c("_m_ts"), c("_s_ts")),
        "Normalized_AveragePrice": safe_div(ap - c("_m_ap"), c("_s_ap")),
    }
    return x.select(*df.columns, *[e.alias(n) for n, e in feats.items()])


def feature_frame(gold: dict[str, DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """gold tables -> joined, NULL-filled, all features."""
    joined = join_gold(gold["revenue_per_category"], gold["discount_effectiveness"],
                       gold["price_rating_correlation"], gold["review_sales_ratio"], keys)
    return add_features(fill_numeric_nulls(joined))
