"""Gold tables against a brute-force pandas computation of the same definitions (random silver rows)."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shopmetrics.operators import gold as G

SILVER = "ProductID int, Category string, Price float, Rating float, NumReviews int, Sales double, Discount double"
maybe = lambda s: st.one_of(st.none(), s)
row = st.tuples(st.integers(0, 10**6), st.sampled_from(["A", "B", "C", None]),
                maybe(st.sampled_from([0.5, 9.99, 25.0, 120.25, 499.0])), maybe(st.sampled_from([1.0, 2.5, 4.0, 5.0])),
                maybe(st.integers(0, 5000)), maybe(st.sampled_from([0.0, 1.5, 7.0, 500.0, 1000.0])),
                maybe(st.sampled_from([0.0, 1.05, 15.0, 30.0, 50.0])))


def close(a, b, tol):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and not (isinstance(b, float) and math.isnan(b)) and abs(a - b) <= tol


def nz(x):
    return None if x is None or (isinstance(x, float) and math.isnan(x)) else x


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=30))
def test_gold_matches_pandas(spark, rows):
    sdf = spark.createDataFrame(rows, SILVER)
    pdf = pd.DataFrame(rows, columns=["ProductID", "Category", "Price", "Rating", "NumReviews", "Sales", "Discount"])
    pdf = pdf.astype({"Price": "float64", "Rating": "float64", "Sales": "float64", "Discount": "float64",
                      "NumReviews": "float64"})
    pdf["Revenue"] = (pdf.Price * pdf.Sales * (1 - pdf.Discount / 100)).round(2)
    g = pdf.groupby("Category", dropna=False)
    stats = G.category_stats(sdf)
    rev = {r.Category: r for r in G.revenue_per_category(stats, ordered=False).collect()}
    imp = {r.Category: r for r in G.discount_impact(stats).collect()}
    rsr = {r.Category: r for r in G.review_sales_ratio(stats).collect()}
    assert len(rev) == g.ngroups
    for cat, grp in g:
        key = None if (isinstance(cat, float) and math.isnan(cat)) else cat
        r, i, s = rev[key], imp[key], rsr[key]
        assert r.ProductCount == len(grp)
        assert close(r.TotalRevenue, nz(grp.Revenue.sum(min_count=1)), 0.011)
        assert close(r.TotalSales, nz(grp.Sales.sum(min_count=1)), 1e-6)
        assert close(r.AveragePrice, nz(grp.Price.mean()), 0.006)
        assert close(r.AvgDiscountPercentage, nz(grp.Discount.mean()), 0.006)
        without = grp.Sales[grp.Discount == 0].mean()
        assert close(i.AvgSalesWithoutDiscount, nz(without), 0.006)
        if i.AvgSalesWithoutDiscount is None or i.AvgSalesWithoutDiscount <= 0:
            assert i.DiscountImpactPercentage == 0.0
        assert s.TotalReviews == (None if grp.NumReviews.isna().all() else int(grp.NumReviews.sum()))
        assert s.TotalSales == grp.Sales.fillna(0).sum()
        assert s.HighRatingCount == int((grp.Rating >= 4.0).sum())
        assert s.CustomerEngagementLevel in ("High", "Medium", "Low")
        if s.TotalSales <= 0:
            assert s.ReviewToSalesRatio == 0.0 and s.CustomerEngagementLevel == "Low"
