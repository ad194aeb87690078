import pytest

from shopmetrics.operators import gold as G
from shopmetrics.operators import lookup as LK

SILVER = ("ProductID int, Category string, Price float, Rating float, NumReviews int, Sales double, "
          "Discount double")


def silver(spark, data):
    return spark.createDataFrame(data, SILVER)


def tables(spark, data):
    return G.gold_tables(silver(spark, data))


def by_cat(df):
    return {r.Category: r for r in df.collect()}


def test_revenue_and_counts(spark):
    data = [(1, "A", 10.0, 4.0, 10, 2.0, 50.0), (2, "A", 20.0, 3.0, 20, 1.0, 0.0), (3, "B", 5.0, 5.0, 0, None, 0.0)]
    t = tables(spark, data)
    rev = by_cat(t["revenue_per_category"])
    assert rev["A"].TotalRevenue == 30.0 and rev["A"].TotalSales == 3.0 and rev["A"].ProductCount == 2
    assert rev["A"].AveragePrice == 15.0 and rev["A"].AvgDiscountPercentage == 25.0
    assert rev["B"].TotalRevenue is None and rev["B"].TotalSales is None
    assert [r.Category for r in t["revenue_per_category"].collect()][0] == "A"
    assert sum(r.ProductCount for r in rev.values()) == len(data)
    rsr = by_cat(t["review_sales_ratio"])
    assert rsr["B"].TotalSales == 0.0 and rsr["B"].ReviewToSalesRatio == 0.0 and rsr["B"].CustomerEngagementLevel == "Low"
    assert rsr["A"].TotalReviews == 30 and rsr["A"].HighRatingCount == 1
    assert rsr["A"].ReviewToSalesRatio == 10.0 and rsr["A"].CustomerEngagementLevel == "High"


def test_discount_impact_without_zero_discount_rows(spark):
    t = tables(spark, [(1, "A", 10.0, 4.0, 1, 2.0, 10.0), (2, "A", 10.0, 4.0, 1, 4.0, 0.0),
                       (3, "B", 10.0, 4.0, 1, 2.0, 10.0)])
    di = by_cat(t["discount_impact"])
    assert di["B"].AvgSalesWithoutDiscount is None and di["B"].DiscountImpactPercentage == 0.0
    assert di["A"].AvgSalesWithDiscount == 3.0 and di["A"].AvgSalesWithoutDiscount == 4.0
    assert di["A"].DiscountImpactPercentage == -25.0


def test_discount_effectiveness_zero_loss(spark):
    t = tables(spark, [(1, "A", 10.0, 4.0, 1, 2.0, 0.0), (2, "B", 10.0, 4.0, 1, 2.0, 50.0)])
    de = by_cat(t["discount_effectiveness"])
    assert de["A"].RevenueLossFromDiscount == 0.0 and de["A"].DiscountROI == 0.0
    assert de["B"].TotalDiscountedRevenue == 10.0 and de["B"].PotentialRevenue == 20.0
    assert de["B"].RevenueLossFromDiscount == 10.0 and de["B"].DiscountROI == 1.0


def test_correlation_constant_and_single_row_groups(spark):
    data = [(1, "C", 10.0, 4.0, 1, 1.0, 0.0), (2, "C", 10.0, 3.0, 1, 1.0, 0.0),  # constant price
            (3, "S", 10.0, 4.0, 1, 1.0, 0.0),                                      # one row
            (4, "P", 1.0, 1.0, 1, 1.0, 0.0), (5, "P", 2.0, 2.0, 1, 1.0, 0.0), (6, "P", 3.0, 3.5, 1, 1.0, 0.0),
            (7, "N", 1.0, 3.0, 1, 1.0, 0.0), (8, "N", 2.0, 2.0, 1, 1.0, 0.0), (9, "N", None, 5.0, 1, 1.0, 0.0)]
    pr = by_cat(tables(spark, data)["price_rating_correlation"])
    assert pr["C"].PriceRatingCorrelation is None and pr["C"].PriceRatingRelationship == "Weak"
    assert pr["S"].PriceRatingCorrelation is None
    assert pr["P"].PriceRatingCorrelation == pytest.approx(0.993, abs=1e-3)
    assert pr["P"].PriceRatingRelationship == "Strong Positive"
    assert pr["N"].PriceRatingCorrelation == -1.0 and pr["N"].PriceRatingRelationship == "Strong Negative"


def test_price_ranges_and_null_price(spark):
    data = [(1, "A", 10.0, 4.0, 1, 1.0, 0.0), (2, "A", 30.0, 4.0, 1, 1.0, 0.0),
            (3, "A", 50.0, 4.0, 1, None, 0.0), (4, "A", 70.0, 4.0, 1, 1.0, 0.0), (5, "A", None, 4.0, 1, 1.0, 0.0)]
    ps = {r.PriceRange: r for r in tables(spark, data)["price_satisfaction"].collect()}
    # mean price 40: 10 < 20 Budget; 30 < 40 Economy; 50 < 60 Premium; 70 and NULL -> Luxury
    assert ps["Budget"].ProductCount == 1 and ps["Economy"].ProductCount == 1
    assert ps["Premium"].TotalSales == 0.0 and ps["Luxury"].ProductCount == 2


def test_null_category_is_a_group_and_empty_input(spark):
    t = tables(spark, [(1, None, 10.0, 4.0, 1, 1.0, 0.0), (2, "A", 10.0, 4.0, 1, 1.0, 0.0)])
    assert set(by_cat(t["revenue_per_category"])) == {None, "A"}
    empty = tables(spark, [])
    assert all(df.count() == 0 for df in empty.values())


def test_partition_count_invariance(spark):
    data = [(i, "ABC"[i % 3], float(i % 17), 1.0 + i % 5, i, float(i % 11), float(i % 4 * 10)) for i in range(300)]
    a = tables(spark, data)
    df8 = silver(spark, data).repartition(8)
    b = G.gold_tables(df8)
    for name in a:
        assert sorted(map(tuple, a[name].collect()), key=str) == sorted(map(tuple, b[name].collect()), key=str)


def test_lookup(spark):
    rev = tables(spark, [(1, "A", 10.0, 4.0, 1, 1.0, 0.0), (2, "B", 10.0, 4.0, 1, 1.0, 0.0)])["revenue_per_category"]
    assert [r.Category for r in LK.categories(rev).collect()] == ["A", "B"]
    assert LK.lookup(rev, None).count() == 2 and LK.lookup(rev, "").count() == 2
    assert [r.Category for r in LK.lookup(rev, "A").collect()] == ["A"]
    assert LK.lookup(rev, "a").count() == 0
    with pytest.raises(ValueError, match="Invalid category: a"):
        LK.lookup(rev, "a", strict=True)


def test_average_on_a_rounding_tie_is_exact_and_partition_invariant(spark):
    # mean discount is exactly 0.525 and mean sales exactly 2.345: HALF_UP gives 0.53 and 2.35 under any
    # partitioning (a double sum of 1.05s depends on the order and can land either side of the tie)
    data = [(i, "A", 10.0, 4.0, 1, 2.34 if i % 2 else 2.35, 1.05 if i < 20 else 0.0) for i in range(40)]
    for parts in (1, 3, 7, 16):
        df = silver(spark, data).repartition(parts)
        r = G.revenue_per_category(G.category_stats(df)).first()
        d = G.discount_effectiveness(G.category_stats(df)).first()
        assert r.AvgDiscountPercentage == 0.53 and d.AvgSales == 2.35


def test_averages_of_values_that_decimals_cannot_carry(spark):
    """NaN, very large and very fine sales give the plain average, others the exact one; nothing raises."""
    from shopmetrics.operators import gold as G
    nan = float("nan")
    data = [("n", nan, 0.0), ("n", 5.0, 0.0), ("b", 1e33, 0.0), ("b", 1.0, 10.0), ("f", 0.1234567, 0.0), ("t", 2.34, 0.0), ("t", 2.35, 5.0), ("z", None, 0.0)]
    df = spark.createDataFrame(data, "Category string, Sales double, Discount double")
    got = {r.Category: (r.AvgSalesWithDiscount, r.AvgSalesWithoutDiscount) for r in G.discount_impact(G.category_stats(df)).collect()}
    assert str(got["n"]) == "(nan, nan)" and got["b"] == (5e32, 1e33) and got["f"] == (0.12, 0.12)
    assert got["t"] == (2.35, 2.34) and got["z"] == (None, None)  # 2.345 is a tie: up
