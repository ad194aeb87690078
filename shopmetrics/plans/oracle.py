"""DuckDB SQL twins of the registered queries (the correctness oracle).

Tables ``lineitem part supplier nation`` are views in the oracle engine. The SQL is written
as reusable CTE fragments: fixture bronze -> silver -> per-table SELECTs.
"""

from __future__ import annotations


def bronze_cte(category: str = "p_type", tie_break: bool = True) -> str:
    tb = ", l_orderkey, l_linenumber, l_suppkey, l_extendedprice" if tie_break else ""
    return f"""bronze AS (
  SELECT CAST(l_partkey AS INTEGER) AS ProductID,
         concat('  ', p_name, ' ') AS ProductName,
         concat(' ', lower({category}), ' ') AS Category,
         l_extendedprice / 200 - 10 AS Price,
         0.5 + round(l_tax * 100) * 0.6 AS Rating,
         CAST(l_quantity * 110 - 200 AS INTEGER) AS NumReviews,
         CAST(l_quantity * 22 - 30 AS INTEGER) AS StockQuantity,
         (l_quantity - 5) / 2.0 AS Sales,
         CAST(round(l_discount * 100) * 15 - 15 AS INTEGER) AS Discount,
         CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS DateAdded,
         concat(' ', n_name, '!') AS City,
         l_linestatus = 'O' AS StockStatus,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS ProcessedTimestamp{tb}
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey)"""


DEDUP_FIXTURE = """dedup AS (
  SELECT * EXCLUDE (rn, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) FROM (
    SELECT *, row_number() OVER (PARTITION BY ProductID ORDER BY ProcessedTimestamp DESC,
           l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
    FROM bronze) WHERE rn = 1)"""

# Generic dedupe: latest ProcessedTimestamp, then every other column, all descending.
DEDUP_GENERIC = """dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY ProductID ORDER BY ProcessedTimestamp DESC NULLS LAST,
           ProductName DESC NULLS LAST, Category DESC NULLS LAST, Price DESC NULLS LAST,
           Rating DESC NULLS LAST, NumReviews DESC NULLS LAST, StockQuantity DESC NULLS LAST,
           Sales DESC NULLS LAST, Discount DESC NULLS LAST, DateAdded DESC NULLS LAST,
           City DESC NULLS LAST, StockStatus DESC NULLS LAST) AS rn
    FROM bronze) WHERE rn = 1)"""

SILVER_CTE = """typed AS (
  SELECT *, TRY_CAST(Price AS FLOAT) AS pf, TRY_CAST(Rating AS FLOAT) AS rf,
         TRY_CAST(DateAdded AS DATE) AS d
  FROM dedup),
silver AS (
  SELECT ProductID,
         trim(ProductName) AS ProductName,
         upper(trim(Category)) AS Category,
         CAST(CASE WHEN pf < 0 THEN NULL WHEN pf > 500 THEN NULL
              ELSE round(CAST(CAST(CAST(pf AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), 2) END AS FLOAT) AS Price,
         CAST(CASE WHEN rf < 1.0 THEN NULL WHEN rf > 5.0 THEN NULL ELSE rf END AS FLOAT) AS Rating,
         CAST(CASE WHEN NumReviews < 0 THEN 0 WHEN NumReviews > 5000 THEN NULL ELSE NumReviews END AS INTEGER) AS NumReviews,
         CAST(CASE WHEN StockQuantity < 0 THEN 0 WHEN StockQuantity > 1000 THEN NULL ELSE StockQuantity END AS INTEGER) AS StockQuantity,
         CASE WHEN Sales < 0 THEN 0.0 WHEN Sales <= 1.0 THEN Sales * 1000 ELSE Sales END AS Sales,
         CAST(CASE WHEN Discount > 100 THEN Discount / 100 WHEN Discount < 0 THEN 0
                   WHEN Discount > 50 THEN 50 ELSE Discount END AS DOUBLE) AS Discount,
         d AS DateAdded,
         trim(regexp_replace(City, '[^a-zA-Z\\s]', '', 'g')) AS City,
         StockStatus,
         ProcessedTimestamp,
         CAST(year(d) AS INTEGER) AS Year,
         CAST(month(d) AS INTEGER) AS Month
  FROM typed)"""


def with_silver(category: str = "p_type") -> str:
    return "WITH " + ",\n".join([bronze_cte(category), DEDUP_FIXTURE, SILVER_CTE])


def sround(expr: str, digits: int) -> str:
    """Spark's round of a double: HALF_UP on the shortest decimal text of the value."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def exact_avg_round(col: str, scale: int, where: str = "", digits: int = 2) -> str:
    """round(avg(col), digits) HALF_UP over an exact sum of col in units of 10^-scale
    (Spark's DECIMAL average), with integer arithmetic only."""
    f = f" FILTER (WHERE {where})" if where else ""
    total = f"sum(CAST(round({col} * {10 ** scale}) AS HUGEINT)){f}"
    n = f"count({col}){f}"
    unit = 10 ** (scale - digits)
    return (f"CASE WHEN {n} = 0 THEN NULL ELSE CAST(sign({total}) * ((2 * abs({total}) + {n} * {unit}) // "
            f"({n} * {2 * unit})) AS DOUBLE) / {10 ** digits} END")


STATS_CTE = """stats AS (
  SELECT Category,
         sum(""" + sround("Price * Sales * (1.0 - Discount / 100)", 2) + """) AS s_rev,
         sum(""" + sround("Price * Sales", 2) + """) AS s_full,
         sum(Sales) AS s_sales,
         sum(coalesce(Sales, 0.0)) AS s_sales_nz,
         avg(Price) AS a_price,
         count(*) AS n,
         """ + exact_avg_round("Discount", 4) + """ AS r_disc,
         """ + exact_avg_round("Sales", 6) + """ AS r_sales,
         """ + exact_avg_round("Sales", 6, "Discount = 0") + """ AS r_sales_nd,
         CASE WHEN isnan(corr(Price, Rating)) THEN NULL ELSE corr(Price, Rating) END AS c_pr,
         avg(Rating) AS a_rating,
         avg(NumReviews) AS a_reviews,
         CAST(sum(NumReviews) AS BIGINT) AS s_reviews,
         count(*) FILTER (WHERE Rating >= 4.0) AS n_high
  FROM silver GROUP BY Category)"""

GOLD_SELECT = {
    "revenue_per_category": f"""SELECT Category, {sround("s_rev", 2)} AS TotalRevenue, s_sales AS TotalSales,
       {sround("a_price", 2)} AS AveragePrice, n AS ProductCount, r_disc AS AvgDiscountPercentage
FROM stats""",
    "discount_impact": f"""SELECT Category, r_disc AS AvgDiscountPercentage, s_sales AS TotalSales,
       r_sales AS AvgSalesWithDiscount, r_sales_nd AS AvgSalesWithoutDiscount,
       CASE WHEN r_sales_nd > 0
            THEN {sround("(r_sales - r_sales_nd) / r_sales_nd * 100", 2)}
            ELSE 0.0 END AS DiscountImpactPercentage
FROM stats""",
    "discount_effectiveness": f"""SELECT Category, r_disc AS AvgDiscountPercentage,
       {sround("s_rev", 2)} AS TotalDiscountedRevenue, {sround("s_full", 2)} AS PotentialRevenue,
       r_sales AS AvgSales, {sround(sround("s_full", 2) + " - " + sround("s_rev", 2), 2)} AS RevenueLossFromDiscount,
       CASE WHEN {sround(sround("s_full", 2) + " - " + sround("s_rev", 2), 2)} > 0
            THEN {sround(sround("s_rev", 2) + " / " + sround(sround("s_full", 2) + " - " + sround("s_rev", 2), 2), 3)}
            ELSE 0.0 END AS DiscountROI
FROM stats""",
    "price_rating_correlation": f"""SELECT Category, {sround("c_pr", 3)} AS PriceRatingCorrelation,
       {sround("a_price", 2)} AS AvgPrice, {sround("a_rating", 2)} AS AvgRating, {sround("a_reviews", 0)} AS AvgReviews,
       CASE WHEN {sround("c_pr", 3)} > 0.3 THEN 'Strong Positive'
            WHEN {sround("c_pr", 3)} < -0.3 THEN 'Strong Negative' ELSE 'Weak' END AS PriceRatingRelationship
FROM stats""",
    "review_sales_ratio": f"""SELECT Category, s_reviews AS TotalReviews, s_sales_nz AS TotalSales,
       {sround("a_rating", 2)} AS AvgRating, n_high AS HighRatingCount,
       CASE WHEN s_sales_nz > 0 THEN {sround("s_reviews / s_sales_nz", 4)} ELSE 0.0 END AS ReviewToSalesRatio,
       CASE WHEN (CASE WHEN s_sales_nz > 0 THEN {sround("s_reviews / s_sales_nz", 4)} ELSE 0.0 END) > 0.5 THEN 'High'
            WHEN (CASE WHEN s_sales_nz > 0 THEN {sround("s_reviews / s_sales_nz", 4)} ELSE 0.0 END) > 0.2 THEN 'Medium'
            ELSE 'Low' END AS CustomerEngagementLevel
FROM stats""",
    "price_satisfaction": f"""SELECT PriceRange, Category, {sround("avg(Rating)", 2)} AS AvgRating,
       {sround("avg(Price)", 2)} AS AvgPrice, sum(coalesce(Sales, 0.0)) AS TotalSales,
       count(*) AS ProductCount, {sround("avg(NumReviews)", 0)} AS AvgReviews
FROM (SELECT *, CASE WHEN Price < m * 0.5 THEN 'Budget' WHEN Price < m * 1.0 THEN 'Economy'
                     WHEN Price < m * 1.5 THEN 'Premium' ELSE 'Luxury' END AS PriceRange
      FROM silver, (SELECT avg(Price) AS m FROM silver))
GROUP BY PriceRange, Category""",
}


GOLD_COLUMNS = {
    "revenue_per_category": {"Category": "text", "TotalRevenue": "double", "TotalSales": "double", "AveragePrice": "double",
                             "ProductCount": "int", "AvgDiscountPercentage": "double"},
    "discount_impact": {"Category": "text", "AvgDiscountPercentage": "double", "TotalSales": "double", "AvgSalesWithDiscount": "double",
                        "AvgSalesWithoutDiscount": "double", "DiscountImpactPercentage": "double"},
    "discount_effectiveness": {"Category": "text", "AvgDiscountPercentage": "double", "TotalDiscountedRevenue": "double",
                               "PotentialRevenue": "double", "AvgSales": "double", "RevenueLossFromDiscount": "double", "DiscountROI": "double"},
    "price_rating_correlation": {"Category": "text", "PriceRatingCorrelation": "double", "AvgPrice": "double", "AvgRating": "double",
                                 "AvgReviews": "double", "PriceRatingRelationship": "text"},
    "price_satisfaction": {"PriceRange": "text", "Category": "text", "AvgRating": "double", "AvgPrice": "double", "TotalSales": "double",
                           "ProductCount": "int", "AvgReviews": "double"},
    "review_sales_ratio": {"Category": "text", "TotalReviews": "int", "TotalSales": "double", "AvgRating": "double", "HighRatingCount": "int",
                           "ReviewToSalesRatio": "double", "CustomerEngagementLevel": "text"},
}


def row_text(name: str) -> str:
    """The canonical text of a gold row (see ``fingerprint.canonical_text``)."""
    texts = [f"coalesce(CAST({c if kind != 'double' else f'CAST({c} AS DECIMAL(38,6))'} AS VARCHAR), '~')"
             for c, kind in sorted(GOLD_COLUMNS[name].items())]
    return "concat_ws('|', " + ", ".join(texts) + ")"


def gold_sql(name: str, category: str = "p_type") -> str:
    if name == "price_satisfaction":
        return with_silver(category) + "\n" + GOLD_SELECT[name]
    return with_silver(category) + ",\n" + STATS_CTE + "\n" + GOLD_SELECT[name]


def gold_cte(names=("revenue_per_category", "discount_effectiveness", "price_rating_correlation",
                    "review_sales_ratio"), category: str = "p_type") -> str:
    """WITH ... silver, stats, g_<name> AS (...) for several gold tables at once."""
    parts = [bronze_cte(category), DEDUP_FIXTURE, SILVER_CTE, STATS_CTE]
    parts += [f"g_{n} AS ({GOLD_SELECT[n]})" for n in names]
    return "WITH " + ",\n".join(parts)


SILVER_COLUMNS = ["ProductID", "ProductName", "Category", "Price", "Rating", "NumReviews", "StockQuantity",
                  "Sales", "Discount", "DateAdded", "City", "StockStatus", "ProcessedTimestamp", "Year", "Month"]


def div(a: str, b: str) -> str:
    """NULL on a zero divisor, like Spark's try_divide."""
    return f"CASE WHEN ({b}) = 0 THEN NULL ELSE CAST({a} AS DOUBLE) / ({b}) END"


JOINED_COLUMNS = """r.Category, r.TotalRevenue, r.TotalSales, r.AveragePrice, r.ProductCount, r.AvgDiscountPercentage,
    d.AvgDiscountPercentage AS AvgDiscountPercentage_disc, d.TotalDiscountedRevenue, d.PotentialRevenue, d.AvgSales,
    d.RevenueLossFromDiscount, d.DiscountROI,
    p.PriceRatingCorrelation, p.AvgPrice, p.AvgRating, p.AvgReviews, p.PriceRatingRelationship,
    v.TotalReviews, v.TotalSales AS TotalSales_review, v.AvgRating AS AvgRating_review, v.HighRatingCount,
    v.ReviewToSalesRatio, v.CustomerEngagementLevel"""

NUMERIC_JOINED = ["TotalRevenue", "TotalSales", "AveragePrice", "ProductCount", "AvgDiscountPercentage",
                  "AvgDiscountPercentage_disc", "TotalDiscountedRevenue", "PotentialRevenue", "AvgSales",
                  "RevenueLossFromDiscount", "DiscountROI", "PriceRatingCorrelation", "AvgPrice", "AvgRating",
                  "AvgReviews", "TotalReviews", "TotalSales_review", "AvgRating_review", "HighRatingCount",
                  "ReviewToSalesRatio"]
TEXT_JOINED = ["PriceRatingRelationship", "CustomerEngagementLevel"]


def features_cte(category: str = "p_brand") -> str:
    filled = ", ".join(f"coalesce({c}, 0) AS {c}" for c in NUMERIC_JOINED)
    return gold_cte(category=category) + f""",
joined AS (
  SELECT {JOINED_COLUMNS}
  FROM g_revenue_per_category r
  JOIN g_discount_effectiveness d ON r.Category IS NOT DISTINCT FROM d.Category
  JOIN g_price_rating_correlation p ON r.Category IS NOT DISTINCT FROM p.Category
  JOIN g_review_sales_ratio v ON r.Category IS NOT DISTINCT FROM v.Category),
filled AS (SELECT Category, {filled}, {", ".join(TEXT_JOINED)} FROM joined),
gstats AS (
  SELECT avg(AveragePrice) AS m_ap, stddev_samp(AveragePrice) AS s_ap,
         avg(TotalRevenue) AS m_tr, stddev_samp(TotalRevenue) AS s_tr,
         avg(TotalSales) AS m_ts, stddev_samp(TotalSales) AS s_ts,
         quantile_cont(AveragePrice, [0.2, 0.4, 0.6000000000000001, 0.8]) AS q_ap,
         quantile_cont(greatest(DiscountROI, 0.0), [0.3333333333333333, 0.6666666666666666]) AS q_roi
  FROM filled),
base AS (
  SELECT *, {div("TotalReviews", "CASE WHEN TotalSales = 0 THEN 1 ELSE TotalSales END")} AS rps,
         {div("HighRatingCount", "CASE WHEN ProductCount = 0 THEN 1 ELSE ProductCount END")} AS hrr,
         {div("TotalDiscountedRevenue", "PotentialRevenue")} AS eff,
         greatest(DiscountROI, 0.0) AS roi
  FROM filled, gstats),
feats AS (
  SELECT *,
    {div("AveragePrice", "m_ap")} AS PriceToAvgRatio,
    {div("abs(AveragePrice - m_ap)", "s_ap")} AS PriceVariance,
    CASE WHEN AveragePrice IS NULL THEN NULL WHEN AveragePrice <= q_ap[1] THEN 'VeryLow'
         WHEN AveragePrice <= q_ap[2] THEN 'Low' WHEN AveragePrice <= q_ap[3] THEN 'Medium'
         WHEN AveragePrice <= q_ap[4] THEN 'High' ELSE 'VeryHigh' END AS PriceCategory,
    CASE WHEN RevenueLossFromDiscount > 0 THEN {div("TotalDiscountedRevenue", "RevenueLossFromDiscount")}
         ELSE 0.0 END AS DiscountEfficiency,
    CASE WHEN roi IS NULL THEN NULL WHEN roi <= q_roi[1] THEN 'Low' WHEN roi <= q_roi[2] THEN 'Medium'
         ELSE 'High' END AS DiscountROICategory,
    eff AS DiscountEffectiveness,
    rps AS ReviewsPerSale,
    hrr AS HighRatingRatio,
    rps * hrr * AvgRating AS EngagementScore,
    {div("AvgRating * hrr", "eff + 1")} AS CustomerSatisfaction,
    {div("TotalRevenue", "ProductCount")} AS RevenuePerProduct,
    {div("TotalSales", "ProductCount * AvgDiscountPercentage + 1")} AS SalesEfficiency,
    AveragePrice * AvgRating AS PriceRatingInteraction,
    AvgDiscountPercentage * AvgRating AS DiscountRatingInteraction,
    AveragePrice * AvgDiscountPercentage AS PriceDiscountInteraction,
    {div("TotalRevenue", "ProductCount * AveragePrice")} AS MarketPerformance,
    {div("TotalReviews * AvgRating", "TotalSales")} AS CustomerEngagementIndex,
    TotalRevenue * (1 - AvgDiscountPercentage / 100) AS ProfitabilityScore,
    {div("TotalRevenue - m_tr", "s_tr")} AS Normalized_TotalRevenue,
    {div("TotalSales - m_ts", "s_ts")} AS Normalized_TotalSales,
    {div("AveragePrice - m_ap", "s_ap")} AS Normalized_AveragePrice
  FROM base)"""
