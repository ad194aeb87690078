"""DuckDB SQL for each registered query name (see ``catalog.QUERIES``)."""

from __future__ import annotations

from .. import schema as S
from . import oracle as O

_BRONZE = "WITH " + O.bronze_cte(tie_break=False) + "\nSELECT * FROM bronze"
_DEDUP = "WITH " + O.bronze_cte() + ",\n" + O.DEDUP_FIXTURE + "\nSELECT * FROM dedup"
_SILVER = O.with_silver() + "\nSELECT * FROM silver"
_SCALED = O.with_silver() + """,
sd AS (SELECT stddev_samp(CAST(Price AS DOUBLE)) AS s1, stddev_samp(CAST(Rating AS DOUBLE)) AS s2,
              stddev_samp(CAST(NumReviews AS DOUBLE)) AS s3, stddev_samp(CAST(StockQuantity AS DOUBLE)) AS s4,
              stddev_samp(Sales) AS s5 FROM silver)
SELECT ProductID,
  CASE WHEN Price IS NULL THEN NULL WHEN coalesce(s1, 0) = 0 THEN 0.0 ELSE CAST(Price AS DOUBLE) / s1 END AS scaled_Price,
  CASE WHEN Rating IS NULL THEN NULL WHEN coalesce(s2, 0) = 0 THEN 0.0 ELSE CAST(Rating AS DOUBLE) / s2 END AS scaled_Rating,
  CASE WHEN NumReviews IS NULL THEN NULL WHEN coalesce(s3, 0) = 0 THEN 0.0 ELSE CAST(NumReviews AS DOUBLE) / s3 END AS scaled_NumReviews,
  CASE WHEN StockQuantity IS NULL THEN NULL WHEN coalesce(s4, 0) = 0 THEN 0.0 ELSE CAST(StockQuantity AS DOUBLE) / s4 END AS scaled_StockQuantity,
  CASE WHEN Sales IS NULL THEN NULL WHEN coalesce(s5, 0) = 0 THEN 0.0 ELSE Sales / s5 END AS scaled_Sales
FROM silver, sd"""

_NULLS = O.with_silver() + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS row_count FROM silver"
    for c in O.SILVER_COLUMNS)

_SALES_STATS = O.with_silver() + """
SELECT 'bronze' AS layer, round(avg(Sales), 2) AS avg_sales, min(Sales) AS min_sales, max(Sales) AS max_sales FROM bronze
UNION ALL
SELECT 'silver', round(avg(Sales), 2), min(Sales), max(Sales) FROM silver"""

_SAMPLE = O.with_silver() + "\nSELECT ProductID, Category, Sales, Price, Discount FROM silver ORDER BY ProductID LIMIT 5"

_BRONZE_SAMPLE = ("WITH " + O.bronze_cte(tie_break=False) + "\nSELECT ProductID, Category, Sales, Price, Discount FROM bronze"
                  "\nORDER BY ProductID, Category, Sales, Price, Discount LIMIT 5")

_CATEGORIES = O.with_silver() + "\nSELECT DISTINCT Category FROM silver ORDER BY Category"

LOOKUPS = {
    "lookup_revenue": ("revenue_per_category", "PROMO"),
    "lookup_discount": ("discount_effectiveness", "STANDARD"),
    "lookup_price_rating": ("price_rating_correlation", "LARGE"),
    "lookup_customer_satisfaction": ("review_sales_ratio", "MEDIUM"),
    "lookup_discount_impact": ("discount_impact", "SMALL"),
    "lookup_price_satisfaction": ("price_satisfaction", "ECONOMY"),
}


def _lookup_sql(table: str, category: str) -> str:
    return f"SELECT * FROM ({O.gold_sql(table)}) g WHERE Category = '{category}'"


FEATURE_GROUPS = {
    "features_price": ["PriceToAvgRatio", "PriceVariance", "PriceCategory"],
    "features_discount": ["DiscountEfficiency", "DiscountROICategory", "DiscountEffectiveness"],
    "features_engagement": ["ReviewsPerSale", "HighRatingRatio", "EngagementScore", "CustomerSatisfaction"],
    "features_performance": ["RevenuePerProduct", "SalesEfficiency", "PriceRatingInteraction",
                             "DiscountRatingInteraction", "PriceDiscountInteraction", "MarketPerformance",
                             "CustomerEngagementIndex", "ProfitabilityScore"],
    "features_zscore": ["Normalized_TotalRevenue", "Normalized_TotalSales", "Normalized_AveragePrice"],
}

_FEATURES_JOINED = O.features_cte() + "\nSELECT Category, " + ", ".join(O.NUMERIC_JOINED + O.TEXT_JOINED) + " FROM filled"

_FEATURES_PRODUCT = O.features_cte("CAST(l_partkey AS VARCHAR)") + "\nSELECT Category, PriceToAvgRatio, PriceCategory, DiscountROICategory FROM feats"

_CSV_VALID = "WITH " + O.bronze_cte() + """
SELECT ProductID, ProductName, Category, Price, Rating, NumReviews, StockQuantity, Sales, Discount, DateAdded, City,
       CASE WHEN l_linenumber = 6 THEN false ELSE StockStatus END AS StockStatus
FROM bronze WHERE l_linenumber NOT IN (3, 4, 5)"""

_CSV_QUOTED = _CSV_VALID.replace(
    "SELECT ProductID, ProductName,", "SELECT ProductID, CASE WHEN l_linenumber = 2 THEN concat(ProductName, chr(10), '\"x\", ', chr(10), City) ELSE ProductName END AS ProductName,")

_STREAM_CSV = "WITH " + O.bronze_cte() + """
SELECT ProductID, ProductName, Category, Price, Rating, NumReviews, StockQuantity, Sales, Discount, DateAdded, City,
       CASE WHEN l_linenumber = 6 THEN false ELSE StockStatus END AS StockStatus,
       '2024-01-01T00:00:00' AS ProcessedTimestamp
FROM bronze WHERE l_linenumber NOT IN (3, 4, 5)"""

_CSV_REJECTED = "WITH " + O.bronze_cte() + """
SELECT ProductID, ProductName,
       CASE l_linenumber WHEN 5 THEN 'Price' WHEN 3 THEN 'Discount' ELSE 'field_count' END AS RejectReason
FROM bronze WHERE l_linenumber IN (3, 4, 5)"""

# The stream's bronze has no tie-break columns: the generic dedupe order applies.
_STREAM_REVENUE = ("WITH " + ",\n".join([O.bronze_cte(tie_break=False), O.DEDUP_GENERIC, O.SILVER_CTE, O.STATS_CTE])
                   + "\n" + O.GOLD_SELECT["revenue_per_category"])

_CHANGES = O.gold_cte(names=("revenue_per_category", "discount_impact", "review_sales_ratio", "price_rating_correlation")) + ",\n" + ",\n".join([
    O.bronze_cte("p_brand").replace("bronze AS", "bronze_b AS", 1),
    O.DEDUP_FIXTURE.replace("dedup AS", "dedup_b AS", 1).replace("FROM bronze)", "FROM bronze_b)"),
    O.SILVER_CTE.replace("typed AS", "typed_b AS", 1).replace("FROM dedup)", "FROM dedup_b)")
        .replace("silver AS", "silver_b AS", 1).replace("FROM typed)", "FROM typed_b)"),
    O.STATS_CTE.replace("stats AS", "stats_b AS", 1).replace("FROM silver GROUP", "FROM silver_b GROUP"),
    "g_di_b AS (" + O.GOLD_SELECT["discount_impact"].replace("FROM stats", "FROM stats_b") + ")",
    *[f"p_{state} AS (" + "\n  UNION ALL ".join(f"SELECT '{t}' AS table_name, md5({O.row_text(t)}) AS h FROM {src}" for t, src in tables) + ")"
      for state, tables in {
          "old": [("revenue_per_category", "g_revenue_per_category"), ("discount_impact", "g_discount_impact"),
                  ("review_sales_ratio", "g_review_sales_ratio")],
          "new": [("revenue_per_category", "g_revenue_per_category"), ("discount_impact", "g_di_b"),
                  ("price_rating_correlation", "g_price_rating_correlation")]}.items()],
    *[f"f_{state} AS (SELECT table_name, list(h ORDER BY h) AS content FROM p_{state} GROUP BY table_name)" for state in ("old", "new")]]) + """
SELECT coalesce(n.table_name, o.table_name) AS table_name,
       CASE WHEN o.table_name IS NULL THEN 'new' WHEN n.table_name IS NULL THEN 'gone'
            WHEN o.content = n.content THEN 'unchanged' ELSE 'changed' END AS status
FROM f_old o FULL JOIN f_new n ON o.table_name = n.table_name"""

_FINGERPRINT = O.gold_cte(names=O.GOLD_COLUMNS) + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, count(*) AS "rows",
       CAST(coalesce(sum(CAST(CAST('0x' || substr(md5({O.row_text(t)}), 1, 15) AS BIGINT) AS HUGEINT)), 0) AS VARCHAR) AS hash
FROM g_{t}""" for t in O.GOLD_COLUMNS)


def _cells(ctes: str) -> str:
    """The six gold tables in the long form of ``catalog.gold_cells``."""
    out = []
    for t, columns in O.GOLD_COLUMNS.items():
        key = "PriceRange || '/' || Category" if "PriceRange" in columns else "Category"
        for c, kind in columns.items():
            if c not in ("PriceRange", "Category"):
                number, label = (f"CAST({c} AS DOUBLE)", "CAST(NULL AS VARCHAR)") if kind != "text" else ("CAST(NULL AS DOUBLE)", c)
                out.append(f"SELECT '{t}' AS table_name, {key} AS key, '{c}' AS column_name, {number} AS number, {label} AS label FROM g_{t}")
    return ctes + "\n" + "\nUNION ALL\n".join(out)


_GOLD_ALL = _cells(O.gold_cte(names=O.GOLD_COLUMNS))
_STREAM_GOLD_ALL = _cells("WITH " + ",\n".join([O.bronze_cte(tie_break=False), O.DEDUP_GENERIC, O.SILVER_CTE, O.STATS_CTE,
                                               *(f"g_{t} AS ({O.GOLD_SELECT[t]})" for t in O.GOLD_COLUMNS)]))

_STREAM_CTES = "WITH " + ",\n".join([O.bronze_cte(tie_break=False), O.DEDUP_GENERIC, O.SILVER_CTE])
_STREAM_SILVER = _STREAM_CTES + "\nSELECT * FROM silver"
_STREAM_SCALED = _STREAM_CTES + _SCALED[len(O.with_silver()):]

# Silver of the first batch alone beside the whole one: where the products of the second batch were, and where they are.
_STREAM_TOUCHED = _STREAM_CTES + ",\n" + ",\n".join([
    "bronze_1 AS (SELECT * FROM bronze WHERE ProcessedTimestamp < '1998-10-01')",
    O.DEDUP_GENERIC.replace("dedup AS", "dedup_1 AS", 1).replace("FROM bronze)", "FROM bronze_1)"),
    O.SILVER_CTE.replace("typed AS", "typed_1 AS", 1).replace("FROM dedup)", "FROM dedup_1)")
        .replace("silver AS", "silver_1 AS", 1).replace("FROM typed)", "FROM typed_1)")]) + """,
ids AS (SELECT DISTINCT ProductID FROM bronze WHERE ProcessedTimestamp >= '1998-10-01'),
touched AS (
  SELECT Year, Month FROM silver_1 WHERE ProductID IN (SELECT ProductID FROM ids)
  UNION SELECT Year, Month FROM silver WHERE ProductID IN (SELECT ProductID FROM ids))
SELECT t.Year, t.Month, count(s.ProductID) AS "rows"
FROM touched t LEFT JOIN silver s ON t.Year IS NOT DISTINCT FROM s.Year AND t.Month IS NOT DISTINCT FROM s.Month
GROUP BY t.Year, t.Month"""

_JSON_REJECTED = """
SELECT CASE l_linenumber WHEN 3 THEN '{"ProductName":"' || l_orderkey || '-' || l_linenumber
            ELSE '{"ProductID":"' || l_orderkey || '-' || l_linenumber || '"}' END AS value, 'message' AS RejectReason
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE l_linenumber IN (3, 4)"""

_SILVER_VECTORS = O.with_silver() + """,
sd AS (SELECT stddev_samp(CAST(Price AS DOUBLE)) AS s0, stddev_samp(CAST(Rating AS DOUBLE)) AS s1, stddev_samp(CAST(NumReviews AS DOUBLE)) AS s2,
              stddev_samp(CAST(StockQuantity AS DOUBLE)) AS s3, stddev_samp(Sales) AS s4 FROM silver)
""" + "\nUNION ALL\n".join(
    f"""SELECT ProductID, {i} AS slot, CAST({c} AS DOUBLE) AS feature,
       CASE WHEN {c} IS NULL THEN NULL WHEN coalesce(s{i}, 0) = 0 THEN 0.0 ELSE CAST({c} AS DOUBLE) / s{i} END AS scaled
FROM silver, sd""" for i, c in enumerate(["Price", "Rating", "NumReviews", "StockQuantity", "Sales"]))

_ROWS_STORED = "WITH " + O.bronze_cte() + "\nSELECT count(*) AS \"rows\" FROM bronze GROUP BY l_linenumber % 2"


def _bucket(seed: int, buckets: int) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || coalesce(Category, '~')), 1, 8) AS BIGINT) % {buckets}"


_SPLIT = O.with_silver("p_brand") + f"""
SELECT DISTINCT Category, CASE WHEN {_bucket(42, 100)} < 80 THEN 'train' ELSE 'test' END AS part,
       CAST({_bucket(43, 5)} AS INTEGER) AS fold FROM silver"""

_YJ = O.features_cte() + """,
lf AS (""" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x FROM feats WHERE {c} IS NOT NULL" for c in S.NUMERIC_FEATURES) + """),
fin AS (SELECT * FROM lf WHERE NOT isnan(x)),
facts AS (SELECT column_name, count(*) AS n, sum(sign(x) * ln(1 + abs(x))) AS s,
            max(ln(1 + x)) FILTER (x >= 0) AS hp, min(ln(1 + x)) FILTER (x >= 0) AS lp,
            max(ln(1 - x)) FILTER (x < 0) AS hn, min(ln(1 - x)) FILTER (x < 0) AS ln_ FROM fin GROUP BY column_name),
grid AS (SELECT round(CAST(-64.0 AS DOUBLE) + i * CAST(0.005 AS DOUBLE), 3) AS lam FROM range(0, 25601) t(i)),
scaled AS (SELECT *, CASE WHEN hn IS NULL THEN greatest(lam * hp, lam * lp) WHEN hp IS NULL THEN greatest((2 - lam) * hn, (2 - lam) * ln_)
                     ELSE greatest(0.0, lam * hp, lam * lp, (2 - lam) * hn, (2 - lam) * ln_) END AS m FROM facts, grid
             WHERE hp > lp OR hn > ln_ OR (hp IS NOT NULL AND hn IS NOT NULL)),
yj AS (SELECT column_name, lam, n, s, m,
         CASE WHEN x >= 0 THEN (CASE WHEN abs(lam) < 1e-12 THEN ln(1 + x) * exp(-m)
                                     ELSE (exp(lam * ln(1 + x) - m) - CASE WHEN hn IS NULL THEN 0.0 ELSE exp(-m) END) / lam END)
              ELSE (CASE WHEN abs(lam - 2) < 1e-12 THEN -ln(1 - x) * exp(-m)
                         ELSE -(exp((2 - lam) * ln(1 - x) - m) - CASE WHEN hp IS NULL THEN 0.0 ELSE exp(-m) END) / (2 - lam) END)
         END AS y
       FROM fin JOIN scaled USING (column_name)),
ll AS (SELECT column_name, lam, var_pop(y) AS v, any_value(n) AS n, any_value(s) AS s, any_value(m) AS m FROM yj GROUP BY column_name, lam),
scored AS (SELECT column_name, lam, -n / 2 * (ln(v) + 2 * m) + (lam - 1) * s AS llf FROM ll WHERE v > 0)
SELECT column_name, lam AS "lambda", abs(lam) >= 64 AS at_bound FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY llf DESC, lam ASC) AS rn FROM scored)
WHERE rn = 1"""

_REQUESTS = "WITH " + O.bronze_cte() + ",\n" + O.DEDUP_FIXTURE + """,
req AS (SELECT CAST(ProductID AS BIGINT) AS request_id, Price AS price, CAST(Discount AS DOUBLE) AS discount_percentage,
               Rating AS rating, NumReviews AS num_reviews, upper(trim(Category)) AS category FROM dedup),
tagged AS (SELECT *, CASE WHEN NOT coalesce(price > 0, false) THEN 'price'
                          WHEN NOT coalesce(discount_percentage >= 0 AND discount_percentage <= 100, false) THEN 'discount_percentage'
                          WHEN NOT coalesce(rating >= 1 AND rating <= 5, false) THEN 'rating'
                          WHEN NOT coalesce(num_reviews >= 0, false) THEN 'num_reviews'
                          WHEN category IS NULL THEN 'category' END AS RejectReason FROM req)"""

_REQUESTS_VALID = _REQUESTS + "\nSELECT * EXCLUDE (RejectReason) FROM tagged WHERE RejectReason IS NULL"
_REQUESTS_REJECTED = _REQUESTS + "\nSELECT * FROM tagged WHERE RejectReason IS NOT NULL"
_REQUEST_FEATURES = _REQUESTS + """
SELECT request_id, price AS AveragePrice, discount_percentage AS AvgDiscountPercentage, rating AS AvgRating,
  CAST(num_reviews AS DOUBLE) AS AvgReviews, category AS Category, CAST(1.0 AS DOUBLE) AS PriceToAvgRatio, CAST(0.0 AS DOUBLE) AS PriceVariance,
  discount_percentage / 100 AS DiscountEfficiency, 1 - discount_percentage / 100 AS DiscountEffectiveness,
  num_reviews / 100 AS ReviewsPerSale, CASE WHEN rating >= 4.0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS HighRatingRatio,
  rating * (num_reviews / 100) AS EngagementScore, rating * (1 - discount_percentage / 100) AS CustomerSatisfaction,
  price * (1 - discount_percentage / 100) AS RevenuePerProduct, CAST(1.0 AS DOUBLE) AS SalesEfficiency,
  price * rating AS PriceRatingInteraction, discount_percentage * rating AS DiscountRatingInteraction,
  price * discount_percentage AS PriceDiscountInteraction, CAST(1.0 AS DOUBLE) AS MarketPerformance,
  num_reviews * rating AS CustomerEngagementIndex, price * (1 - discount_percentage / 100) AS ProfitabilityScore,
  CAST(0.0 AS DOUBLE) AS Normalized_TotalRevenue, CAST(0.0 AS DOUBLE) AS Normalized_TotalSales, CAST(0.0 AS DOUBLE) AS Normalized_AveragePrice,
  CASE WHEN price <= 100 THEN 'VeryLow' WHEN price <= 200 THEN 'Low' WHEN price <= 300 THEN 'Medium'
       WHEN price <= 400 THEN 'High' ELSE 'VeryHigh' END AS PriceCategory,
  'Medium' AS DiscountROICategory
FROM tagged WHERE RejectReason IS NULL"""

_METRICS = O.with_silver() + """,
scored AS (SELECT s.Sales AS y, m.baseline AS p FROM silver s
           JOIN (SELECT Category, avg(Sales) AS baseline FROM silver GROUP BY Category) m
             ON s.Category IS NOT DISTINCT FROM m.Category
           WHERE s.Sales IS NOT NULL AND m.baseline IS NOT NULL),
ybar AS (SELECT avg(y) AS yb FROM scored),
a AS (SELECT count(*) AS n, sum((y - p) * (y - p)) AS sse, sum((y - yb) * (y - yb)) AS sst, avg(abs(y - p)) AS mae
      FROM scored, ybar)
SELECT 1.0 - sse / sst AS r2, sse / n AS mse, sqrt(sse / n) AS rmse, mae, n FROM a"""

_ONE_HOT = O.features_cte() + """
SELECT Category,
  CAST(dense_rank() OVER (ORDER BY Category) - 1 AS INTEGER) AS Category_idx,
  CAST(dense_rank() OVER (ORDER BY PriceCategory) - 1 AS INTEGER) AS PriceCategory_idx,
  CAST(dense_rank() OVER (ORDER BY DiscountROICategory) - 1 AS INTEGER) AS DiscountROICategory_idx
FROM feats"""

_ONE_HOT_SLOTS = O.features_cte() + "\n" + "\nUNION ALL\n".join(f"""
SELECT f.Category, '{c}' AS feature, CAST(v.slot AS INTEGER) AS slot, CASE WHEN f.{c} = v.x THEN 1.0 ELSE 0.0 END::DOUBLE AS value
FROM feats f, (SELECT x, row_number() OVER (ORDER BY x) - 1 AS slot FROM (SELECT DISTINCT {c} AS x FROM feats WHERE {c} IS NOT NULL)) v"""
                                                                for c in ("Category", "PriceCategory", "DiscountROICategory"))

_SCORE_KEYS = _REQUESTS + """
SELECT request_id, count(*) AS predictions, true AS finite, CAST(1 AS BIGINT) AS confidences
FROM tagged WHERE RejectReason IS NULL GROUP BY request_id"""

ORACLE: dict[str, str] = {
    "ingest_json_rejected": _JSON_REJECTED,
    "stream_two_sources": _BRONZE,
    "stream_two_sources_gold_full": _STREAM_GOLD_ALL,
    "stream_two_sources_gold_incremental": _STREAM_GOLD_ALL,
    "stream_rows_stored": _ROWS_STORED,
    "stream_csv_rejected": _CSV_REJECTED,
    "table_gold_roundtrip_all": _GOLD_ALL,
    "table_silver_vectors": _SILVER_VECTORS,
    "table_fingerprint": _FINGERPRINT,
    "lookup_strict": _lookup_sql("revenue_per_category", "PROMO"),
    "ml_split": _SPLIT,
    "ml_one_hot_slots": _ONE_HOT_SLOTS,
    "ml_score_keys": _SCORE_KEYS,
    "bronze_products": _BRONZE,
    "silver_dedupe": _DEDUP,
    "silver_products": _SILVER,
    "silver_scaled": _SCALED,
    **{f"gold_{n}": O.gold_sql(n) for n in O.GOLD_SELECT},
    "ingest_csv_valid": _CSV_VALID,
    "ingest_csv_rejected": _CSV_REJECTED,
    "ingest_csv_quoted": _CSV_QUOTED,
    "ingest_json_roundtrip": _BRONZE,
    "stream_bronze_append": _BRONZE,
    "stream_gold_refresh": _STREAM_REVENUE,
    "stream_gold_incremental": _STREAM_REVENUE,
    "stream_silver_incremental": _STREAM_SILVER,
    "stream_silver_touched": _STREAM_TOUCHED,
    "stream_silver_scaled": _STREAM_SCALED,
    "stream_gold_partials": _STREAM_GOLD_ALL,
    "stream_csv_bronze": _STREAM_CSV,
    "table_silver_roundtrip": _SILVER,
    "table_gold_roundtrip": O.gold_sql("revenue_per_category"),
    "table_changes": _CHANGES,
    "profile_nulls": _NULLS,
    "profile_sales_stats": _SALES_STATS,
    "profile_sample": _SAMPLE,
    "profile_bronze_sample": _BRONZE_SAMPLE,
    "lookup_categories": _CATEGORIES,
    **{name: _lookup_sql(t, c) for name, (t, c) in LOOKUPS.items()},
    "features_joined": _FEATURES_JOINED,
    "features_product_grain": _FEATURES_PRODUCT,
    "ml_yeo_johnson_lambda": _YJ,
    "ml_requests_valid": _REQUESTS_VALID,
    "ml_requests_rejected": _REQUESTS_REJECTED,
    "ml_request_features": _REQUEST_FEATURES,
    "ml_regression_metrics": _METRICS,
    "ml_one_hot": _ONE_HOT,
    **{name: O.features_cte() + "\nSELECT Category, " + ", ".join(cols) + " FROM feats"
       for name, cols in FEATURE_GROUPS.items()},
}
