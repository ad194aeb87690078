"""Table schemas and the fixed rule constants of the product tables."""

from pyspark.sql import types as T

BRONZE_SCHEMA = T.StructType([
    T.StructField("ProductID", T.IntegerType(), True),
    T.StructField("ProductName", T.StringType(), True),
    T.StructField("Category", T.StringType(), True),
    T.StructField("Price", T.DoubleType(), True),
    T.StructField("Rating", T.DoubleType(), True),
    T.StructField("NumReviews", T.IntegerType(), True),
    T.StructField("StockQuantity", T.IntegerType(), True),
    T.StructField("Sales", T.DoubleType(), True),
    T.StructField("Discount", T.IntegerType(), True),
    T.StructField("DateAdded", T.StringType(), True),
    T.StructField("City", T.StringType(), True),
    T.StructField("StockStatus", T.BooleanType(), True),
    T.StructField("ProcessedTimestamp", T.StringType(), True),
])

BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]

# The raw CSV has these fields by position; StockStatus (the 12th) may be missing.
CSV_FIELDS = BRONZE_COLUMNS[:12]
CSV_INT_FIELDS = ["ProductID", "NumReviews", "StockQuantity", "Discount"]
CSV_FLOAT_FIELDS = ["Price", "Rating", "Sales"]
CSV_TEXT_FIELDS = ["ProductName", "Category", "DateAdded", "City"]
CSV_MIN_FIELDS = 11

SCALED_COLUMNS = ["Price", "Rating", "NumReviews", "StockQuantity", "Sales"]

GOLD_TABLES = [
    "revenue_per_category",
    "discount_impact",
    "discount_effectiveness",
    "price_rating_correlation",
    "price_satisfaction",
    "review_sales_ratio",
]

# --- Fixed values: these must equal the reference's for identical results. ---
SALES_FLOOR = 0.0            # Sales < 0 -> 0.0
SALES_SMALL_LIMIT = 1.0      # Sales <= 1.0 -> Sales * 1000
SALES_SMALL_FACTOR = 1000
DISCOUNT_FRACTION_LIMIT = 100  # Discount > 100 -> Discount / 100
DISCOUNT_CAP = 50            # Discount > 50 -> 50
PRICE_MIN, PRICE_MAX = 0, 500
RATING_MIN, RATING_MAX = 1.0, 5.0
REVIEWS_MAX = 5000
STOCK_MAX = 1000
CITY_DROP_PATTERN = "[^a-zA-Z\\s]"
CORRELATION_STRONG = 0.3
RELATIONSHIP_LABELS = ("Strong Positive", "Strong Negative", "Weak")
PRICE_RANGE_FACTORS = (0.5, 1.0, 1.5)
PRICE_RANGE_LABELS = ("Budget", "Economy", "Premium", "Luxury")
HIGH_RATING = 4.0
ENGAGEMENT_LIMITS = (0.5, 0.2)
ENGAGEMENT_LABELS = ("High", "Medium", "Low")
PRICE_CATEGORY_LABELS = ("VeryLow", "Low", "Medium", "High", "VeryHigh")
ROI_CATEGORY_LABELS = ("Low", "Medium", "High")
REQUEST_PRICE_BANDS = (100, 200, 300, 400)   # <= each bound -> VeryLow..High, above -> VeryHigh
REQUEST_ROI_CATEGORY = "Medium"
REQUEST_SCALE = 100          # num_reviews / 100 in request features
MIN_RETRAIN_SECONDS = 90
INGEST_BATCH_MESSAGES = 100
NUMERIC_FEATURES = [
    "AveragePrice", "AvgDiscountPercentage", "AvgRating", "AvgReviews",
    "PriceToAvgRatio", "PriceVariance", "DiscountEfficiency",
    "DiscountEffectiveness", "ReviewsPerSale", "HighRatingRatio",
    "EngagementScore", "CustomerSatisfaction", "RevenuePerProduct",
    "SalesEfficiency", "PriceRatingInteraction", "DiscountRatingInteraction",
    "PriceDiscountInteraction", "MarketPerformance",
    "CustomerEngagementIndex", "ProfitabilityScore",
    "Normalized_TotalRevenue", "Normalized_TotalSales", "Normalized_AveragePrice",
]
CATEGORICAL_FEATURES = ["Category", "PriceCategory", "DiscountROICategory"]
# --- end of fixed values ---

TARGET = "TotalSales"
# Features computed from the target or from revenue (which contains it): dropped unless leaky=True.
LEAKY_FEATURES = ["SalesEfficiency", "Normalized_TotalSales", "Normalized_TotalRevenue",
                  "RevenuePerProduct", "MarketPerformance", "ProfitabilityScore",
                  "CustomerEngagementIndex", "ReviewsPerSale", "EngagementScore"]
