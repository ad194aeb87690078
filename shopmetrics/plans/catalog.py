"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole fixture."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S

from ..operators import features as FE
from ..operators import gold as G
from ..operators import lookup as LK
from ..operators import model as ML
from ..operators import profile as PR
from ..operators import silver as SV
from ..operators import fingerprint as FP
from ..sources import fixture as FX
from ..sources import ingest as IN
from ..sources import tables as TB
from ..streaming import stream as ST
from . import incremental as INC
from . import refresh as RF
from . import medallion as MD

Query = Callable[[SparkSession, str], DataFrame]


# Queries name the silver columns that they need: the dedupe then carries no others.
GOLD_ALL = ("Category", *dict.fromkeys(c for needs in G.NEEDS.values() for c in needs))


def bronze(spark: SparkSession, sf_dir: str, category: str = "type", columns=None) -> DataFrame:
    return FX.bronze_from_tpch(spark, sf_dir, category=category, columns=columns)


def silver(spark: SparkSession, sf_dir: str, category: str = "type", columns=None) -> DataFrame:
    made = SV.build_silver(bronze(spark, sf_dir, category, columns), order=FX.DEDUPE_ORDER, drop=FX.TIE_BREAK)
    return made if columns is None else made.select(*[c for c in made.columns if c in columns])


def q_bronze_products(spark, sf_dir):
    return FX.drop_tie_break(bronze(spark, sf_dir))


def q_silver_dedupe(spark, sf_dir):
    return FX.drop_tie_break(SV.latest_per_product(bronze(spark, sf_dir), order=FX.DEDUPE_ORDER))


def q_silver_products(spark, sf_dir):
    return silver(spark, sf_dir)


def q_silver_scaled(spark, sf_dir):
    scaled = SV.scale_columns(silver(spark, sf_dir, columns=("ProductID", *S.SCALED_COLUMNS)))
    return scaled.select("ProductID", *[c for c in scaled.columns if c.startswith("scaled_")])


def _gold(name: str) -> Query:
    def q(spark, sf_dir):
        s = silver(spark, sf_dir, columns=("Category", *G.NEEDS[name]))
        if name == "price_satisfaction":
            return G.price_satisfaction(s)
        return getattr(G, name)(G.category_stats(s))
    q.__name__ = f"q_gold_{name}"
    return q


def q_profile_nulls(spark, sf_dir):
    return PR.null_profile(silver(spark, sf_dir))


def q_profile_sales_stats(spark, sf_dir):
    return PR.sales_stats_once(bronze(spark, sf_dir, columns=["Sales"]), FX.DEDUPE_ORDER, SV.sales_rule)


def q_profile_sample(spark, sf_dir):
    cols = ["ProductID", "Category", "Sales", "Price", "Discount"]
    return PR.sample_rows(silver(spark, sf_dir, columns=cols), cols, n=5, order=["ProductID"])


def q_profile_bronze_sample(spark, sf_dir):
    """Five raw records before cleaning, ordered by every shown column (ties are identical rows)."""
    cols = ["ProductID", "Category", "Sales", "Price", "Discount"]
    return PR.sample_rows(bronze(spark, sf_dir, columns=cols), cols, n=5, order=cols)


def q_lookup_categories(spark, sf_dir):
    s = silver(spark, sf_dir, columns=("Category", *G.NEEDS["revenue_per_category"]))
    return LK.categories(G.revenue_per_category(G.category_stats(s), ordered=False))


# Lookup filters: one category per table, all present in the fixture.
LOOKUPS = {
    "lookup_revenue": ("revenue_per_category", "PROMO"),
    "lookup_discount": ("discount_effectiveness", "STANDARD"),
    "lookup_price_rating": ("price_rating_correlation", "LARGE"),
    "lookup_customer_satisfaction": ("review_sales_ratio", "MEDIUM"),
    "lookup_discount_impact": ("discount_impact", "SMALL"),
    "lookup_price_satisfaction": ("price_satisfaction", "ECONOMY"),
}


def _lookup(table: str, category: str) -> Query:
    def q(spark, sf_dir):
        s = silver(spark, sf_dir, columns=("Category", *G.NEEDS[table]))
        gold = G.price_satisfaction(s, ordered=False) if table == "price_satisfaction" \
            else getattr(G, table)(G.category_stats(s))
        return LK.lookup(gold, category)
    return q


# Features are taken at brand grain (25 categories), as FIXTURES.md asks for the model side.
FEATURE_GROUPS = {
    "features_price": ["PriceToAvgRatio", "PriceVariance", "PriceCategory"],
    "features_discount": ["DiscountEfficiency", "DiscountROICategory", "DiscountEffectiveness"],
    "features_engagement": ["ReviewsPerSale", "HighRatingRatio", "EngagementScore", "CustomerSatisfaction"],
    "features_performance": ["RevenuePerProduct", "SalesEfficiency", "PriceRatingInteraction",
                             "DiscountRatingInteraction", "PriceDiscountInteraction", "MarketPerformance",
                             "CustomerEngagementIndex", "ProfitabilityScore"],
    "features_zscore": ["Normalized_TotalRevenue", "Normalized_TotalSales", "Normalized_AveragePrice"],
}


def features(spark, sf_dir) -> DataFrame:
    return MD.features_from_silver(silver(spark, sf_dir, category="brand", columns=GOLD_ALL))


def q_features_joined(spark, sf_dir):
    s = silver(spark, sf_dir, category="brand", columns=GOLD_ALL)
    stats = MD.materialize(G.category_stats(s))
    joined = FE.join_gold(G.revenue_per_category(stats, ordered=False), G.discount_effectiveness(stats),
                          G.price_rating_correlation(stats), G.review_sales_ratio(stats))
    return FE.fill_numeric_nulls(joined)


def _features(cols: list[str]) -> Query:
    def q(spark, sf_dir):
        return features(spark, sf_dir).select("Category", *cols)
    return q


def q_features_product_grain(spark, sf_dir):
    """The features by quantiles with a row for each product, over edges from counting passes."""
    s = silver(spark, sf_dir, columns=("ProductID", *GOLD_ALL)).withColumn("Category", F.col("ProductID").cast("string"))
    stats = MD.materialize(G.category_stats(s))
    joined = MD.materialize(FE.fill_numeric_nulls(FE.join_gold(
        G.revenue_per_category(stats, ordered=False), G.discount_effectiveness(stats), G.price_rating_correlation(stats), G.review_sales_ratio(stats))))
    return FE.add_features(joined, edges=FE.exact_edges(joined)).select("Category", "PriceToAvgRatio", "PriceCategory", "DiscountROICategory")


#: Rows of a file of messages or CSV lines: it is read by one task (compressed, or with line breaks in quotes), so its size is bounded.
FILE_ROWS = 1_000_000
#: Micro-batches of a stream that refreshes, or reads, everything in each: a fixed number, whatever the tables hold.
MICRO_BATCHES = 3


def _write_lines(lines: DataFrame, path: str, **options) -> None:
    lines.write.option("maxRecordsPerFile", FILE_ROWS).options(**options).text(path)


def _files_per_trigger(spark, path: str, least: int) -> int:
    """``least`` files for each micro-batch, and more where there are more files than ``MICRO_BATCHES`` of that size."""
    return max(least, -(-len(spark.read.text(path).inputFiles()) // MICRO_BATCHES))


def _csv_fixture(spark, sf_dir) -> str:
    """Write the raw CSV fixture (several text files) under the shared folder; return its path."""
    path = TB.shared_dir(spark, "csv", unique=True)
    _write_lines(FX.product_csv_lines(bronze(spark, sf_dir)), path)
    return path


def q_ingest_csv_valid(spark, sf_dir):
    raw = IN.read_product_csv(spark, _csv_fixture(spark, sf_dir), header=False, glob="part-*")
    return IN.products_from_csv(raw)[0]


def q_ingest_csv_rejected(spark, sf_dir):
    raw = IN.read_product_csv(spark, _csv_fixture(spark, sf_dir), header=False, glob="part-*")
    return IN.products_from_csv(raw)[1].select("ProductID", "ProductName", "RejectReason")


def q_ingest_csv_quoted(spark, sf_dir):
    """Valid rows of files whose quoted names hold line breaks, quotes and commas (of the lines numbered 2)."""
    path = TB.shared_dir(spark, "csv", unique=True)
    broken = F.concat("ProductName", F.lit('\n"x", \n'), "City")
    made = bronze(spark, sf_dir).withColumn("ProductName", F.when(F.col("l_linenumber") == 2, broken).otherwise(F.col("ProductName")))
    _write_lines(FX.product_csv_lines(made), path)
    return IN.products_from_csv(IN.read_product_csv(spark, path, header=False, glob="part-*"))[0]


def _messages(spark, sf_dir, where=None) -> str:
    """The fixture's records as compressed JSON messages, in files of at most ``FILE_ROWS``."""
    path = TB.shared_dir(spark, "messages", unique=True)
    records = bronze(spark, sf_dir)
    _write_lines(IN.encode_messages(FX.drop_tie_break(records if where is None else records.where(where))), path, compression="gzip")
    return path


def q_ingest_json_roundtrip(spark, sf_dir):
    return IN.decode_messages(spark.read.text(_messages(spark, sf_dir)))


def q_ingest_json_rejected(spark, sf_dir):
    """Messages of the lines numbered 3 are cut short, those numbered 4 have a ProductID that is no number."""
    path = TB.shared_dir(spark, "messages", unique=True)
    b = bronze(spark, sf_dir)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    line = F.col("l_linenumber")
    value = (F.when(line == 3, F.concat(F.lit('{"ProductName":"'), key))
              .when(line == 4, F.concat(F.lit('{"ProductID":"'), key, F.lit('"}')))
              .otherwise(IN.message(S.BRONZE_COLUMNS)))
    _write_lines(b.select(value.alias("value")), path, compression="gzip")
    return IN.split_messages(spark.read.text(path))[1]


def _drain(records, paths, checkpoint, **kw) -> None:
    q = ST.start_bronze_stream(records, paths, checkpoint, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _run_stream(spark, sf_dir, refresh) -> RF.LakePaths:
    _, paths, checkpoint = ST.stream_dirs(spark, "fixture")
    src = _messages(spark, sf_dir)
    records = ST.read_message_stream(spark, path=src, max_per_trigger=_files_per_trigger(spark, src, 1))
    _drain(records, paths, checkpoint, refresh=refresh, keep_existing_stamp=True)
    TB.remove(spark, src)
    return paths


def _two_streams(spark, sf_dir, refresh) -> RF.LakePaths:
    """Two streams with their own sources and checkpoints, one lake."""
    _, paths, checkpoint = ST.stream_dirs(spark, "two")
    for k in (0, 1):
        src = _messages(spark, sf_dir, F.col("l_linenumber") % 2 == k)
        _drain(ST.read_message_stream(spark, path=src, keep_rejected=True), paths, f"{checkpoint}{k}", refresh=refresh,
               keep_existing_stamp=True)
    return paths


def q_stream_two_sources(spark, sf_dir):
    return RF.read_bronze(spark, _two_streams(spark, sf_dir, None).bronze)


def _two_sources_gold(refresh: str) -> Query:
    def q(spark, sf_dir):
        return gold_cells(spark, _two_streams(spark, sf_dir, refresh).gold)
    return q


def gold_cells(spark, root: str) -> DataFrame:
    """All six stored gold tables in one long form: (table_name, key, column_name, number, label)."""
    out = None
    for name in S.GOLD_TABLES:
        df = TB.read_gold(spark, root, name)
        keys = [c for c in ("PriceRange", "Category") if c in df.columns]
        cells = [F.struct(F.lit(c).alias("column_name"), (F.col(c) if t != "string" else F.lit(None)).cast("double").alias("number"),
                          (F.col(c) if t == "string" else F.lit(None)).cast("string").alias("label"))
                 for c, t in df.dtypes if c not in keys]
        one = df.select(F.lit(name).alias("table_name"), F.concat_ws("/", *keys).alias("key"), F.inline(F.array(*cells)))
        out = one if out is None else out.unionByName(one)
    return out


def q_table_gold_roundtrip_all(spark, sf_dir):
    root = TB.shared_dir(spark, "gold", unique=True)
    TB.write_gold(MD.gold_from_silver(silver(spark, sf_dir, columns=GOLD_ALL)), root)
    return gold_cells(spark, root)


def q_lookup_strict(spark, sf_dir):
    """A strict lookup, and reading with the first format absent: the stored revenue rows of one category."""
    root = TB.shared_dir(spark, "gold", unique=True)
    s = silver(spark, sf_dir, columns=("Category", *G.NEEDS["revenue_per_category"]))
    TB.write_gold({"revenue_per_category": G.revenue_per_category(G.category_stats(s))}, root)
    stored = TB.read_table(spark, f"{root}/revenue_per_category_parquet", fmt=("delta", "parquet"))
    return LK.lookup(stored, "PROMO", strict=True)


def q_table_silver_vectors(spark, sf_dir):
    """Stored silver with its two vector columns, one row per slot."""
    path = TB.shared_dir(spark, "silver", unique=True)
    TB.write_table(SV.scale_columns(silver(spark, sf_dir, columns=("ProductID", "DateAdded", "Year", "Month", *S.SCALED_COLUMNS)), vectors=True),
                   path, partition_by=["Year", "Month"])
    stored = TB.read_table(spark, path)
    slots = stored.select("ProductID", F.posexplode(F.arrays_zip("features", "scaled_features")).alias("slot", "v"))
    return slots.select("ProductID", "slot", F.col("v.features").alias("feature"), F.col("v.scaled_features").alias("scaled"))


def q_stream_csv_rejected(spark, sf_dir):
    """What a CSV stream has put in the lake's rejected table."""
    _, paths, checkpoint = ST.stream_dirs(spark, "csv")
    src = _csv_fixture(spark, sf_dir)
    records = ST.read_csv_stream(spark, src, header=False, glob="part-*", keep_rejected=True)
    _drain(records, paths, checkpoint, stamp=STREAM_STAMP)
    return spark.read.parquet(paths.rejected).select("ProductID", "ProductName", "RejectReason")


def q_stream_rows_stored(spark, sf_dir):
    """Rows that each of two streams has stored (their ids differ from run to run: numbered by size)."""
    stored = ST.rows_stored(spark, _two_streams(spark, sf_dir, None))
    return stored.select(F.col("rows"))


def q_ml_split(spark, sf_dir):
    """Part and fold of every key: the sets that training and its out-of-fold predictions use."""
    s = silver(spark, sf_dir, category="brand", columns=["Category"])
    keys = s.select("Category").distinct()
    return keys.select("Category", F.when(ML.hash_bucket(["Category"], 42, 100) < 80, "train").otherwise("test").alias("part"),
                       ML.hash_bucket(["Category"], 43, 5).cast("int").alias("fold"))


def q_ml_one_hot_slots(spark, sf_dir):
    """The encoded vectors themselves: a row for each key, categorical feature and slot."""
    from pyspark.ml.functions import vector_to_array
    feats = features(spark, sf_dir)
    enc = ML.one_hot_model(feats, S.CATEGORICAL_FEATURES).transform(feats)
    out = None
    for c in S.CATEGORICAL_FEATURES:
        one = enc.select("Category", F.lit(c).alias("feature"), F.posexplode(vector_to_array(f"{c}_ohe")).alias("slot", "value"))
        out = one if out is None else out.unionByName(one)
    return out


def q_stream_bronze_append(spark, sf_dir):
    return RF.read_bronze(spark, _run_stream(spark, sf_dir, refresh=None).bronze)


def q_stream_gold_refresh(spark, sf_dir):
    paths = _run_stream(spark, sf_dir, refresh="full")
    return TB.read_gold(spark, paths.gold, "revenue_per_category")


def q_stream_gold_incremental(spark, sf_dir):
    """Messages to bronze, and the lake's refresh query over bronze in a few micro-batches."""
    paths = _run_stream(spark, sf_dir, refresh=None)
    INC.refresh_now(spark, paths, max_files_per_trigger=_files_per_trigger(spark, paths.bronze, 4),
                    state_partitions=INC.state_partitions_for(spark, paths))
    return TB.read_gold(spark, paths.gold, "revenue_per_category")


def _batched_lake(spark, sf_dir, batches) -> tuple[RF.LakePaths, list]:
    """A lake whose bronze grows by one batch of the fixture after the other, each followed by the incremental refresh;
    with it the folders that the last batch touched."""
    _, paths, _ = ST.stream_dirs(spark, "batches")
    touched = []
    for k, where in enumerate(batches):
        ST.append_batch(FX.drop_tie_break(bronze(spark, sf_dir).where(where)), k, paths.bronze, "fixture")
        touched = INC.refresh_now(spark, paths, state_partitions=INC.state_partitions_for(spark, paths))
    return paths, touched[-1] if touched else []


_lakes: dict[tuple, RF.LakePaths] = {}


def _three_batch_lake(spark, sf_dir) -> RF.LakePaths:
    """The lake after ``THREE_BATCHES``: made once in an application, for the queries that look at different tables of it."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _lakes or not INC.exists(spark, _lakes[at].scaling):
        _lakes[at] = _batched_lake(spark, sf_dir, THREE_BATCHES)[0]
    return _lakes[at]


#: Products recur in all three, so most of them change their record and many their month.
THREE_BATCHES = ["l_linenumber IN (1, 4)", "l_linenumber IN (2, 5, 7)", "l_linenumber IN (3, 6)"]
#: The second batch holds the last months alone.
LAST_MONTHS = "1998-10-01"


def q_stream_silver_incremental(spark, sf_dir):
    """Silver by folder after three batches."""
    return INC.read_silver(spark, _three_batch_lake(spark, sf_dir).silver)


def q_stream_silver_touched(spark, sf_dir):
    """The folders that the second of two batches has rewritten or removed, with the rows that silver now has in them."""
    paths, folders = _batched_lake(spark, sf_dir, [f"ProcessedTimestamp < '{LAST_MONTHS}'", f"ProcessedTimestamp >= '{LAST_MONTHS}'"])
    touched = spark.createDataFrame(folders, "Year int, Month int").select("Year", "Month", F.lit(0).cast("long").alias("one"))
    now = INC.read_silver(spark, paths.silver).where(INC.in_folders(folders)).select("Year", "Month", F.lit(1).cast("long").alias("one"))
    return touched.unionByName(now).groupBy("Year", "Month").agg(F.sum("one").alias("rows"))


def q_stream_silver_scaled(spark, sf_dir):
    """Scaled columns by the stored divisors, which three batches have merged."""
    vectors = INC.scaled_silver(spark, _three_batch_lake(spark, sf_dir))
    return vectors.select("ProductID", *(F.col("scaled_features")[i].alias(f"scaled_{c}") for i, c in enumerate(S.SCALED_COLUMNS)))


def q_stream_gold_partials(spark, sf_dir):
    """All six gold tables as merged from the partial aggregates after three batches."""
    return gold_cells(spark, _three_batch_lake(spark, sf_dir).gold)


STREAM_STAMP = "2024-01-01T00:00:00"


def q_stream_csv_bronze(spark, sf_dir):
    """CSV files -> file stream (existing files, several micro-batches) -> bronze, stamped."""
    _, paths, checkpoint = ST.stream_dirs(spark, "csv")
    src = _csv_fixture(spark, sf_dir)
    records = ST.read_csv_stream(spark, src, max_files_per_trigger=_files_per_trigger(spark, src, 3), header=False, glob="part-*")
    _drain(records, paths, checkpoint, stamp=STREAM_STAMP)
    TB.remove(spark, src)
    return RF.read_bronze(spark, paths.bronze)


def q_table_silver_roundtrip(spark, sf_dir):
    path = TB.shared_dir(spark, "silver", unique=True)
    s = silver(spark, sf_dir)
    TB.write_table(s, path, partition_by=["Year", "Month"])
    return TB.read_table(spark, path).select(*s.columns)


def q_table_gold_roundtrip(spark, sf_dir):
    root = TB.shared_dir(spark, "gold", unique=True)
    TB.write_gold(MD.gold_from_silver(silver(spark, sf_dir, columns=GOLD_ALL)), root)
    return TB.read_gold(spark, root, "revenue_per_category")


def _fingerprints(gold: dict[str, DataFrame], names) -> DataFrame:
    out = None
    for n in names:
        fp = FP.content_fingerprint(gold[n], n)
        out = fp if out is None else out.unionByName(fp)
    return out


def q_table_fingerprint(spark, sf_dir):
    gold = MD.gold_from_silver(silver(spark, sf_dir, columns=GOLD_ALL))
    return _fingerprints(gold, list(gold))


def q_table_changes(spark, sf_dir):
    """Old state: three gold tables by product type. New state: revenue unchanged, discount_impact
    rebuilt by brand (changed), price_rating_correlation added (new), review_sales_ratio dropped (gone)."""
    before, by_type = (MD.gold_from_silver(silver(spark, sf_dir, columns=GOLD_ALL)) for _ in range(2))
    by_brand = MD.gold_from_silver(silver(spark, sf_dir, category="brand", columns=GOLD_ALL))
    old = _fingerprints(before, ["revenue_per_category", "discount_impact", "review_sales_ratio"])
    new = _fingerprints({**by_type, "discount_impact": by_brand["discount_impact"]},
                        ["revenue_per_category", "discount_impact", "price_rating_correlation"])
    return FP.changed_tables(old, new)


def q_ml_yeo_johnson_lambda(spark, sf_dir):
    return ML.yeo_johnson_lambdas(features(spark, sf_dir), S.NUMERIC_FEATURES)


def requests(spark, sf_dir) -> DataFrame:
    """One prediction request per product, from its latest raw record (some out of range)."""
    raw = bronze(spark, sf_dir, columns=["Price", "Discount", "Rating", "NumReviews", "Category"])
    latest = SV.latest_per_product(raw, order=FX.DEDUPE_ORDER)
    return latest.select(
        F.col("ProductID").cast("long").alias("request_id"), F.col("Price").alias("price"),
        F.col("Discount").cast("double").alias("discount_percentage"), F.col("Rating").alias("rating"),
        F.col("NumReviews").alias("num_reviews"), F.upper(F.trim("Category")).alias("category"))


def q_ml_requests_valid(spark, sf_dir):
    return ML.validate_requests(requests(spark, sf_dir))[0]


def q_ml_requests_rejected(spark, sf_dir):
    return ML.validate_requests(requests(spark, sf_dir))[1]


def q_ml_request_features(spark, sf_dir):
    return ML.request_features(q_ml_requests_valid(spark, sf_dir))


def q_ml_regression_metrics(spark, sf_dir):
    """Metrics of the per-category mean-sales baseline over silver products."""
    s = silver(spark, sf_dir, columns=["Category", "Sales"])
    means = s.groupBy("Category").agg(F.avg("Sales").alias("baseline"))
    scored = s.join(means, s["Category"].eqNullSafe(means["Category"])).select("Sales", "baseline")
    return ML.regression_metrics(scored, "Sales", "baseline")


def q_ml_one_hot(spark, sf_dir):
    feats = features(spark, sf_dir)
    enc = ML.one_hot_model(feats, S.CATEGORICAL_FEATURES).transform(feats)
    return enc.select("Category", *[F.col(f"{c}_idx").cast("int").alias(f"{c}_idx") for c in S.CATEGORICAL_FEATURES])


def trained(spark, sf_dir):
    """The stacked model on the brand-grain features (small sizes): loaded from the shared folder when a model of
    features with the same content is there, else trained and saved under their fingerprint."""
    feats = TB.checkpointed(features(spark, sf_dir))
    mark = FP.content_fingerprint(feats, "features").first()  # one row
    path = TB.shared_dir(spark, "models", f"{mark['rows']}-{mark['hash']}")
    try:
        return ML.load_model(spark, path)
    except TB.TableNotFound:
        model, _ = ML.train(feats, ["Category"], config=ML.StackConfig.small())
        ML.save_model(model, spark, path)
        return model


def q_ml_stacked_metrics(spark, sf_dir):
    return trained(spark, sf_dir).metrics


def q_ml_feature_importance(spark, sf_dir):
    model = trained(spark, sf_dir)
    return ML.feature_importance(spark, model.stack.bases[0], model.names, top=10)


def q_ml_score_batch(spark, sf_dir):
    return trained(spark, sf_dir).score(q_ml_request_features(spark, sf_dir))


def q_ml_score_keys(spark, sf_dir):
    """That every valid request, and no other, has one finite prediction and the model's confidence."""
    scored = q_ml_score_batch(spark, sf_dir)
    finite = F.col("predicted_sales").isNotNull() & ~F.isnan("predicted_sales")
    return scored.groupBy("request_id").agg(F.count(F.lit(1)).alias("predictions"), F.bool_and(finite).alias("finite"),
                                            F.countDistinct("confidence_score").alias("confidences"))


QUERIES: dict[str, Query] = {
    "bronze_products": q_bronze_products,
    "silver_dedupe": q_silver_dedupe,
    "silver_products": q_silver_products,
    "silver_scaled": q_silver_scaled,
    **{f"gold_{n}": _gold(n) for n in [
        "revenue_per_category", "discount_impact", "discount_effectiveness",
        "price_rating_correlation", "price_satisfaction", "review_sales_ratio"]},
    "profile_nulls": q_profile_nulls,
    "profile_sales_stats": q_profile_sales_stats,
    "profile_sample": q_profile_sample,
    "profile_bronze_sample": q_profile_bronze_sample,
    "lookup_categories": q_lookup_categories,
    **{name: _lookup(t, c) for name, (t, c) in LOOKUPS.items()},
    "ingest_csv_valid": q_ingest_csv_valid,
    "ingest_csv_rejected": q_ingest_csv_rejected,
    "ingest_csv_quoted": q_ingest_csv_quoted,
    "ingest_json_roundtrip": q_ingest_json_roundtrip,
    "ingest_json_rejected": q_ingest_json_rejected,
    "stream_two_sources": q_stream_two_sources,
    "stream_two_sources_gold_full": _two_sources_gold("full"),
    "stream_two_sources_gold_incremental": _two_sources_gold("incremental"),
    "stream_rows_stored": q_stream_rows_stored,
    "stream_csv_rejected": q_stream_csv_rejected,
    "table_gold_roundtrip_all": q_table_gold_roundtrip_all,
    "table_silver_vectors": q_table_silver_vectors,
    "lookup_strict": q_lookup_strict,
    "ml_split": q_ml_split,
    "ml_one_hot_slots": q_ml_one_hot_slots,
    "ml_score_keys": q_ml_score_keys,
    "stream_bronze_append": q_stream_bronze_append,
    "stream_gold_refresh": q_stream_gold_refresh,
    "stream_gold_incremental": q_stream_gold_incremental,
    "stream_silver_incremental": q_stream_silver_incremental,
    "stream_silver_touched": q_stream_silver_touched,
    "stream_silver_scaled": q_stream_silver_scaled,
    "stream_gold_partials": q_stream_gold_partials,
    "stream_csv_bronze": q_stream_csv_bronze,
    "table_silver_roundtrip": q_table_silver_roundtrip,
    "table_gold_roundtrip": q_table_gold_roundtrip,
    "table_fingerprint": q_table_fingerprint,
    "table_changes": q_table_changes,
    "features_joined": q_features_joined,
    **{name: _features(cols) for name, cols in FEATURE_GROUPS.items()},
    "features_product_grain": q_features_product_grain,
    "ml_yeo_johnson_lambda": q_ml_yeo_johnson_lambda,
    "ml_requests_valid": q_ml_requests_valid,
    "ml_requests_rejected": q_ml_requests_rejected,
    "ml_request_features": q_ml_request_features,
    "ml_regression_metrics": q_ml_regression_metrics,
    "ml_one_hot": q_ml_one_hot,
    "ml_stacked_metrics": q_ml_stacked_metrics,
    "ml_feature_importance": q_ml_feature_importance,
    "ml_score_batch": q_ml_score_batch,
}
