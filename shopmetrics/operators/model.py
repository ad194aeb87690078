"""Model training and batch scoring on Spark ML (ML-1..11).

The reference trains a scikit-learn stack on one pandas frame; here every step is a Spark job:
the Yeo-Johnson lambda search is a grouped aggregate over (column, lambda), the split and the
folds are hashes of the key, base learners and the meta learner are Spark ML regressors, and
scoring is ``transform`` over a DataFrame of requests.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..sources.ingest import split_valid_rejected
from ..sources.tables import checkpointed

# ---------------------------------------------------------------- split and folds

def hash_bucket(keys: Sequence[str], seed: int, buckets: int) -> Column:
    """Stable bucket of a row's key: independent of partitioning, row order and engine (32 bits of an md5)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("~")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(buckets)


def hash_split(df: DataFrame, keys: Sequence[str], train_pct: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    b = hash_bucket(keys, seed, 100)
    return df.where(b < train_pct), df.where(b >= train_pct)


# ---------------------------------------------------------------- Yeo-Johnson

#: The search covers lambdas of at most this size, in steps that end at STEPS[-1].
LAMBDA_BOUND = 64.0
STEPS = (0.5, 0.05, 0.005)
FACTS = ["lo_pos", "hi_pos", "lo_neg", "hi_neg"]


def long_form(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, x) rows for the non-NULL values of ``cols``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in cols])
    return df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("x").isNotNull() & ~F.isnan("x"))


def column_facts(values: DataFrame) -> DataFrame:
    """One row per column: n, the Jacobian sum, and the ends of ln(1 + |x|) for x >= 0 and for x < 0."""
    x = F.col("x")
    size, pos = F.log1p(F.abs(x)), F.col("x") >= 0
    ends = [f(F.when(side, size)).alias(n) for n, f, side in zip(FACTS, (F.min, F.max, F.min, F.max), (pos, pos, ~pos, ~pos), strict=True)]
    return values.groupBy("column_name").agg(F.count(F.lit(1)).alias("n"), F.sum(F.signum(x) * size).alias("s"), *ends)


def log_scale(lam: Column, lo_pos: Column, hi_pos: Column, lo_neg: Column, hi_neg: Column) -> Column:
    """The largest exponent of a column under a lambda: ``scaled_yeo_johnson`` divides by its exponential."""
    mu = 2 - lam
    both = F.greatest(F.lit(0.0), lam * lo_pos, lam * hi_pos, mu * lo_neg, mu * hi_neg)
    return F.when(hi_neg.isNull(), F.greatest(lam * lo_pos, lam * hi_pos)).when(
        hi_pos.isNull(), F.greatest(mu * lo_neg, mu * hi_neg)).otherwise(both)


def scaled_yeo_johnson(x: Column, lam: Column, scale: Column, lo_pos: Column, hi_pos: Column, lo_neg: Column, hi_neg: Column) -> Column:
    """The Yeo-Johnson transform divided by exp(scale), and without its constant in a column of one sign: after
    standardizing it is the same, and neither large nor nearly constant values lose their digits."""
    mu, size = 2 - lam, F.log1p(F.abs(x))
    offset = F.when(hi_neg.isNull() | hi_pos.isNull(), F.lit(0.0)).otherwise(F.exp(-scale))
    pos = F.when(F.abs(lam) < 1e-12, size * F.exp(-scale)).otherwise((F.exp(lam * size - scale) - offset) / lam)
    neg = F.when(F.abs(mu) < 1e-12, -size * F.exp(-scale)).otherwise(-(F.exp(mu * size - scale) - offset) / mu)
    return F.when(x >= 0, pos).otherwise(neg)


def _best(values: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each column's candidate lambda of greatest profile log-likelihood (ties: the smaller lambda).

    ``candidates`` has a bounded number of rows per column (a parameter, not data), and is broadcast."""
    facts = [F.col(f) for f in FACTS]
    lam, scale = F.col("lambda"), log_scale(F.col("lambda"), *facts)
    rows = values.join(F.broadcast(candidates), "column_name").withColumn("scale", scale)
    spread = rows.groupBy("column_name", "lambda", "n", "s", "scale", *FACTS).agg(
        F.var_pop(scaled_yeo_johnson(F.col("x"), lam, F.col("scale"), *facts)).alias("v"))
    llf = -F.col("n") / 2 * (F.log("v") + 2 * F.col("scale")) + (lam - 1) * F.col("s")
    best = spread.where("v > 0").withColumn("llf", llf).where(~F.isnan("llf")).groupBy("column_name", "n", "s", *FACTS).agg(
        F.max_by("lambda", F.struct("llf", F.col("lambda") * -1)).alias("lambda"))
    return best


def yeo_johnson_lambdas(df: DataFrame, cols: Sequence[str], bound: float = LAMBDA_BOUND, facts: bool = False) -> DataFrame:
    """(column_name, lambda, at_bound): the maximum-likelihood lambda of each column to 0.005.

    A coarse grid over [-bound, bound] finds the peak, finer ones close in on it. ``at_bound`` marks a likelihood
    that still grows at the bound. A column without spread has no row. ``facts`` adds what
    ``scaled_yeo_johnson`` needs."""
    values = long_form(df, cols)
    spread = "hi_pos > lo_pos OR hi_neg > lo_neg OR (hi_pos IS NOT NULL AND hi_neg IS NOT NULL)"
    known = checkpointed(column_facts(values).where(spread))  # a row per column
    best = known.withColumn("lambda", F.lit(0.0))
    reach = bound
    for step in STEPS:
        n = int(round(reach / step))
        near = F.explode(F.transform(F.sequence(F.lit(-n), F.lit(n)), lambda k: F.round(F.col("lambda") + k * F.lit(step), 3)))
        grid = best.select("column_name", "n", "s", *FACTS, near.alias("lambda")).where(F.abs("lambda") <= bound)
        best = checkpointed(_best(values, grid))
        reach = step
    return best.select("column_name", "lambda", (F.abs("lambda") >= bound).alias("at_bound"), *(FACTS if facts else ()))


def lambda_row(lambdas: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with ``_lam_<col>`` and the column's facts per feature (missing -> 1.0, the identity)."""
    wide = lambdas.groupBy().pivot("column_name", list(cols)).agg(F.first(F.struct("lambda", *FACTS)))
    return wide.select(*[F.coalesce(F.col(f"`{c}`")["lambda"], F.lit(1.0)).alias(f"_lam_{c}") for c in cols],
                       *[F.col(f"`{c}`")[f].alias(f"_{f}_{c}") for c in cols for f in FACTS])


@dataclass
class PowerScaler:
    """Fitted Yeo-Johnson + standardize (population std) parameters, kept as one-row DataFrames."""
    cols: list[str]
    lambdas: DataFrame
    moments: DataFrame

    @staticmethod
    def _y(c: str) -> Column:
        """The transform of one column beside the parameters' row; of a column without spread, the plain value."""
        facts = [F.col(f"_{f}_{c}") for f in FACTS]
        lam, x = F.col(f"_lam_{c}"), F.col(c).cast("double")
        known = facts[1].isNotNull() | facts[3].isNotNull()
        return F.when(known, scaled_yeo_johnson(x, lam, log_scale(lam, *facts), *facts)).otherwise(x)

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "PowerScaler":
        cols = list(cols)
        lam = checkpointed(lambda_row(yeo_johnson_lambdas(df, cols, facts=True), cols))
        t = df.crossJoin(F.broadcast(lam)).select(*[cls._y(c).alias(c) for c in cols])
        moments = t.agg(*[F.avg(c).alias(f"_mu_{c}") for c in cols],
                        *[F.stddev_pop(c).alias(f"_sd_{c}") for c in cols])
        return cls(cols, lam, checkpointed(moments))

    def transform(self, df: DataFrame, suffix: str = "_yj") -> DataFrame:
        x = df.crossJoin(F.broadcast(self.lambdas)).crossJoin(F.broadcast(self.moments))
        out = []
        for c in self.cols:
            sd = F.col(f"_sd_{c}")
            out.append(F.coalesce(F.when(sd > 0, (self._y(c) - F.col(f"_mu_{c}")) / sd), F.lit(0.0)).alias(c + suffix))
        return x.select(*df.columns, *out)


# ---------------------------------------------------------------- one-hot

def one_hot_model(df: DataFrame, cols: Sequence[str]) -> PipelineModel:
    """Sorted categories, unknown -> all zeros (StringIndexer keep + OneHotEncoder dropLast)."""
    from pyspark.ml import Pipeline
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep", stringOrderType="alphabetAsc")
              for c in cols]
    stages.append(OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe" for c in cols],
                                dropLast=True))  # the indexer's extra "unknown" slot is the dropped one
    return Pipeline(stages=stages).fit(df)


# ---------------------------------------------------------------- stacking

@dataclass
class StackConfig:
    """Reference sizes by default; ``small()`` for quick runs. Spark caps tree depth at 30."""
    rf_trees: int = 200
    rf_depth: int = 30
    gbm_iter: int = 200
    gbm_lr: float = 0.1
    gbm_depth: int = 3
    slow_iter: int = 100
    slow_lr: float = 0.01
    slow_depth: int = 3
    meta_iter: int = 100
    meta_lr: float = 0.1
    meta_depth: int = 3
    folds: int = 5
    seed: int = 42

    @classmethod
    def small(cls) -> "StackConfig":
        return cls(rf_trees=20, rf_depth=8, gbm_iter=10, slow_iter=10, meta_iter=10, folds=3)

    def bases(self, features: str, label: str):
        return [
            ("rf", RandomForestRegressor(featuresCol=features, labelCol=label, predictionCol="p_rf",
                                         numTrees=self.rf_trees, maxDepth=self.rf_depth, minInstancesPerNode=1,
                                         featureSubsetStrategy="all", seed=self.seed)),
            ("gbm", GBTRegressor(featuresCol=features, labelCol=label, predictionCol="p_gbm",
                                 maxIter=self.gbm_iter, stepSize=self.gbm_lr, maxDepth=self.gbm_depth, seed=self.seed)),
            ("slow", GBTRegressor(featuresCol=features, labelCol=label, predictionCol="p_slow",
                                  maxIter=self.slow_iter, stepSize=self.slow_lr, maxDepth=self.slow_depth,
                                  seed=self.seed)),
        ]

    def meta(self, label: str):
        return GBTRegressor(featuresCol="_meta_features", labelCol=label, predictionCol="prediction",
                            maxIter=self.meta_iter, stepSize=self.meta_lr, maxDepth=self.meta_depth, seed=self.seed)


@dataclass
class StackModel:
    bases: list = field(default_factory=list)
    meta: object = None
    base_names: list = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for m in self.bases:
            out = m.transform(out)
        out = VectorAssembler(inputCols=[f"p_{n}" for n in self.base_names], outputCol="_meta_features").transform(out)
        return self.meta.transform(out).drop("_meta_features")


def fit_stack(train: DataFrame, keys: Sequence[str], features: str = "features", label: str = S.TARGET,
              config: StackConfig | None = None) -> StackModel:
    """Out-of-fold base predictions (folds = hash of the key) -> meta learner; bases refit on all rows."""
    cfg = config or StackConfig()
    fold = hash_bucket(keys, cfg.seed + 1, cfg.folds)
    data = train.withColumn("_fold", fold)
    oof = None
    names = [n for n, _ in cfg.bases(features, label)]
    for k in range(cfg.folds):
        fit_part, hold = data.where(F.col("_fold") != k), data.where(F.col("_fold") == k)
        if hold.isEmpty():  # nothing to score: the other folds' models cover every row
            continue
        if fit_part.isEmpty():
            raise ValueError(f"all rows fall in fold {k}: too few keys for {cfg.folds} folds")
        preds = hold
        for _, est in cfg.bases(features, label):
            preds = est.fit(fit_part).transform(preds)
        preds = preds.select(*keys, label, *[f"p_{n}" for n in names])
        oof = preds if oof is None else oof.unionByName(preds)
    if oof is None:
        raise ValueError("too few training rows for out-of-fold stacking")
    meta_in = checkpointed(VectorAssembler(inputCols=[f"p_{n}" for n in names],
                                           outputCol="_meta_features").transform(oof))
    meta = cfg.meta(label).fit(meta_in)
    bases = [est.fit(train) for _, est in cfg.bases(features, label)]
    return StackModel(bases, meta, names)


# ---------------------------------------------------------------- metrics and importances

def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: r2, mse, rmse, mae, n (two aggregate passes; the mean is a one-row broadcast)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    pairs = df.select(y.alias("_y"), p.alias("_p")).where(F.col("_y").isNotNull() & F.col("_p").isNotNull())
    mean = pairs.agg(F.avg("_y").alias("_ybar"))
    e = F.col("_y") - F.col("_p")
    agg = pairs.crossJoin(F.broadcast(mean)).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e * e).alias("_sse"),
        F.sum((F.col("_y") - F.col("_ybar")) ** 2).alias("_sst"),
        F.avg(F.abs(e)).alias("mae"),
    )
    return agg.select(
        (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"),
        F.try_divide(F.col("_sse"), F.col("n")).alias("mse"),
        F.sqrt(F.try_divide(F.col("_sse"), F.col("n"))).alias("rmse"),
        F.col("mae"), F.col("n"))


def feature_importance(spark: SparkSession, model, names: Sequence[str], top: int | None = 10) -> DataFrame:
    """(feature, importance, importance_percentage) of a tree model, labelled with the true
    assembler slot names, sorted descending; ``top`` keeps the first rows (a top-k report)."""
    imp = model.featureImportances.toArray().tolist()
    rows = [(n, float(v), float(v) * 100) for n, v in zip(names, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double, importance_percentage double")
    df = df.orderBy(F.col("importance").desc(), "feature")
    return df.limit(top) if top else df


def assembled_names(df: DataFrame, numeric: Sequence[str], ohe_cols: Sequence[str], suffix: str = "_yj") -> list[str]:
    """Slot names of the assembled vector: numeric columns, then one slot per known category."""
    names = [c + suffix for c in numeric]
    for c in ohe_cols:
        attrs = df.schema[f"{c}_ohe"].metadata.get("ml_attr", {})
        size = attrs.get("num_attrs", 0)
        vals = [a.get("name") for group in attrs.get("attrs", {}).values() for a in group]
        names += [f"{c}_{v}" for v in vals] if vals else [f"{c}_{i}" for i in range(size)]
    return names


# ---------------------------------------------------------------- requests

REQUEST_SCHEMA = "request_id long, price double, discount_percentage double, rating double, num_reviews int, category string"


def request_rules() -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("price", c("price") > 0),
        ("discount_percentage", (c("discount_percentage") >= 0) & (c("discount_percentage") <= 100)),
        ("rating", (c("rating") >= 1) & (c("rating") <= 5)),
        ("num_reviews", c("num_reviews") >= 0),
        ("category", c("category").isNotNull()),
    ]


def validate_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_valid_rejected(requests, request_rules())


def request_features(requests: DataFrame) -> DataFrame:
    """Model input row per request: renames plus the derived or constant features."""
    c = F.col
    p, d, r, n = c("price"), c("discount_percentage"), c("rating"), c("num_reviews")
    b1, b2, b3, b4 = S.REQUEST_PRICE_BANDS
    l1, l2, l3, l4, l5 = S.PRICE_CATEGORY_LABELS
    band = F.when(p <= b1, l1).when(p <= b2, l2).when(p <= b3, l3).when(p <= b4, l4).otherwise(l5)
    keep = (1 - d / 100)
    scale = S.REQUEST_SCALE
    return requests.select(
        "request_id",
        p.alias("AveragePrice"), d.alias("AvgDiscountPercentage"), r.alias("AvgRating"),
        n.cast("double").alias("AvgReviews"), c("category").alias("Category"),
        F.lit(1.0).alias("PriceToAvgRatio"), F.lit(0.0).alias("PriceVariance"),
        (d / 100).alias("DiscountEfficiency"), keep.alias("DiscountEffectiveness"),
        (n / scale).alias("ReviewsPerSale"),
        F.when(r >= S.HIGH_RATING, F.lit(1.0)).otherwise(F.lit(0.0)).alias("HighRatingRatio"),
        (r * (n / scale)).alias("EngagementScore"), (r * keep).alias("CustomerSatisfaction"),
        (p * keep).alias("RevenuePerProduct"), F.lit(1.0).alias("SalesEfficiency"),
        (p * r).alias("PriceRatingInteraction"), (d * r).alias("DiscountRatingInteraction"),
        (p * d).alias("PriceDiscountInteraction"), F.lit(1.0).alias("MarketPerformance"),
        (n * r).alias("CustomerEngagementIndex"), (p * keep).alias("ProfitabilityScore"),
        F.lit(0.0).alias("Normalized_TotalRevenue"), F.lit(0.0).alias("Normalized_TotalSales"),
        F.lit(0.0).alias("Normalized_AveragePrice"),
        band.alias("PriceCategory"), F.lit(S.REQUEST_ROI_CATEGORY).alias("DiscountROICategory"),
    )


# ---------------------------------------------------------------- end to end

def plain_vector(df: DataFrame, col: str = "features") -> DataFrame:
    """Drop the nominal ML attributes of the one-hot slots: trees then split a 0/1 slot like any
    number (same splits), and a small fold no longer fails Spark's categorical bin check."""
    return df.withColumn(col, F.col(col).alias(col, metadata={}))


@dataclass
class TrainedModel:
    scaler: PowerScaler
    encoder: PipelineModel
    assembler: VectorAssembler
    stack: StackModel
    metrics: DataFrame
    names: list[str]
    numeric: list[str]
    categorical: list[str]

    def prepare(self, df: DataFrame) -> DataFrame:
        filled = df.fillna(0.0, subset=self.numeric)
        return plain_vector(self.assembler.transform(self.encoder.transform(self.scaler.transform(filled))))

    def score(self, features: DataFrame, keys: Sequence[str] = ("request_id",)) -> DataFrame:
        """predicted_sales and confidence_score (= test r2, a one-row broadcast) per input row."""
        pred = self.stack.transform(self.prepare(features))
        conf = self.metrics.select(F.col("r2").alias("confidence_score"))
        return pred.crossJoin(F.broadcast(conf)).select(
            *keys, F.col("prediction").alias("predicted_sales"), "confidence_score")


def train(features: DataFrame, keys: Sequence[str], numeric: Sequence[str] | None = None,
          categorical: Sequence[str] = tuple(S.CATEGORICAL_FEATURES), label: str = S.TARGET,
          config: StackConfig | None = None, leaky: bool = False) -> tuple[TrainedModel, DataFrame]:
    """Split, fit preprocessing on the training rows, fit the stack, score the test rows.

    Returns the model and the test predictions (keys, label, prediction). By default the
    features computed from the target are dropped (``leaky=True`` keeps all 23)."""
    cfg = config or StackConfig()
    numeric = list(numeric or [c for c in S.NUMERIC_FEATURES if leaky or c not in S.LEAKY_FEATURES])
    categorical = list(categorical)
    # The model input is one row per key: small, and read by every fit below, so cut its lineage once.
    data = checkpointed(features.fillna(0.0, subset=numeric))
    tr, te = hash_split(data, keys, 80, cfg.seed)
    scaler = PowerScaler.fit(tr, numeric)
    encoder = one_hot_model(tr, categorical)
    enc_tr = encoder.transform(scaler.transform(tr))
    assembler = VectorAssembler(inputCols=[c + "_yj" for c in numeric] + [f"{c}_ohe" for c in categorical],
                                outputCol="features")
    stack = fit_stack(checkpointed(plain_vector(assembler.transform(enc_tr))), keys, "features", label, cfg)
    names = assembled_names(enc_tr, numeric, categorical)
    partial = TrainedModel(scaler, encoder, assembler, stack, None, names, numeric, categorical)
    test_pred = stack.transform(partial.prepare(te)).select(*keys, label, "prediction")
    partial.metrics = checkpointed(regression_metrics(test_pred, label, "prediction"))  # one row; else each score runs the stack again
    return partial, test_pred


def save_model(model: TrainedModel, spark: SparkSession, path: str, importances: DataFrame | None = None) -> None:
    """Spark ML persistence for the fitted stages; parameters, metrics and importances as tables."""
    for i, m in enumerate(model.stack.bases):
        m.write().overwrite().save(f"{path}/base_{i}_{model.stack.base_names[i]}")
    model.stack.meta.write().overwrite().save(f"{path}/meta")
    model.encoder.write().overwrite().save(f"{path}/encoder")
    model.scaler.lambdas.write.mode("overwrite").parquet(f"{path}/lambdas")
    model.scaler.moments.write.mode("overwrite").parquet(f"{path}/moments")
    model.metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    spec = spark.createDataFrame(
        [(model.numeric, model.categorical, model.names, model.stack.base_names)],
        "numeric array<string>, categorical array<string>, names array<string>, bases array<string>")
    spec.write.mode("overwrite").parquet(f"{path}/spec")
    if importances is not None:
        importances.write.mode("overwrite").parquet(f"{path}/importances")


def load_model(spark: SparkSession, path: str) -> TrainedModel:
    """Inverse of ``save_model``: fitted stages from Spark ML persistence, parameters as tables."""
    from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
    from ..sources.tables import read_table
    spec = read_table(spark, f"{path}/spec").first()  # one row: the feature lists; written last
    loaders = {"rf": RandomForestRegressionModel, "gbm": GBTRegressionModel, "slow": GBTRegressionModel}
    bases = [loaders[n].load(f"{path}/base_{i}_{n}") for i, n in enumerate(spec.bases)]
    stack = StackModel(bases, GBTRegressionModel.load(f"{path}/meta"), list(spec.bases))
    numeric, categorical = list(spec.numeric), list(spec.categorical)
    scaler = PowerScaler(numeric, spark.read.parquet(f"{path}/lambdas"), spark.read.parquet(f"{path}/moments"))
    assembler = VectorAssembler(inputCols=[c + "_yj" for c in numeric] + [f"{c}_ohe" for c in categorical],
                                outputCol="features")
    return TrainedModel(scaler, PipelineModel.load(f"{path}/encoder"), assembler, stack,
                        spark.read.parquet(f"{path}/metrics"), list(spec.names), numeric, categorical)

