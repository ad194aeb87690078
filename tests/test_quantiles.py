"""Exact quantiles by sketches and counting passes, against ``percentile`` over the same values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopmetrics.operators import features as FE
from shopmetrics.operators import quantiles as Q

SHARES = (0.0, 1 / 3, 0.6000000000000001, 0.999, 1.0)


def check(df, **columns):
    exprs = {c: F.expr(e) for c, e in columns.items()}
    got = Q.exact_quantiles(df, exprs, dict.fromkeys(columns, SHARES))
    for c, e in exprs.items():
        want = df.agg(F.percentile(F.when(~F.isnan(e.cast("double")), e.cast("double")), F.array(*[F.lit(p) for p in SHARES])).alias("q")).first()["q"]
        assert got[c] == pytest.approx(want, rel=1e-13, abs=1e-300), c


@pytest.mark.parametrize("few", [60, 2000])
def test_quantiles_of_many_shapes(spark, monkeypatch, few):
    monkeypatch.setattr(Q, "FEW", few)  # a bracket of sixty values takes all the passes that a large table would
    df = spark.range(8_000, numPartitions=5).select(
        (F.rand(1) * 1000).alias("even"), F.exp(F.randn(2) * 4).alias("wide"), F.when(F.rand(3) < 0.7, 5.0).otherwise(F.rand(4) * 10).alias("heavy"),
        F.when(F.rand(5) < 0.5, F.rand(6)).alias("nulls"), (F.col("id") % 4).alias("whole"), F.lit(7.5).alias("same"),
        F.when(F.col("id") % 10 == 0, float("nan")).otherwise(-F.col("id").cast("double")).alias("nan"))
    df = df.repartition(4)
    check(df, **{c: c for c in df.columns})


def test_quantiles_of_odd_tables(spark):
    one = spark.createDataFrame([(None, 4.0)], "a double, b double")
    assert Q.exact_quantiles(one, {"a": F.col("a"), "b": F.col("b")}, {"a": (0.5,), "b": (0.0, 0.3, 1.0)}) == {"a": [None], "b": [4.0, 4.0, 4.0]}
    assert Q.exact_quantiles(one.limit(0), {"b": F.col("b")}, {"b": (0.5,)}) == {"b": [None]}
    check(spark.createDataFrame([(1.0,), (2.0,)], "x double"), x="x")


def test_a_sketch_that_misses_is_made_good(spark, monkeypatch):
    monkeypatch.setattr(Q, "FEW", 100)
    monkeypatch.setattr(Q, "ERROR", 1e-9)
    df = spark.createDataFrame([(float(v),) for v in np.random.default_rng(3).normal(size=5000)], "x double")

    real = Q._Bracket.__init__
    monkeypatch.setattr(Q._Bracket, "__init__", lambda self, *a, **kw: real(self, *a, **{**kw, "error": 1e-9}))
    check(df, x="x")


def test_sketches_merge_over_batches(spark):
    df = spark.range(5000).select("id", (F.rand(1) * 100).alias("x"), (F.col("id") % 6).alias("batch"))
    one = Q.merged(Q.sketches(df, {"x": F.col("x")}, by=["batch"]), ["x"])
    n, mid = one.select(F.kll_sketch_get_n_double("x"), F.kll_sketch_get_quantile_double("x", F.lit(0.5))).first()
    assert n == 5000 and abs(df.where(F.col("x") <= mid).count() / 5000 - 0.5) < 0.02


def test_edges_of_the_features(spark):
    df = spark.createDataFrame([(float(i % 37), float(i * 7 % 101) - 20, 1) for i in range(500)], "AveragePrice double, DiscountROI double, k int")
    edges = FE.exact_edges(df)
    want = df.agg(F.percentile("AveragePrice", F.array(*[F.lit(p) for p in FE.QUINTILES])), F.percentile(
        F.greatest("DiscountROI", F.lit(0.0)), F.array(*[F.lit(p) for p in FE.TERCILES]))).first()
    assert edges["price"] == pytest.approx(want[0]) and edges["roi"] == pytest.approx(want[1]) and not any(map(math.isnan, edges["price"]))
