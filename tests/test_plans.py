"""Plan-shape checks: the properties the design relies on at scale."""

import os

import pytest
from pyspark.sql import functions as F

from shopmetrics import schema as S
from shopmetrics.operators import gold as G
from shopmetrics.operators import lookup as LK
from shopmetrics.operators import silver as SV
from shopmetrics.plans import catalog as C

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dedupe_combines_map_side(spark):
    plan = physical(C.q_silver_dedupe(spark, SF))
    assert "partial_max" in plan           # hot keys shrink before the shuffle
    assert "Window" not in plan


def test_fixture_dimensions_are_broadcast_and_scan_is_pruned(spark):
    df = C.QUERIES["gold_revenue_per_category"](spark, SF)
    plan = physical(df)
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan  # the part, for its category
    li_scan = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln][0]
    assert "l_returnflag" not in li_scan   # columns the query does not use are not read
    silver = physical(C.QUERIES["silver_products"](spark, SF))
    assert silver.count("BroadcastHashJoin") == 3


UNUSED = ("p_name", "supplier.parquet", "nation.parquet", "l_linestatus", "City", "ProductName", "StockStatus", "DateAdded")


@pytest.mark.parametrize("name", [n for n in C.QUERIES if n.startswith(("gold_", "lookup_", "features_", "ml_request", "profile_s"))
                                  and n not in ("lookup_strict",)])
def test_the_dedupe_carries_needed_columns_only(spark, name):
    """Neither scans nor the struct under max nor any join has what the query doesn't use."""
    plan = physical(C.QUERIES[name](spark, SF))
    assert not [c for c in UNUSED if c in plan]


def test_single_gold_table_prunes_other_aggregates(spark):
    plan = optimized(C.QUERIES["gold_revenue_per_category"](spark, SF))
    assert "covar_pop" not in plan and "stddev_pop" not in plan


def test_lookup_filter_is_below_the_gold_aggregate(spark):
    silver = C.silver(spark, SF)
    df = LK.lookup(G.revenue_per_category(G.category_stats(silver), ordered=False), "PROMO")
    lines = optimized(df).splitlines()
    agg = min(i for i, ln in enumerate(lines) if "Aggregate [Category" in ln)
    flt = [i for i, ln in enumerate(lines) if "Filter" in ln and "PROMO" in ln]
    assert flt and flt[0] > agg             # deeper in the tree = evaluated before the aggregate


def test_no_python_udf_in_the_plans(spark):
    for name in ("silver_products", "gold_price_satisfaction", "features_performance", "ingest_csv_valid"):
        plan = physical(C.QUERIES[name](spark, SF))
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_hot_key_dedupe_is_exact(spark):
    # one product holds a third of all rows
    n = 3000
    rows = [(0 if i % 3 == 0 else i, f"p{i}", "c", float(i), 3.0, 1, 1, 1.0, 0, "2024-01-01", "x", True,
             f"2024-01-01T{(i // 3600) % 24:02d}:{(i // 60) % 60:02d}:{i % 60:02d}") for i in range(n)]
    df = spark.createDataFrame(rows, S.BRONZE_SCHEMA).repartition(16)
    out = {r.ProductID: r.Price for r in SV.latest_per_product(df).collect()}
    hot_last = max(i for i in range(n) if i % 3 == 0)
    assert out[0] == float(hot_last) and len(out) == 1 + sum(1 for i in range(n) if i % 3)
    agg = G.category_stats(SV.clean_products(SV.latest_per_product(df)))
    assert agg.select(F.sum("_count")).first()[0] == len(out)


def test_wide_rows_meet_in_even_tasks_before_the_dedupe_sorts_them(spark):
    plan = physical(C.q_silver_dedupe(spark, SF))
    # by a hash of the key: the partial aggregate still comes between, and a hot key's partition may be split
    assert plan.index("partial_max") < plan.index("REBALANCE_PARTITIONS_BY_COL")
    assert plan[:plan.index("partial_max")].count("Exchange hashpartitioning(ProductID") == 1


def test_silver_range_read_prunes_partitions(spark, workdir):
    from shopmetrics.sources import tables as TB
    s = C.silver(spark, SF)
    TB.write_table(s, f"{workdir}/silver", partition_by=["Year", "Month"])
    y0 = s.agg(F.min("Year")).first()[0] + 1
    lo, hi = (y0, 6), (y0 + 1, 2)
    df = TB.read_silver(spark, f"{workdir}/silver", since=lo, until=hi)
    plan = physical(df)
    assert "PartitionFilters: [isnotnull(Year" in plan or "PartitionFilters: [(" in plan
    got = sorted({(r.Year, r.Month) for r in df.select("Year", "Month").distinct().collect()})
    want = sorted({(r.Year, r.Month) for r in s.select("Year", "Month").distinct().collect()
                   if r.Year is not None and lo <= (r.Year, r.Month) <= hi})
    assert got == want and got


def test_gold_at_finer_grain_adds_up(spark):
    s = C.silver(spark, SF)
    fine = G.revenue_per_category(G.category_stats(s, ("Category", "Year")), ("Category", "Year"), ordered=False)
    coarse = G.revenue_per_category(G.category_stats(s), ordered=False)
    a = {r.Category: r.n for r in fine.groupBy("Category").agg(F.sum("ProductCount").alias("n")).collect()}
    b = {r.Category: r.ProductCount for r in coarse.collect()}
    assert a == b


def test_lookup_on_stored_gold_pushes_filter_to_scan(spark, workdir):
    from shopmetrics.plans import medallion as MD
    from shopmetrics.sources import tables as TB
    TB.write_gold(MD.gold_from_silver(C.silver(spark, SF)), f"{workdir}/gold")
    df = LK.lookup(TB.read_gold(spark, f"{workdir}/gold", "review_sales_ratio"), "PROMO")
    scan = [ln for ln in physical(df).splitlines() if "FileScan parquet" in ln][0]
    assert "EqualTo(Category,PROMO)" in scan
    assert [r.Category for r in df.collect()] == ["PROMO"]


def test_partitioned_write_rebalances(spark, workdir):
    import glob
    from shopmetrics.sources import tables as TB
    s = C.silver(spark, SF)
    TB.write_table(s, f"{workdir}/reb", partition_by=["Year", "Month"])
    assert TB.read_table(spark, f"{workdir}/reb").count() == s.count()
    folders = glob.glob(workdir.replace("file:", "") + "/reb/Year=*/Month=*")
    files = glob.glob(workdir.replace("file:", "") + "/reb/Year=*/Month=*/*.parquet")
    assert len(files) <= 2 * len(folders)     # not one file per task per folder


def test_price_satisfaction_reuses_the_dedupe_shuffle(spark):
    df = C.QUERIES["gold_price_satisfaction"](spark, SF)
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final           # the mean-price branch reads the same shuffle
    assert final.count("FileScan parquet") == 2  # lineitem and part, each scanned once


def test_sales_stats_read_the_fact_table_once(spark):
    df = C.QUERIES["profile_sales_stats"](spark, SF)
    df.collect()
    assert physical(df).split("== Initial Plan ==")[0].count("FileScan parquet") == 1


def test_incremental_merge_does_not_shuffle_the_state(spark):
    from shopmetrics.plans import refresh as RF
    prev = SV.latest_per_product(FX_bronze(spark))
    batch = FX_bronze(spark).where(F.col("ProductID") < 5)
    merged = RF.merge_latest(prev.checkpoint(), batch.checkpoint())
    merged.collect()
    final = physical(merged).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "LeftAnti" in final
    # the previous state reaches the anti-join without a shuffle of its own
    anti = [ln for ln in final.splitlines() if "LeftAnti" in ln][0]
    assert "BroadcastHashJoin" in anti


def FX_bronze(spark):
    from shopmetrics.sources import fixture as FX
    from shopmetrics.sources.tables import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return FX.drop_tie_break(FX.bronze_from_tpch(spark, SF))
