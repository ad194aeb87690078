"""Mergeable partial aggregates of silver, from which the six gold tables and the scaling divisors are merged (GLD-2..18, SLV-15).

``partials`` keeps one row per (key, Year, Month) and ``price_partials`` one per (key, Price, Year, Month). Both are stored in
``Year``/``Month`` folders like silver, so a batch that touches some months recomputes those rows only; the merge reads a table
whose size is keys x months (x at most 50,001 prices, as silver prices are cents from 0 to 500), whatever silver holds.

Counts, integer sums and decimal sums merge exactly. Means and squared deviations merge by the parallel rule: deviations within
each row, plus those of the rows' means from the common mean. No difference of large squares is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..sources.tables import checkpointed
from . import gold as G

KEYS = G.KEYS
PARTITION = ("Year", "Month")
REVENUE_DECIMAL = "decimal(26,2)"

#: Averages over exact decimals: name -> (column, decimal type, only where).
EXACT = {
    "discount": ("Discount", G.DISCOUNT_DECIMAL, None),
    "sales": ("Sales", G.SALES_DECIMAL, None),
    "sales_no_discount": ("Sales", G.SALES_DECIMAL, "Discount = 0"),
}


# The aggregates are written as SQL text: a refresh builds some hundred expressions for every micro-batch, and parsing a text is one
# call to the JVM where a tree of column functions is one for each of its nodes.


def _named(exprs: dict[str, str]) -> list[Column]:
    return [F.expr(e).alias(name) for name, e in exprs.items()]


def _exact_sums(name: str, value: str, kind: str) -> dict[str, str]:
    """A sum of doubles, the sum as exact decimals, and how many values the decimal can't carry (NaN, too large, too many digits)."""
    exact = f"TRY_CAST({value} AS {kind})"
    return {f"sum_{name}": f"sum({value})", f"exact_{name}": f"sum({exact})",
            f"lost_{name}": f"count_if({value} IS NOT NULL AND coalesce(CAST({exact} AS DOUBLE) != {value}, true))"}


def _moments(name: str, x: str, count: bool = True) -> dict[str, str]:
    out = {f"mean_{name}": f"avg({x})", f"m2_{name}": f"var_pop({x}) * count({x})", f"low_{name}": f"min({x})", f"high_{name}": f"max({x})"}
    return {f"n_{name}": f"count({x})", **out} if count else out


def partials(silver: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per (key, Year, Month): everything that five gold tables and the scaling need, in one aggregate."""
    both, price, rating = "Price IS NOT NULL AND Rating IS NOT NULL", "CAST(Price AS DOUBLE)", "CAST(Rating AS DOUBLE)"
    x, y = f"CASE WHEN {both} THEN {price} END", f"CASE WHEN {both} THEN {rating} END"
    rows = silver.withColumns({"_revenue": G.revenue_expr(), "_full_revenue": F.round(F.col("Price") * F.col("Sales"), 2)})
    out = {"n": "count(1)", **_exact_sums("revenue", "_revenue", REVENUE_DECIMAL), **_exact_sums("full_revenue", "_full_revenue", REVENUE_DECIMAL)}
    for name, (column, kind, only) in EXACT.items():
        value = f"CAST({column} AS DOUBLE)" if only is None else f"CASE WHEN {only} THEN CAST({column} AS DOUBLE) END"
        out |= {f"n_{name}": f"count({value})", **_exact_sums(name, value, kind)}
    out |= {"sum_sales_nz": "sum(coalesce(CAST(Sales AS DOUBLE), 0D))", "n_price": "count(Price)", "sum_price": f"sum({price})",
            "n_rating": "count(Rating)", "sum_rating": f"sum({rating})", "n_reviews": "count(NumReviews)", "sum_reviews": "sum(NumReviews)",
            "high_rating": f"count_if(Rating >= {S.HIGH_RATING})",
            **_moments("x", x), **_moments("y", y, count=False), "m2_xy": f"covar_pop({x}, {y}) * count({x})"}
    for c in S.SCALED_COLUMNS:
        out |= _moments(f"scaled_{c}", f"CAST({c} AS DOUBLE)")
    return rows.groupBy(*keys, *PARTITION).agg(*_named(out))


def price_partials(silver: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per (key, Price, Year, Month): the price ranges follow the global mean, so a price's range is known only at the merge."""
    return silver.groupBy(*keys, "Price", *PARTITION).agg(*_named({
        "n": "count(1)", "n_rating": "count(Rating)", "sum_rating": "sum(CAST(Rating AS DOUBLE))",
        "sum_sales_nz": "sum(coalesce(CAST(Sales AS DOUBLE), 0D))", "n_reviews": "count(NumReviews)", "sum_reviews": "sum(NumReviews)"}))


def _mean(total: str, n: str) -> str:
    return f"try_divide(CAST(sum({total}) AS DOUBLE), sum({n}))"


def _exact_avg2(name: str, kind: str) -> str:
    """round(avg, 2) as ``gold.exact_avg2`` has it: over exact decimals, unless one value of the group couldn't be carried."""
    scale = int(kind.rstrip(")").split(",")[1])
    total = f"TRY_CAST(sum(exact_{name}) AS decimal(28,{scale}))"
    exact = f"CAST(try_divide({total}, TRY_CAST(sum(n_{name}) AS decimal(10,0))) AS decimal(24,{scale + 4}))"
    whole = f"sum(lost_{name}) = 0 AND sum(n_{name}) < 10000000000 AND {total} IS NOT NULL"
    return f"CASE WHEN {whole} THEN CAST(round({exact}, 2) AS DOUBLE) ELSE round({_mean(f'sum_{name}', f'n_{name}')}, 2) END"


def _sum2(name: str) -> str:
    return f"CASE WHEN sum(lost_{name}) > 0 THEN sum(sum_{name}) ELSE CAST(sum(exact_{name}) AS DOUBLE) END"


def stats_from_partials(stored: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The columns of ``gold.category_stats``, merged from ``partials``. A key has as many rows as months."""
    over = Window.partitionBy(*keys)
    mean = {c: F.expr(f"n_x * mean_{c}") for c in "xy"}
    n = F.sum("n_x").over(over)
    rows = stored.withColumns({f"off_{c}": F.col(f"mean_{c}") - F.try_divide(F.sum(mean[c]).over(over), n) for c in "xy"})
    xx, yy, xy = (f"sum(m2_{c} + n_x * off_{a} * off_{b})" for c, a, b in (("x", "x", "x"), ("y", "y", "y"), ("xy", "x", "y")))
    # a mean of equal means can be off by a rounding: constant columns are known by their range
    varies = "min(low_x) < max(high_x) AND min(low_y) < max(high_y)"
    return rows.groupBy(*keys).agg(*_named({
        "_sum_revenue": _sum2("revenue"), "_sum_full_revenue": _sum2("full_revenue"),
        "_sum_sales": "sum(sum_sales)", "_sum_sales_nz": "sum(sum_sales_nz)", "_avg_price": _mean("sum_price", "n_price"), "_count": "sum(n)",
        **{f"_avg_{name}": _exact_avg2(name, kind) for name, (_, kind, _) in EXACT.items()},
        "_corr_price_rating": f"CASE WHEN {varies} THEN try_divide({xy}, sqrt({xx}) * sqrt({yy})) END",
        "_avg_rating": _mean("sum_rating", "n_rating"), "_avg_reviews": _mean("sum_reviews", "n_reviews"),
        "_sum_reviews": "sum(sum_reviews)", "_high_rating": "sum(high_rating)"}))


def price_satisfaction_from_partials(stored: DataFrame, by_price: DataFrame, keys: Sequence[str] = KEYS, ordered: bool = True) -> DataFrame:
    """``gold.price_satisfaction`` from both partial tables; the mean price is one row, joined by broadcast."""
    mean = stored.agg(*_named({"_mean_price": _mean("sum_price", "n_price")}))
    ranged = by_price.crossJoin(F.broadcast(mean)).withColumn("PriceRange", G.price_range("Price", "_mean_price"))
    priced = "CASE WHEN Price IS NOT NULL THEN n END"
    out = ranged.groupBy("PriceRange", *keys).agg(*_named({
        "AvgRating": f"round({_mean('sum_rating', 'n_rating')}, 2)",
        "AvgPrice": f"round(try_divide(sum(CAST(Price AS DOUBLE) * {priced}), sum({priced})), 2)",
        "TotalSales": "sum(sum_sales_nz)", "ProductCount": "sum(n)", "AvgReviews": f"round({_mean('sum_reviews', 'n_reviews')}, 0)"}))
    return out.orderBy(*keys, "PriceRange") if ordered else out


def gold_from_partials(stored: DataFrame, by_price: DataFrame, keys: Sequence[str] = KEYS) -> dict[str, DataFrame]:
    """All six gold tables. The partial tables are read once for the five (their merge is small and reused) and once for the sixth."""
    stats = checkpointed(stats_from_partials(stored, keys))
    by_stats = ("revenue_per_category", "discount_impact", "discount_effectiveness", "price_rating_correlation", "review_sales_ratio")
    tables = {name: getattr(G, name)(stats, keys) for name in by_stats}
    tables["price_satisfaction"] = price_satisfaction_from_partials(stored, by_price, keys)
    return {name: tables[name] for name in S.GOLD_TABLES}


def scaling_from_partials(stored: DataFrame) -> DataFrame:
    """One row: for each scaled column n, mean, m2 and the divisor (sample deviation; 0 where it is undefined or the column is constant)."""
    cols = S.SCALED_COLUMNS
    means = stored.agg(*_named({f"mean_{c}": f"try_divide(sum(n_scaled_{c} * mean_scaled_{c}), sum(n_scaled_{c}))" for c in cols}))
    out = {}
    for c in cols:
        off, n = f"(mean_scaled_{c} - mean_{c})", f"sum(n_scaled_{c})"
        m2 = f"sum(m2_scaled_{c} + n_scaled_{c} * {off} * {off})"
        varies = f"min(low_scaled_{c}) < max(high_scaled_{c}) AND {n} > 1"
        out |= {f"n_{c}": f"coalesce({n}, 0L)", f"mean_{c}": f"max(mean_{c})", f"m2_{c}": f"CASE WHEN {varies} THEN {m2} ELSE 0D END",
                f"sd_{c}": f"CASE WHEN {varies} THEN sqrt({m2} / ({n} - 1)) ELSE 0D END"}
    return stored.crossJoin(F.broadcast(means)).agg(*_named(out))


def scale_by(silver: DataFrame, scaling: DataFrame, cols: Sequence[str] = tuple(S.SCALED_COLUMNS)) -> DataFrame:
    """Silver with ``features`` and ``scaled_features``, by stored divisors (one row, joined by broadcast): no pass over silver for them."""
    joined = silver.crossJoin(F.broadcast(scaling.select(*(F.col(f"sd_{c}").alias(f"_sd_{c}") for c in cols))))
    raw = [F.col(c).cast("double") for c in cols]
    scaled = [F.when(x.isNotNull(), F.when(F.col(f"_sd_{c}") == 0, F.lit(0.0)).otherwise(F.try_divide(x, F.col(f"_sd_{c}")))) for c, x in zip(cols, raw)]
    return joined.select(*silver.columns, F.array(*raw).alias("features"), F.array(*scaled).alias("scaled_features"))
