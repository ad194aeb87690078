"""The medallion plan: bronze -> silver -> gold -> features, with lineage cut at the small, reused steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import features as FE
from ..operators import gold as G
from ..sources.tables import checkpointed

KEYS = ("Category",)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (survives executor loss; never local)."""
    return checkpointed(df)


def gold_from_silver(silver: DataFrame, keys: Sequence[str] = KEYS, share_stats: bool = True) -> dict[str, DataFrame]:
    """Six gold tables. With ``share_stats`` the fused per-key aggregate (one row per key, small
    whatever the input size) is checkpointed once, so the five tables built on it, and any join
    between them, do not each rescan and re-shuffle silver."""
    stats = G.category_stats(silver, keys)
    if share_stats:
        stats = materialize(stats)
    return G.gold_tables(silver, keys, stats=stats)


def features_from_silver(silver: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    stats = materialize(G.category_stats(silver, keys))
    gold = {
        "revenue_per_category": G.revenue_per_category(stats, keys, ordered=False),
        "discount_effectiveness": G.discount_effectiveness(stats, keys),
        "price_rating_correlation": G.price_rating_correlation(stats, keys),
        "review_sales_ratio": G.review_sales_ratio(stats, keys),
    }
    return FE.feature_frame(gold, keys)
