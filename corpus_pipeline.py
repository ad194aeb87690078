"""A corpus from documents to packed sequences: five stages, each by one operator of ``shopmetrics.llm``.

Every stage takes (spark, docs, sf_dir) and all that the one before kept, and returns a DataFrame; ``run`` writes each as Parquet
in the shared folder and reads it again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmetrics.llm import langid, minhash, mixing, packing, phrases
from shopmetrics.llm.store import drop, keep, on_workers, table

#: A document goes if its language is unknown (no letter) or its pooled probability is under this.
LEAST_SCORE = 0.4
#: Documents that share so many % of their 5-word shingles are near copies.
LEAST_SIMILAR = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a recognised language. A null or empty text goes."""
    on_workers(spark)
    named = langid.identify(docs, *langid.fit(docs))
    return named.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies, of the smallest doc_id. Rows are what is grouped: one that repeats an id with another
    text stays or goes by its own group. Of rows that repeat an id and text one stays (the least by the other columns), of texts
    without words too. Rows with a null id stay."""
    on_workers(spark)
    groups = keep(minhash.grouped_rows(docs, percent=LEAST_SIMILAR), "groups")
    empty = [F.when(F.col("n_shingles") == 0, F.col(c)).alias(f"empty_{c}") for c in minhash.ROW]
    chosen = (groups.where("kept").groupBy("group", *empty).agg(F.min(F.struct(*minhash.ROW)).alias("row"))
              .select(*(F.col(f"row.{c}").alias(f"_{c}") for c in minhash.ROW)))
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    keyed = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("_doc_id"), F.xxhash64("text").alias("_t1"), F.xxhash64(F.lit(13), "text").alias("_t2"),
        F.struct("doc_id", *rest, "text").alias("_row"))
    # equal rows meet in the map tasks first; the join then finds them where they are
    key = [f"_{c}" for c in minhash.ROW]
    once = keyed.groupBy(*key).agg(F.min("_row").alias("_row"))
    return once.join(chosen, key).select("_row.*").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated passages from texts; a document that had nothing else goes."""
    on_workers(spark)
    cut = phrases.cut_repeats(docs, as_is=True).where("n_words = 0 OR n_removed < n_words")
    own = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return cut.select(*(own.get(c, F.col(c)).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it (0 to 2 times)."""
    on_workers(spark)
    passes = mixing.mix(docs).where("passes > 0").groupBy(F.col("doc_id").alias("mixed_id")).agg(F.max("passes").alias("passes"))
    mixed = docs.join(passes, F.col("doc_id").eqNullSafe(F.col("mixed_id")))
    return mixed.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes")))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix in sequences of at most 1024 tokens."""
    on_workers(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]

#: No stage but the second can be said in SQL; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        after = keep(stage(spark, docs, sf_dir), name)
        drop(docs)
        docs = after
    return docs
