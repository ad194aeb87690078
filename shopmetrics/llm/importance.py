"""Importance resampling to a target distribution, over deduplicated segments.

Features are runs of 1 to ``grams`` words, hashed to buckets. A text is cut at its newlines; the features inside a line are taken once
for each distinct line of the corpus and multiplied by the line's occurrences. Runs that cross a line's end are added apart, from the
texts. The same holds for the scores: a distinct line's gains are summed once and joined to the documents that have it.

What reaches the driver is one number per bucket. Lines and documents stay in Spark; a line of one in 200 of all occurrences or
more (of which there are at most 200) is salted before the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmetrics.llm import alnum as A
from shopmetrics.llm import text as X
from shopmetrics.llm.store import drop, keep, schema_with

#: Lines of at least 1 / HOT of all occurrences are salted (so at most HOT lines).
HOT = 200
#: A document: its id and 128 bits of its text. Rows that agree in both share their work and are counted.
ROW = ["doc_id", "t1", "t2"]
FEATURES = "l1 long, l2 long, n long, n_words long, buckets array<int>"


def _buckets(buf, starts, ends, row: np.ndarray, rows: int, grams: int, buckets: int, lines: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(offsets by row, buckets) of the runs of 1 to ``grams`` words of each row; with ``lines``, of those that cross a line's end alone."""
    buf, starts, ends = A.joined(buf, starts, ends)
    of, owner = [], []
    for k in range(1 if lines is None else 2, grams + 1):
        n = len(starts) - k + 1
        if n <= 0:
            break
        take = row[:n] == row[k - 1 :]
        if lines is not None:
            take &= lines[:n] != lines[k - 1 :]
        at = np.flatnonzero(take)
        of.append((A.crc32_spans(buf, starts[at], ends[at + k - 1]) % np.uint32(buckets)).astype(np.int32))
        owner.append(row[at])
    if not of:
        return np.zeros(rows + 1, np.int64), np.zeros(0, np.int32)
    of, owner = np.concatenate(of), np.concatenate(owner)
    if grams > 1:
        by = np.argsort(owner, kind="stable")
        of, owner = of[by], owner[by]
    return np.searchsorted(owner, np.arange(rows + 1)), of


def _line_features(grams: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, starts, ends, first in A.word_chunks(b.column("line")):
                words = np.diff(first)
                offsets, of = _buckets(buf, starts, ends, np.repeat(np.arange(hi - lo), words), hi - lo, grams, buckets)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(lo, hi - lo) for c in ("l1", "l2", "n")), pa.array(words, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(of, pa.int32()))], ["l1", "l2", "n", "n_words", "buckets"])
    return run


def _crossing_features(grams: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("text")
            raw, _ = X.byte_column(col)
            done = 0
            for lo, hi, buf, starts, ends, first in A.word_chunks(col):
                ends_of_lines = np.flatnonzero(raw[done : done + len(buf)] == 10)
                done += len(buf)
                lines = np.searchsorted(ends_of_lines, starts)
                offsets, of = _buckets(buf, starts, ends, np.repeat(np.arange(hi - lo), np.diff(first)), hi - lo, grams, buckets, lines)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(lo, hi - lo) for c in ROW), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(of, pa.int32()))],
                    [*ROW, "buckets"])
    return run


def _counted(buckets: int):
    """(bucket, n): each row's buckets times its occurrences, added in the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            lists = b.column("buckets")
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            of = lists.flatten().to_numpy(zero_copy_only=False)
            times = np.repeat(b.column("n").to_numpy(zero_copy_only=False), size)
            # in whole numbers: a sum of weights in doubles is exact to 2**53 only
            high, low = times >> 20, times & 0xFFFFF
            total += (np.bincount(of, weights=high, minlength=buckets).astype(np.int64) << 20) \
                + np.bincount(of, weights=low, minlength=buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])
    return run


def _gained(gains: np.ndarray, keys: list[str]):
    """Each row's sum of gains and number of features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("buckets")
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.zeros(len(lists.flatten()) + 1, dtype=np.int64)
            np.cumsum(gains[lists.flatten().to_numpy(zero_copy_only=False)], out=sums[1:])
            stop = np.cumsum(size)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keys), pa.array(sums[stop] - sums[stop - size], pa.int64()), pa.array(size, pa.int64())],
                                             [*keys, "gain", "n_features"])
    return run


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(text.alias("text"), *(c for c in docs.columns if c == "doc_id")).select(
        *(c for c in docs.columns if c == "doc_id"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(13), "text").alias("t2"), "text")


def _line_key(line: str) -> list:
    return [F.xxhash64(line).alias("l1"), F.xxhash64(F.lit(17), line).alias("l2")]


def line_features(docs: DataFrame, grams: int, buckets: int) -> DataFrame:
    """(l1, l2, n, n_words, buckets): the features of each distinct line of ``text`` and its occurrences, written once."""
    lines = _rows(docs).select(F.explode(F.split("text", "\n")).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    return keep(lines.select(*_line_key("line"), "n", "line").mapInArrow(_line_features(grams, buckets), FEATURES), "lines")


def crossing_features(docs: DataFrame, grams: int, buckets: int) -> DataFrame | None:
    """(doc_id, t1, t2, buckets) of the runs that cross line ends; None where runs are single words."""
    if grams < 2:
        return None
    rows = _rows(docs if "doc_id" in docs.columns else docs.withColumn("doc_id", F.lit(None).cast("long")))
    return keep(rows.mapInArrow(_crossing_features(grams, buckets), schema_with(rows.select(*ROW), "buckets array<int>")), "crossing")


def bucket_counts(lines: DataFrame, crossing: DataFrame | None, buckets: int) -> np.ndarray:
    """Features by bucket over all occurrences: one number per bucket reaches the driver."""
    rows = lines.select("n", "buckets")
    if crossing is not None:
        rows = rows.unionByName(crossing.select(F.lit(1).cast("long").alias("n"), "buckets"))
    out = np.zeros(buckets, dtype=object)
    for r in rows.mapInArrow(_counted(buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio of frequencies) by bucket."""
    n = len(corpus)
    top = (target.astype(np.float64) + 1) * float(int(corpus.sum()) + n)
    return np.floor(1000 * np.log(top / ((corpus.astype(np.float64) + 1) * float(int(target.sum()) + n)))).astype(np.int64)


def weights(docs: DataFrame, target: DataFrame, grams: int = 1, buckets: int = 10_000) -> DataFrame:
    """(doc_id, t1, t2, n, n_words, n_features, gain): one row for each document, n rows of which are equal."""
    lines, crossing = line_features(docs, grams, buckets), crossing_features(docs, grams, buckets)
    wanted, over = line_features(target, grams, buckets), crossing_features(target, grams, buckets)
    gains = bucket_gains(bucket_counts(lines, crossing, buckets), bucket_counts(wanted, over, buckets))
    schema = "l1 long, l2 long, n long, n_words long, gain long, n_features long"
    scored = keep(lines.mapInArrow(_gained(gains, ["l1", "l2", "n", "n_words"]), schema), "line_gains")
    drop(lines, wanted)
    total = scored.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    hot = scored.join(F.broadcast(total), F.col("n") * HOT >= F.col("total")).select("l1", "l2", F.lit(True).alias("hot"))
    salts = F.sequence(F.lit(0), F.lit(HOT - 1))
    own = _rows(docs).select(*ROW, F.posexplode(F.split("text", "\n")).alias("pos", "line")).select(
        *ROW, (F.col("pos") == 0).alias("head"), *_line_key("line"))
    own = own.join(F.broadcast(hot), ["l1", "l2"], "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64(*ROW), F.lit(HOT)).cast("int")).otherwise(0)).drop("hot")
    spread = scored.join(F.broadcast(hot), ["l1", "l2"], "left").select(
        "l1", "l2", "n_words", "gain", "n_features", F.explode(F.when(F.col("hot"), salts).otherwise(F.array(F.lit(0)))).alias("salt"))
    parts = own.join(spread.hint("merge"), ["l1", "l2", "salt"]).select(*ROW, F.col("head").cast("long").alias("head"), "n_words", "gain", "n_features")
    if crossing is not None:
        cross = crossing.mapInArrow(_gained(gains, ROW), schema_with(crossing.select(*ROW), "gain long, n_features long"))
        parts = parts.unionByName(cross.select(*ROW, F.lit(0).cast("long").alias("head"), F.lit(0).cast("long").alias("n_words"), "gain", "n_features"))
    whole = parts.groupBy(*ROW).agg(F.sum("head").alias("n"), *(F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")))
    # n equal rows have added n times the same
    return whole.select(*ROW, "n", *(F.expr(f"{c} div n").alias(c) for c in ("n_words", "n_features", "gain")))


def resample(docs: DataFrame, target: DataFrame, grams: int = 1, buckets: int = 10_000, least_words: int = 20, percent: int = 10,
             seed: str = "2024") -> DataFrame:
    """doc_id, n_features, weight, score, rank (null: not drawn) for each row of ``docs`` (doc_id, text; others are not read).

    The floor(percent * N / 100) greatest scores of the N documents of ``least_words`` words are drawn, ties to the smaller doc_id, a null
    id last and drawn by the hash of no characters. A null or empty text has no words; its weight is 0. Rows that repeat an id and text
    have one score and a rank each; rows that repeat an id with another text are documents of their own. An empty target gives
    every bucket the gain of no occurrences."""
    floor_mean = F.expr("CASE WHEN n_features = 0 THEN 0 ELSE (gain - pmod(gain, n_features)) div n_features END")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    luck = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = keep(weights(docs, target, grams, buckets).withColumn("weight", floor_mean).withColumn("score", F.col("weight") + luck)
                  .withColumn("drawable", F.col("n_words") >= least_words), "scores")
    # scores are whole numbers within about +-60,000 (1000 ln of the ratios that counts allow), so their histogram is small at any size
    levels = scored.where("drawable").groupBy("score").agg(F.sum("n").alias("level"))
    levels = levels.select("score", (F.sum("level").over(Window.orderBy(F.col("score").desc())) - F.col("level")).alias("above"),
                           F.sum("level").over(Window.partitionBy()).alias("all"))
    within = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "t1", "t2")
    # the level that the draw ends in is the last whose documents need an order
    drawn = scored.where("drawable").join(F.broadcast(levels.where(F.col("above") < F.floor(percent * F.col("all") / 100))), "score")
    ranked = drawn.withColumn("last", F.col("above") + F.sum("n").over(within)).select(
        "doc_id", "n_features", "weight", "score", F.floor(percent * F.col("all") / 100).alias("draw"),
        F.explode(F.sequence(F.col("last") - F.col("n") + 1, F.col("last"))).alias("rank"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= F.col("draw"), F.col("rank"))).drop("draw")
    rest = scored.join(F.broadcast(levels.where(F.col("above") < F.floor(percent * F.col("all") / 100)).select(F.col("score").alias("level"))),
                       F.col("drawable") & (F.col("score") == F.col("level")), "left_anti")
    rest = rest.select("doc_id", "n_features", "weight", "score", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")).drop("copy")
    return ranked.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))
