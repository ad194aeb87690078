"""Exact top-k search by multi-resolution segment statistics (operator 8).

A vector is described at several resolutions by its segments' sums and deviations. For integer vectors q and x,
||q - x||^2 >= sum over segments of (length * (mean difference)^2 + (deviation difference)^2), so the inner
product (||q||^2 + ||x||^2 - ||q - x||^2) / 2 is at most
sum over segments of (length * mean * mean + deviation * deviation).
Queries meet all vectors in blocks; within a block pair the bounds go coarse to fine, each level over the
survivors of the one before, and exact scores are computed for what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmetrics.llm.store import keep

K = 20
SCALE = 64
QUERY_EVERY = 20
#: Segments of a vector at each resolution.
LEVELS = (4, 16)
QUERY_BLOCK, VECTOR_BLOCK = 512, 8192


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        keep_rows, out = [], []
        for i in range(batch.num_rows):
            if ids[i].is_valid and vectors[i].is_valid and vectors[i].values.null_count == 0:
                v = np.asarray(vectors[i].values, dtype=np.float64)
                if len(v) and np.isfinite(v).all():
                    keep_rows.append(i)
                    out.append(np.floor(v * SCALE).astype(np.int64))
        n = np.array([0, *(len(v) for v in out)])
        flat = np.concatenate(out) if out else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(keep_rows, pa.int64())), pa.ListArray.from_arrays(pa.array(np.cumsum(n).astype(np.int32)), pa.array(flat))],
            names=["vec_id", "v"])


def segment_statistics(v: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of the segments, and each vector's scaled means sqrt(n) * mean and deviations sqrt(n) * std."""
    cuts = np.linspace(0, v.shape[1], min(segments, v.shape[1]) + 1).astype(int)
    n = np.diff(cuts)
    total = np.add.reduceat(v, cuts[:-1], axis=1)
    square = np.add.reduceat(v * v, cuts[:-1], axis=1)
    return n, total / np.sqrt(n), np.sqrt(np.maximum(square - total * total / n, 0.0))


def search_block(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int = K, levels: tuple[int, ...] = LEVELS) -> list[tuple]:
    """The k best (score, then smaller id) of x for each row of q, but for its own id."""
    stats = [(segment_statistics(q, s), segment_statistics(x, s)) for s in levels]
    first = stats[0]
    # coarse bound of the whole block: one small product of statistics
    coarse = first[0][1] @ first[1][1].T + first[0][2] @ first[1][2].T
    slack = 1e-9 * (np.abs(coarse).max(initial=0.0) + 1.0) + 1e-6
    found = []
    for i in range(len(q)):
        other = x_ids != q_ids[i]
        # exact scores of the k best by the coarse bound give a floor that the answer can't be under
        live = np.flatnonzero(other)
        if len(live) > k:
            best = live[np.argpartition(-coarse[i, live], k - 1)[:k]]
            floor = (x[best] @ q[i]).min()
            live = live[coarse[i, live] + slack >= floor]
            for (_, qm, qd), (_, xm, xd) in stats[1:]:
                if len(live) <= k:
                    break
                bound = xm[live] @ qm[i] + xd[live] @ qd[i]
                sure = live[np.argpartition(-bound, k - 1)[:k]]
                floor = max(floor, (x[sure] @ q[i]).min())
                live = live[bound + slack >= floor]
        score = x[live] @ q[i]
        top = live[np.lexsort((x_ids[live], -score))[:k]]
        found.extend((int(q_ids[i]), int(x_ids[j]), int(x[j] @ q[i])) for j in top)
    return found


def _search(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
    out: list[tuple] = []
    if len(queries) and len(vectors):
        q_size, x_size = queries["v"].str.len().to_numpy(), vectors["v"].str.len().to_numpy()
        for d in np.unique(q_size):  # vectors of other lengths have no inner product
            a, b = queries[q_size == d], vectors[x_size == d]
            if len(b):
                out += search_block(a["vec_id"].to_numpy(), np.stack(a["v"].to_numpy()).astype(np.float64), b["vec_id"].to_numpy(),
                                    np.stack(b["v"].to_numpy()).astype(np.float64))
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = QUERY_EVERY, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of floor(64 x) of each query, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``; candidates all rows but the query's own. Vectors that are null, empty
    or hold null or non-finite components, and rows with a null id, take no part; vectors of another length than the query's
    aren't its candidates. A repeated id counts once, with its smallest vector. Scores are exact while they stay under 2**53.
    """
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    table = keep(own.mapInArrow(_scaled, "vec_id long, v array<long>").groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    n, m = table.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    vector_blocks, query_blocks = max(1, -(-n // VECTOR_BLOCK)), max(1, -(-m // QUERY_BLOCK))
    block = lambda seed, blocks: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(blocks))
    all_of = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    q = table.where(is_query).withColumn("qb", block(1, query_blocks)).withColumn("xb", all_of(vector_blocks))
    x = table.withColumn("xb", block(2, vector_blocks)).withColumn("qb", all_of(query_blocks))
    near = (q.groupBy("qb", "xb").cogroup(x.groupBy("qb", "xb"))
            .applyInPandas(_search, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
