"""Embedding near-duplicates by spherical-cap filters (operator 3).

Filter directions form a product code: the rotated space is cut into ``PARTS`` parts, each with ``CODES`` random
directions; a filter is one direction of each part. A vector is listed under every filter whose direction
it exceeds the threshold for; the list is decoded part by part, keeping only prefixes whose best completion can still exceed
it. Vectors of one label that share a filter are compared exactly, in double precision.

A filter with very many vectors is compared in blocks, so no task holds more than two blocks. A pair is reported by
the smallest filter that it shares, so it needs no later distinct. Equal vectors are one class, compared once.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmetrics.llm.components import components
from shopmetrics.llm.store import drop, keep

COSINE = 0.93
PARTS = 2
#: Filters that a vector exceeds, about; the threshold follows from it and the number of filters.
EXPECTED_FILTERS = 32
#: Rows for each filter, about: the code grows with the table, so the lists stay as short.
ROWS_PER_FILTER = 4
#: A vector that exceeds the threshold for fewer filters is listed under its best ones.
LEAST_FILTERS = 16
BLOCK = 512
SEED = 3


def codes_for(rows: int) -> int:
    """Directions of each part for a table of so many rows."""
    return max(32, int(np.ceil((rows / ROWS_PER_FILTER) ** (1 / PARTS))))


def filter_code(dim: int, size: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """A random rotation, the parts' unit directions and the parts' bounds."""
    rng = np.random.default_rng(SEED + dim)
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    parts = min(PARTS, dim)
    cuts = np.linspace(0, dim, parts + 1).astype(int)
    codes = [rng.normal(size=(size, n)) for n in np.diff(cuts)]
    return rotation, [c / np.linalg.norm(c, axis=1, keepdims=True) for c in codes], cuts


def list_decode(unit: np.ndarray, code: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all filters that each unit vector exceeds, LEAST_FILTERS at least."""
    rotation, codes, cuts = code
    dim = unit.shape[1]
    turned = unit @ rotation
    scores = [turned[:, a:b] @ c.T for a, b, c in zip(cuts[:-1], cuts[1:], codes, strict=True)]
    z = NormalDist().inv_cdf(1 - min(0.5, EXPECTED_FILTERS / len(codes[0]) ** len(codes)))
    need = z * np.sqrt(len(codes)) / np.sqrt(dim)
    best_rest = np.cumsum([s.max(axis=1) for s in scores][::-1], axis=0)[::-1]
    row, label, total = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
    # the threshold of a vector with few filters: what its LEAST_FILTERS-th best sum is, found from its best codes of each part
    top = [np.sort(s, axis=1)[:, ::-1][:, :LEAST_FILTERS] for s in scores]
    sums = top[0]
    for t in top[1:]:
        sums = np.sort((sums[:, :, None] + t[:, None, :]).reshape(len(unit), -1), axis=1)[:, ::-1][:, :LEAST_FILTERS]
    own = np.minimum(need, sums[:, -1]) - 1e-12
    for p, s in enumerate(scores):
        rest = best_rest[p + 1][row] if p + 1 < len(scores) else 0.0
        r, c = np.nonzero((total + rest)[:, None] + s[row] >= own[row][:, None])
        label, total, row = label[r] * len(codes[p]) + c, total[r] + s[row[r], c], row[r]
    return row, label


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that can link: vec_id, label, the vector as doubles."""
    for batch in batches:
        ids, labels, vectors = batch.column(0), batch.column(1), batch.column(2)
        at, out = [], []
        for i in range(batch.num_rows):
            if ids[i].is_valid and labels[i].is_valid and vectors[i].is_valid and vectors[i].values.null_count == 0:
                v = np.asarray(vectors[i].values, dtype=np.float64)
                if len(v) and np.isfinite(v).all() and v.any():
                    at.append(i)
                    out.append((v + 0.0).tobytes())
        at = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays([ids.take(at), labels.take(at), pa.array(out, pa.binary())], names=["vec_id", "label", "v"])


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _by_length(col) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    size = np.array([len(x) for x in col], dtype=np.int64)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield at, np.stack([np.frombuffer(col[i], np.float64) for i in at])


def _post(size: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at, v in _by_length(f["v"].to_numpy()):
                code = filter_code(v.shape[1], size)
                step = max(16, (1 << 18) // size)
                for lo in range(0, len(at), step):
                    rows, filters = list_decode(_unit(v[lo : lo + step]), code)
                    mine = f.iloc[at[lo : lo + step]]
                    order = np.lexsort((filters, rows))
                    rows, filters = rows[order], filters[order]
                    yield mine[["rep", "label", "v"]].assign(filters=np.split(filters, np.flatnonzero(np.diff(rows)) + 1))

    return run


def _compare(f: pd.DataFrame) -> pd.DataFrame:
    """Links of one bucket of filter blocks."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for (filt, label, one, two), g in f.groupby(["filter", "label", "one", "two"], sort=False):
        for at, v in _by_length(g["v"].to_numpy()):
            g2 = g.iloc[at]
            rep, filters, block = g2["rep"].to_numpy(), g2["filters"].to_numpy(), g2["block"].to_numpy()
            unit = _unit(v)
            left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
            cos = unit[left] @ unit[right].T
            i, j = np.nonzero(cos >= COSINE - 1e-9)
            i, j = left[i], right[j]
            if one == two:
                i, j = i[rep[i] < rep[j]], j[rep[i] < rep[j]]
            pick = [cosine(v[a], v[b]) >= COSINE and np.intersect1d(filters[a], filters[b], assume_unique=True)[0] == filt
                    for a, b in zip(i, j, strict=True)]
            out.append((rep[i[pick]], rep[j[pick]]))
    a = np.concatenate([x for x, _ in out]) if out else np.zeros(0, np.int64)
    b = np.concatenate([x for _, x in out]) if out else np.zeros(0, np.int64)
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def cosine(x: np.ndarray, y: np.ndarray) -> float:
    return float(x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """Row per vector: vec_id, n_links, component_id, kept.

    Only vectors of equal labels that aren't null link, at a cosine of ``COSINE`` or more. Null ids, labels and vectors, zero
    vectors, and vectors with null or non-finite components link with nothing and are their own component. Vectors of different lengths
    don't link. Equal vectors of a label link with each other; rows that repeat an id and vector are other vectors
    to each other. The filters are random: a link is found with a probability near 1 (measured in the tests), and none is invented.
    """
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                         F.col(vector_col).cast("array<double>").alias("v"))
    table = keep(src.mapInArrow(_classes, "vec_id long, label string, v binary"), "vectors")
    classes = keep(table.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")
    posts = keep(classes.mapInPandas(_post(codes_for(classes.count())), "rep long, label string, v binary, filters array<long>"), "posts")
    posted = posts.withColumn("filter", F.explode("filters"))
    size = keep(posted.groupBy("filter", "label").agg(F.count("*").alias("length")).where("length > 1"), "lengths")
    blocks = F.ceil(F.col("length") / BLOCK)
    rows = (posted.join(size, ["filter", "label"]).withColumn("block", F.pmod(F.xxhash64("rep"), blocks))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
            .select("rep", "label", "v", "filters", "filter", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")))
    total = size.agg(F.sum(F.col("length") * blocks)).first()[0] or 0
    buckets = max(1, -(-int(total) // (2 * BLOCK)))
    bucket = F.pmod(F.xxhash64("filter", "label", "one", "two"), F.lit(buckets)).alias("bucket")
    links = keep(rows.groupBy(bucket).applyInPandas(_compare, "a long, b long"), "links")
    label = keep(components(links), "labels")

    copies = classes.select(F.col("rep"), "copies")
    ends = links.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("rep"), F.col("a").alias("other")))
    others = (ends.join(copies.withColumnsRenamed({"rep": "other", "copies": "n"}), "other").groupBy("rep").agg(F.sum("n").alias("n")))
    info = (classes.join(others, "rep", "left").join(label.withColumnsRenamed({"node": "rep"}), "rep", "left")
            .select("label", "v", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    mine = table.join(keep(info, "info"), ["label", "v"]).groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    drop(posts, size)
    out = src.select("vec_id").join(mine, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
