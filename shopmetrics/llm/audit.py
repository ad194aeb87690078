"""Filter interaction audit: what each filter removes, at each step of every order of the filters.

A document fails some of five filters: its mask. Every mask is mapped to one wide integer with a field for each of the 600 steps
(120 orders of 5), 1 where a document of that mask is removed at that step. The wide integers of a part's documents are added: in
each task as its rows come, then over tasks in two levels. The sum, unpacked, holds the removed documents of all steps; the other
columns follow from it. A field has 64 bits, more than any count of rows needs, so no sum carries into the field beside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shopmetrics.llm import text as X
from shopmetrics.llm.store import schema_with

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = [(o, s, f) for o in ORDERS for s, f in enumerate(o, 1)]
FIELD_BYTES = 8
WIDE_BYTES = FIELD_BYTES * len(STEPS)
#: Parts whose sums a task holds at once; beyond it they are sent on and begun anew (the sums are added later all the same).
PARTS_HELD = 256
#: Sums of one part that meet in a task, at each of the two levels above the tasks.
FAN_IN = 1024

#: The limits of the filters.
LEAST_WORDS = 100
LEAST_DISTINCT = 80
MOST_CAPITALS = 10
ODD = "#$%&*|"

_ODD = np.zeros(256, dtype=bool)
_ODD[[ord(c) for c in ODD]] = True


def wide(mask: int) -> int:
    """The wide integer of a mask (bit i: fails FILTERS[i]): its fields are 1 where such a document is removed."""
    out = 0
    for order_at, order in enumerate(ORDERS):
        first = next((s for s, f in enumerate(order) if mask >> FILTERS.index(f) & 1), None)
        if first is not None:
            out |= 1 << (8 * FIELD_BYTES * (len(FILTERS) * order_at + first))
    return out


WIDE = [wide(m) for m in range(1 << len(FILTERS))]


def text_masks(col: pa.Array) -> np.ndarray:
    """The mask of filters A to D of each text."""
    buf, offsets = X.byte_column(col)
    out = np.zeros(len(col), dtype=np.int32)
    for lo, hi in X.chunks(offsets):
        part, off = buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        starts, ends, first = X.word_bounds(part, off)
        words = np.diff(first)
        owner = np.repeat(np.arange(hi - lo), words)
        h = X.word_hashes(part, starts, ends)
        by = np.lexsort((h, owner))
        h, owner = h[by], owner[by]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        distinct = np.bincount(owner[new], minlength=hi - lo)

        def per_row(flag):
            sums = np.zeros(len(part) + 1, dtype=np.int64)
            np.cumsum(flag, out=sums[1:])
            return np.diff(sums[off])

        capitals, points = per_row((part >= 0x41) & (part <= 0x5A)), per_row((part & 0xC0) != 0x80)
        out[lo:hi] = ((words < LEAST_WORDS) | (100 * distinct < LEAST_DISTINCT * words) << 1
                      | (100 * capitals > MOST_CAPITALS * points) << 2 | (per_row(_ODD[part]) > 0) << 3)
    return out


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        masks = pa.array(text_masks(b.column("text")), pa.int32())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), b.column("t1"), b.column("t2"), masks],
                                         ["doc_id", "part", "t1", "t2", "mask"])


def _sums(held: dict) -> pa.RecordBatch:
    keys = list(held)
    cols = [[held[k][i].to_bytes(WIDE_BYTES, "little") for k in keys] for i in range(3)]
    counts = [[held[k][3][m] for m in range(len(WIDE))] for k in keys]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.string()), *(pa.array(c, pa.binary()) for c in cols), pa.array(counts, pa.list_(pa.int64()))],
        ["part", "removed", "good", "toxic", "masks"])


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the wide integers of rows (part, mask, good, toxic, n): n equal documents count n times."""
    held: dict[str, list] = {}
    for b in batches:
        for part, mask, good, toxic, n in zip(*(b.column(c).to_pylist() for c in ("part", "mask", "good", "toxic", "n"))):
            at = held.get(part)
            if at is None:
                if len(held) >= PARTS_HELD:
                    yield _sums(held)
                    held = {}
                at = held[part] = [0, 0, 0, [0] * len(WIDE)]
            add = WIDE[mask] if n == 1 else WIDE[mask] * n
            at[0] += add
            if good:
                at[1] += add
            if toxic:
                at[2] += add
            at[3][mask] += n
    if held:
        yield _sums(held)


def _add_sums(table: pa.Table) -> pa.Table:
    """One row of the sums of one part: the wide integers added."""
    out = [sum(int.from_bytes(x, "little") for x in table.column(c).to_pylist()) for c in ("removed", "good", "toxic")]
    masks = np.sum(np.array(table.column("masks").to_pylist(), dtype=np.int64), axis=0)
    return pa.table({"part": table.column("part").slice(0, 1), "removed": pa.array([out[0].to_bytes(WIDE_BYTES, "little")], pa.binary()),
                     "good": pa.array([out[1].to_bytes(WIDE_BYTES, "little")], pa.binary()),
                     "toxic": pa.array([out[2].to_bytes(WIDE_BYTES, "little")], pa.binary()),
                     "masks": pa.array([masks.tolist()], pa.list_(pa.int64()))})


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 600 rows of each part from its sums."""
    names = [n for n, _ in OUT]
    fails = np.array([[m >> FILTERS.index(f) & 1 for m in range(len(WIDE))] for f in FILTERS], dtype=np.int64)
    at = np.array([FILTERS.index(f) for _, _, f in STEPS])
    for b in batches:
        for part, removed, good, toxic, masks in zip(*(b.column(c).to_pylist() for c in ("part", "removed", "good", "toxic", "masks"))):
            removed, good, toxic = (np.frombuffer(x, dtype="<u8").astype(np.int64) for x in (removed, good, toxic))
            masks = np.array(masks, dtype=np.int64)
            kept = masks.sum() - np.cumsum(removed.reshape(-1, len(FILTERS)), axis=1).ravel()
            alone = masks[[1 << i for i in range(len(FILTERS))]]
            shapley = np.bincount(at, weights=removed, minlength=len(FILTERS)) if removed.max() < 2**40 else \
                np.array([removed[at == i].sum() for i in range(len(FILTERS))])
            cols = [[part] * len(STEPS), [o for o, _, _ in STEPS], [s for _, s, _ in STEPS], kept, removed,
                    (fails @ masks)[at] - removed, alone[at], good, toxic, shapley.astype(np.int64)[at]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, OUT)], names)


OUT = [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((n, pa.int64()) for n in (
    "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))]
OUT_SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, " \
             "good_lost long, toxic_lost long, shapley long"
SUMS_SCHEMA = "part string, removed binary, good binary, toxic binary, masks array<long>"


def masks(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, n): n documents of that part, mask and labels, several rows of the same kind.

    Equal texts are grouped by 128 bits of hash. A text's copies are counted by part, labels and mask with the smallest id among
    them, so the rows of a text are as few as its kinds and a text that a third of all documents hold stays small after the map
    side; only the rows of the smallest id of all pass filter E."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text")) \
        .select("doc_id", "part", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(13), "text").alias("t2"), "text")
    rows = rows.mapInArrow(_masked, schema_with(rows.drop("text"), "mask int"))
    kind = ["t1", "t2", "part", "mask"]
    same = rows.groupBy("doc_id", *kind).agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    # rows without an id have no labels; their texts' hashes spread them over the join
    spread = F.when(F.col("doc_id").isNull(), F.col("t1")).otherwise(0)
    named = same.withColumn("salt", spread).join(marks.withColumn("salt", F.lit(0).cast("long")), ["doc_id", "salt"], "left").select(
        "doc_id", *kind, "n", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    copies = named.groupBy(*kind, "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    lowest = F.min("least.doc_id").over(Window.partitionBy("t1", "t2"))
    passing = F.col("nameless") + F.when(F.col("least.doc_id") == lowest, F.col("least.n")).otherwise(0)
    judged = copies.select("part", "mask", "good", "toxic", "n", passing.alias("first"))
    kinds = F.array(F.struct(F.col("mask").alias("mask"), F.col("first").alias("n")),
                    F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("first")).alias("n")))
    return judged.select("part", "good", "toxic", F.inline(kinds)).where("n > 0").select("part", "mask", "good", "toxic", "n")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """For each part, filter order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A null or empty text has no words and fails A. A row without an id is no copy and makes none; rows that repeat the smallest id
    of a text are no copies of it. A document is good or toxic if any label row of its id says so. A null part is the empty string;
    an empty table gives no rows. Other columns are not read."""
    sums = masks(docs, labels, part).mapInArrow(_add_rows, SUMS_SCHEMA)
    salted = sums.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(FAN_IN)))
    for keys in (["part", "salt"], ["part"]):
        salted = salted.groupBy(*keys).applyInArrow(
            _keep_salt if "salt" in keys else _no_salt, SUMS_SCHEMA + (", salt int" if "salt" in keys else ""))
    return salted.mapInArrow(_unpack, OUT_SCHEMA)


def _keep_salt(table: pa.Table) -> pa.Table:
    return _add_sums(table).append_column("salt", table.column("salt").slice(0, 1))


def _no_salt(table: pa.Table) -> pa.Table:
    return _add_sums(table)
