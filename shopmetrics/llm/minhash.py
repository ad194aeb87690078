"""MinHash near-duplicates by a signature-coordinate inverted join (operator 1).

Every text's set of 5-word shingles gets a signature of ``COORDS`` minima. Texts are posted under
each (coordinate, value); two texts collide once for each list they share.

* Texts with equal sets are one class, posted once.
* Prefix: two texts of the least similarity (0.85 unless told otherwise) share at least ``matches`` of the 24 coordinates (but for
  a share ``MISSED`` of the pairs). So a text with fewer than ``matches`` shared lists has no partner, and any pair's shortest
  common list is not among the ``matches`` - 1 longest of either text: those long lists (stock phrases of very many
  documents) are skipped and only compared on the signatures.
* In a first round each list links its members to one hub, which joins the core of a group of
  copies by as many pairs as members. In a second round, only lists whose members are still in
  different components compare their members, in blocks of bounded size inside tasks, on signatures,
  sizes, a sketch of ``SKETCH`` more minima and the full sets. A task joins what it has linked and passes over pairs that are
  joined already: it writes a forest, never a group's pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmetrics.llm import text as X
from shopmetrics.llm.components import components
from shopmetrics.llm.store import drop, keep

WORDS, PERCENT = 5, 85
COORDS, MISSED = 24, 1.5e-7
#: Minima of the second sketch (a byte each).
SKETCH, SKETCH_MISSED = 1024, 1.4e-6
BLOCK = 512
#: Shingles of a bucket of list blocks, at the mean (8 bytes each).
BUCKET_SHINGLES = 1 << 22
#: A row: its id and its text's key.
ROW = ["doc_id", "t1", "t2"]

_R = np.random.default_rng(85)
_XOR = _R.integers(0, 2**63, COORDS + SKETCH, dtype=np.uint64)
_MUL = _R.integers(0, 2**62, COORDS + SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_equal(n: int, percent: int, missed: float) -> int:
    """Fewer than this many of ``n`` minima are equal in at most a share ``missed`` of the pairs of that similarity."""
    p, below = percent / 100, 0.0
    for k in range(n + 1):
        below += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
        if below > missed:
            return k
    return n


def shingle_sets(buf: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row."""
    for lo, hi in X.chunks(offsets):
        b, o = buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        starts, ends, first = X.word_bounds(b, o)
        words = X.word_hashes(b, starts, ends, lower=True)
        grams = X.gram_hashes(words, WORDS)
        for i in range(hi - lo):
            f, n = first[i], first[i + 1] - first[i]
            if n >= WORDS:
                yield lo + i, np.unique(grams[f : f + n - WORDS + 1])
            elif n:
                yield lo + i, X.gram_hashes(words[f : f + n], n, seed=n)
            else:
                yield lo + i, np.zeros(0, np.uint64)


def _minima(flat: np.ndarray, begins: np.ndarray, which: range) -> np.ndarray:
    return np.stack([np.minimum.reduceat((flat ^ _XOR[k]) * _MUL[k], begins) for k in which], axis=1)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = X.byte_column(batch.column("text"))
        part: list[tuple[int, np.ndarray]] = []
        size = 0
        for row, s in shingle_sets(buf, offsets):
            part.append((row, s))
            size += len(s)
            if size > 1 << 18:
                yield _signature_batch(batch, part)
                part, size = [], 0
        if part:
            yield _signature_batch(batch, part)


def _signature_batch(batch: pa.RecordBatch, part: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    n = np.array([len(s) for _, s in part])
    sig = np.zeros((len(part), COORDS), np.int32)
    a, b = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
    full = np.flatnonzero(n)
    if len(full):
        flat = np.concatenate([part[i][1] for i in full])
        begins = np.cumsum(n[full]) - n[full]
        sig[full] = (_minima(flat, begins, range(COORDS)) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        a[full] = np.add.reduceat(X.mix(flat + np.uint64(11)), begins).view(np.int64)
        b[full] = np.bitwise_xor.reduceat(X.mix(flat ^ np.uint64(0x5DEECE66D)), begins).view(np.int64)
    rows = pa.array([r for r, _ in part])
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * COORDS), pa.array(sig.ravel()))
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c).take(rows) for c in ROW), pa.array(n.astype(np.int64)), pa.array(a), pa.array(b), lists],
        names=[*ROW, "n_shingles", "set_a", "set_b", "sig"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rep, text -> rep, its shingle set, its second sketch."""
    for batch in batches:
        ids = batch.column("rep")
        buf, offsets = X.byte_column(batch.column("text"))
        part: list[tuple[int, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            n = np.array([len(s) for _, s in part])
            flat = np.concatenate([s for _, s in part])
            sketch = (_minima(flat, np.cumsum(n) - n, range(COORDS, COORDS + SKETCH)) >> np.uint64(40)).astype(np.uint8)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat.view(np.int64)))
            return pa.RecordBatch.from_arrays(
                [ids.take(pa.array([r for r, _ in part])), lists, pa.array([r.tobytes() for r in sketch], pa.binary())],
                names=["rep", "shingles", "sketch"])

        size = 0
        for row, s in shingle_sets(buf, offsets):
            if len(s):
                part.append((row, s))
                size += len(s)
            if size > 1 << 17:
                yield out()
                part, size = [], 0
        if part:
            yield out()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    one = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (pairs.join(one, "a").join(two, "b")
            .where(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)).select("a", "b"))


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _compare_lists(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    matches, sketch_least = least_equal(COORDS, percent, MISSED), least_equal(SKETCH, percent, SKETCH_MISSED)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        """Links of one bucket of list blocks, confirmed on the full sets: a forest. A pair that earlier links of the bucket have
        joined is not looked at again, so a bucket writes fewer links than it has members, however many pairs would be links."""
        found: list[tuple[int, int]] = []
        frame = frame.sort_values(["key", "one", "two"], kind="stable").reset_index(drop=True)
        same = (frame[["key", "one", "two"]].diff() == 0).all(axis=1).to_numpy()
        cuts = np.append(np.flatnonzero(~same), len(frame))
        sigs = np.stack(frame["sig"].to_numpy()).astype(np.int32)
        sketch = np.stack([np.frombuffer(x, np.uint8) for x in frame["sketch"]])
        sets = frame["shingles"].to_numpy()
        rep, size = (frame[c].to_numpy() for c in ("rep", "n"))
        block, coord, posted = frame["block"].to_numpy(), frame["coord"].to_numpy(), frame["posted"].to_numpy()
        known, code = np.unique(frame["label"].to_numpy(), return_inverse=True)
        root = np.arange(len(known))  # of each label: the set it is in by now
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            one, two = frame["one"].iat[lo], frame["two"].iat[lo]
            rows = np.arange(lo, hi)
            left, right = rows[block[lo:hi] == one], rows[block[lo:hi] == two]
            for at in range(0, len(left), 64):
                p = left[at : at + 64]
                ok = (root[code[p]][:, None] != root[code[right]][None]) & (
                    100 * np.minimum(size[p][:, None], size[right][None]) >= percent * np.maximum(size[p][:, None], size[right][None]))
                if one == two:
                    ok &= rep[p][:, None] < rep[right][None]
                i, j = np.nonzero(ok)
                i, j = p[i], right[j]
                agree = sigs[i] == sigs[j]
                # a pair is compared in the first list under which both are posted
                shared = posted[i] & posted[j]
                bits = (agree * (1 << np.arange(COORDS))).sum(axis=1) & shared
                ok = (agree.sum(axis=1) >= matches) & ((bits & -bits) == (1 << coord[lo]))
                i, j = i[ok], j[ok]
                for q in range(0, len(i), 1024):
                    a, b = i[q : q + 1024], j[q : q + 1024]
                    apart = root[code[a]] != root[code[b]]
                    a, b = a[apart], b[apart]
                    near = (sketch[a] == sketch[b]).sum(axis=1) >= sketch_least
                    for x, y in zip(a[near].tolist(), b[near].tolist()):
                        rx, ry = root[code[x]], root[code[y]]
                        if rx != ry and _linked(sets[x], sets[y], percent):
                            root[root == ry] = rx
                            found.append((rep[x], rep[y]))
        out = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": out.min(axis=1) if len(out) else out[:, 0], "b": out.max(axis=1) if len(out) else out[:, 1]})

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """Row per document: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable over links of similarity ``percent`` % (itself
    included). Texts that are null, empty or without words have an empty set and no link. Texts
    shorter than five words are one shingle. Repeated rows are copies of each other, a repeated id
    included, and each gives its row; rows that repeat an id with another text are documents of their own, linked by their own
    texts. A row with a null id links others, but its id is never a
    component's; a component of such rows alone has component_id null and kept false. Other columns are not read.
    """
    return grouped_rows(docs, id_col, text_col, percent).select("doc_id", "n_shingles", "component_id", "kept")


def row_key(text: str = "text") -> list:
    """128 bits of a text: with its id, a row's own key."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(13), text).alias("t2")]


def grouped_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``near_duplicates`` with their texts' keys t1, t2 and their ``group``: two groups may have one component_id, where
    both hold a text of that id."""
    matches = least_equal(COORDS, percent, MISSED)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select("doc_id", *row_key(), "text")
    table = keep(src.mapInArrow(_signatures, "doc_id long, t1 long, t2 long, n_shingles long, set_a long, set_b long, sig array<int>"), "signatures")
    # a class of equal sets is a node: its smallest id, but where classes share that one, for all but one of them a hash instead
    classes = (table.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b")
               .agg(F.min(F.struct(*ROW)).alias("own"), F.min("sig").alias("sig"), F.min("n_shingles").alias("n")))
    nth = F.row_number().over(Window.partitionBy("least").orderBy("set_a", "set_b"))
    stand_in = -1 - F.xxhash64("set_a", "set_b").bitwiseAND(F.lit((1 << 62) - 1))
    classes = keep(classes.select("set_a", "set_b", F.col("own.doc_id").alias("least"), "own.t1", "own.t2", "sig", "n")
                   .withColumn("rep", F.when(nth == 1, F.col("least")).otherwise(stand_in)), "classes")

    # lists of at least two texts; texts with too few of them leave; each skips its longest
    posts = classes.select("rep", F.posexplode("sig").alias("coord", "value"))
    lists = keep(posts.groupBy("coord", "value").agg(F.count("*").alias("length")).where("length > 1"), "lists")
    order = F.array_sort(F.collect_list(F.struct("length", "coord", "value")))
    short = keep(posts.join(lists, ["coord", "value"]).groupBy("rep").agg(order.alias("lists"))
                 .where(F.size("lists") >= matches)
                 .select("rep", F.slice("lists", F.lit(1), F.size("lists") - (matches - 1)).alias("lists")), "postings")
    member = classes.select("rep", "n", "sig")
    posted = keep(short.join(member, "rep").select(
        "rep", "n", "sig", F.expr("aggregate(lists, 0L, (x, y) -> x + shiftleft(1L, y.coord))").alias("posted"),
        F.explode("lists").alias("l")).select("rep", "n", "sig", "posted", "l.coord", "l.value"), "posted")

    # the full sets of the texts that have any possible partner
    # (how many those are isn't bounded: a merge join at every size)
    wanted = short.select("rep").join(classes.select("rep", F.col("least").alias("doc_id"), "t1", "t2"), "rep")
    sets = keep(src.join(wanted.hint("merge"), ROW).dropDuplicates(["rep"]).select("rep", "text")
                .mapInArrow(_full_sets, "rep long, shingles array<long>, sketch binary"), "sets")

    # first round: a hub for each list
    me = F.struct(F.xxhash64("rep").alias("o"), "rep", "n", "sig")
    hubs = posted.groupBy("coord", "value").agg(F.min(me).alias("hub"), F.count("*").alias("length")).where("length > 1")
    hubs = keep(hubs, "hubs")
    agree = F.size(F.filter(F.zip_with("sig", "hub.sig", lambda x, y: x == y), lambda x: x))
    star = (posted.join(hubs, ["coord", "value"]).where(F.col("rep") != F.col("hub.rep"))
            .where(100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n")).where(agree >= matches)
            .select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b")).distinct())
    linked = keep(_confirmed(star, sets, percent), "linked")
    label = keep(components(linked), "labels")

    # second round: lists whose members are still apart
    named = (posted.join(label.withColumnsRenamed({"node": "rep", "component": "label"}), "rep", "left")
             .withColumn("label", F.coalesce("label", "rep")))
    named = keep(named, "named")
    apart = keep(named.groupBy("coord", "value").agg(F.count("*").alias("length"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.sum("n").alias("shingles"))
                 .where("lo != hi").select("coord", "value", "length", "shingles"), "apart")
    blocks = F.ceil(F.col("length") / BLOCK)
    rows = (named.join(apart.drop("shingles"), ["coord", "value"]).join(sets, "rep")
            .withColumn("block", F.pmod(F.xxhash64("rep"), blocks))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
            .select("rep", "n", "sig", "posted", "label", "sketch", "shingles", "coord", "block", F.xxhash64("coord", "value").alias("key"),
                    F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")))
    # a bucket has so many rows, or so many shingles, at the mean
    total, size = apart.agg(F.sum(F.col("length") * blocks), F.sum(F.col("shingles") * blocks)).first()
    buckets = max(1, -(-int(total or 0) // (2 * BLOCK)), -(-int(size or 0) // BUCKET_SHINGLES))
    more = keep(rows.groupBy(F.pmod(F.xxhash64("key", "one", "two"), F.lit(buckets)).alias("bucket"))
                .applyInPandas(_compare_lists(percent), "a long, b long").distinct(), "linked")
    before, label = label, keep(components(linked.unionByName(more)), "labels")
    drop(lists, short, posted, sets, hubs, named, apart, linked, more, before)

    of = classes.select("set_a", "set_b", "rep", "least").join(
        label.withColumnsRenamed({"node": "rep", "component": "label"}), "rep", "left")
    of = of.select("set_a", "set_b", "least", F.coalesce("label", "rep").alias("group"), (F.col("rep") != F.col("least")).alias("odd"))
    # a group's smallest node is its smallest id, unless it has nodes of hashes
    odd = of.where("odd").select("group").distinct()
    low = of.join(odd, "group", "left_semi").groupBy("group").agg(F.min("least").alias("low"))
    one = of.join(low, "group", "left").select("set_a", "set_b", "group", F.coalesce("low", "group").alias("component"))
    named = table.select(*ROW, "n_shingles", "set_a", "set_b").join(
        one, (table.set_a == one.set_a) & (table.set_b == one.set_b) & (table.n_shingles > 0), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return named.select(*ROW, "n_shingles", component.alias("component_id"),
                        F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"), "group")
