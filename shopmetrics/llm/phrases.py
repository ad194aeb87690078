"""Removal of repeated passages by phrase automata (operator 6).

1. Every document posts a sparse set of ``GRAM``-word phrases: of each window of ``WINDOW`` words the phrase of
   smallest hash, so that equal windows post equal phrases. Phrases posted twice or more are confirmed as
   recurring by one count.
2. Documents are dealt to shards of about ``SHARD_BYTES`` of text. A shard gets the confirmed phrases that its
   documents hold and compiles them to one Aho-Corasick automaton, so the automaton's size is
   bounded by the shard's text whatever the corpus holds. All its documents stream through it; around every occurrence
   it reports the windows of ``WINDOW`` words.
3. A shard keeps the first of equal windows and marks its others; one aggregate finds the first place of what is left
   over all shards, and occurrences elsewhere are marked too. Marked windows' words are removed. Whole texts that are equal are
   found as one phrase each, and all but the first are removed without more ado.

Phrases and windows of a passage that very many documents share are counted with map-side partial sums; phrases with a large share of
all posts are salted before they are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmetrics.llm import text as X
from shopmetrics.llm.store import drop, keep

WINDOW, GRAM = 20, 8
SHARD_BYTES = 1 << 21
HOT = 200


def _posted(words: np.ndarray) -> np.ndarray:
    """Places of the phrases that one document posts."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    w = WINDOW - GRAM + 1
    grams = X.gram_hashes(words, GRAM)
    low = X.sliding_min(grams, w)
    flip, edge = np.uint64(0xFFFFFFFFFFFFFFFF), np.zeros(w - 1, np.uint64)
    span = X.sliding_min(np.concatenate([edge, low, edge]) ^ flip, w) ^ flip  # largest minimum of the windows around a phrase
    return np.flatnonzero(grams <= span)


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases of each document and their places; and once its whole text, as a phrase at a negative place."""
    for batch in batches:
        ids, nths, shards = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "nth", "shard"))
        buf, offsets = X.byte_column(batch.column("text"))
        for lo, hi in X.chunks(offsets):
            b, o = buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            starts, ends, first = X.word_bounds(b, o)
            words = X.word_hashes(b, starts, ends)
            grams = X.gram_hashes(words, GRAM)
            at = [first[i] + _posted(words[first[i] : first[i + 1]]) for i in range(hi - lo)]
            row = np.repeat(np.arange(hi - lo), [len(x) for x in at])
            at = np.concatenate(at)
            whole = np.flatnonzero(np.diff(first) >= WINDOW)
            one, two = _text_hashes(words, first, whole)
            row = np.concatenate([row, whole])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([grams[at], one]).view(np.int64)), pa.array(shards[lo:hi][row]), pa.array(ids[lo:hi][row]), pa.array(nths[lo:hi][row]),
                 pa.array(np.concatenate([at - first[row[: len(at)]], two]).astype(np.int32))], names=["phrase", "shard", "doc_id", "nth", "place"])


def _text_hashes(words: np.ndarray, first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of whole texts: 64 bits, and 31 more as a negative number."""
    if not len(rows):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = np.arange(len(words), dtype=np.uint64) - np.repeat(first[:-1], np.diff(first)).astype(np.uint64)
    both = []
    for salt in (0x51ED270B35AE1F01, 0x7C0FFEE5B1A5ED03):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(X.mix(words + X.mix(place * np.uint64(2) + np.uint64(salt))))])
        both.append(X.mix(sums[first[rows + 1]] - sums[first[rows]]))
    return both[0], -1 - (both[1] >> np.uint64(33)).astype(np.int64)


_FOUND = "doc_id long, nth int, ha array<long>, hb array<int>, start array<int>, again_from array<int>, again_to array<int>"


def _locate(docs: pd.DataFrame, phrases: pd.DataFrame) -> pd.DataFrame:
    """Compile a shard's phrases, stream its documents through them.

    Returns of each document the windows that hold a located phrase and are the shard's first of their words (their hashes and starts),
    and the ranges of starts of windows that the shard has earlier.
    """
    columns = [c.split()[0] for c in _FOUND.split(", ")]
    docs = docs.sort_values(["doc_id", "nth"]).drop_duplicates(["doc_id", "nth"])
    raw = [t.encode().split() for t in docs["text"]]
    ids, nths = docs["doc_id"].to_numpy(), docs["nth"].to_numpy()
    where = {d: i for i, d in enumerate(zip(ids.tolist(), nths.tolist()))}
    copies, automaton = set(), ahocorasick.Automaton()
    for doc, nth, place, first in zip(*(phrases[c].tolist() for c in ("doc_id", "nth", "place", "first")), strict=True):
        if place >= 0:
            automaton.add_word((b" " + b" ".join(raw[where[doc, nth]][place : place + GRAM]) + b" ").decode(), 1)
        elif first < doc:
            copies.add(where[doc, nth])
    rows = [(ids[i], nths[i], [], [], [], [0], [len(raw[i]) - WINDOW + 1]) for i in sorted(copies)]
    if not len(automaton):
        return pd.DataFrame(rows, columns=columns)
    automaton.make_automaton()
    found: list[tuple] = []
    for row, words in enumerate(raw):
        n = len(words) - WINDOW + 1
        if n <= 0 or row in copies:
            continue
        line = (b" " + b" ".join(words) + b" ").decode()
        ends = np.fromiter((e for e, _ in automaton.iter(line)), dtype=np.int64)
        if not len(ends):
            continue
        gaps = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 32)
        joined = np.frombuffer(b" ".join(words), np.uint8)
        s, e, _ = X.word_bounds(joined, np.array([0, len(joined)]))
        hashes = X.word_hashes(joined, s, e)
        # a window counts if the phrase that it posts is among those located
        grams = X.gram_hashes(hashes, GRAM)
        located = np.full(len(grams), np.iinfo(np.uint64).max, np.uint64)
        at = np.searchsorted(gaps, ends) - GRAM
        located[at] = grams[at]
        begin = np.flatnonzero(X.sliding_min(located, WINDOW - GRAM + 1) == X.sliding_min(grams, WINDOW - GRAM + 1))
        one, two = X.gram_hashes(hashes, WINDOW)[begin], X.gram_hashes(hashes, WINDOW, seed=77)[begin]
        found.append((one.view(np.int64), (two >> np.uint64(32)).astype(np.uint32).view(np.int32), np.full(len(begin), row), begin.astype(np.int32)))
    if found:
        ha, hb, row, begin = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((begin, row, hb, ha))
        ha, hb, row, begin = ha[order], hb[order], row[order], begin[order]
        new = np.ones(len(ha), bool)
        new[1:] = (ha[1:] != ha[:-1]) | (hb[1:] != hb[:-1])
        # another text of the same id has its own first: neither comes before the other
        lowest = ids[row[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]]
        new[1:] |= (ids[row[1:]] == lowest[1:]) & (row[1:] != row[:-1])
        back = np.lexsort((begin, row))
        ha, hb, row, begin, new = ha[back], hb[back], row[back], begin[back], new[back]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1, [len(row)]])
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            mine = new[lo:hi]
            again = begin[lo:hi][~mine]
            edge = np.flatnonzero(np.diff(again) != 1)
            starts, stops = (again[np.append(0, edge + 1)], again[np.append(edge, -1)] + 1) if len(again) else (again, again)
            rows.append((ids[row[lo]], nths[row[lo]], ha[lo:hi][mine], hb[lo:hi][mine], begin[lo:hi][mine], starts, stops))
    return pd.DataFrame(rows, columns=columns)


def _cut(as_is: bool):
    """row, text, ranges of starts of windows to remove -> row, kept text and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _cut_batch(batch, as_is)

    return run


def _cut_batch(batch: pa.RecordBatch, as_is: bool) -> pa.RecordBatch:
    buf, offsets = X.byte_column(batch.column("text"))
    cuts = batch.column("repeats")
    texts, total, removed = [], [], []
    for i in range(batch.num_rows):
        raw = buf[offsets[i] : offsets[i + 1]].tobytes()
        words = kept = raw.split()
        if cuts[i].is_valid:
            begin, end = (np.asarray(cuts[i].values.field(k), dtype=np.int64) for k in (0, 1))
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, begin, 1)
            np.add.at(gone, end + WINDOW - 1, -1)
            kept = [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist(), strict=True) if not g]
        texts.append((raw if as_is and len(kept) == len(words) else b" ".join(kept)).decode())
        total.append(len(words))
        removed.append(len(words) - len(kept))
    return pa.RecordBatch.from_arrays(
        [batch.column("row"), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
        names=["row", "kept_text", "n_words", "n_removed"])


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``nth``: 0, but for rows that repeat an id with another text, whose texts are numbered from 0.

    Those rows alone are looked up: their table is joined by broadcast only where Spark finds its stored size small."""
    keyed = docs.withColumn("_key", F.xxhash64("text"))
    ids = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("_key"))
    several = ids.groupBy("doc_id").agg(F.min("_key").alias("lo"), F.max("_key").alias("hi")).where("lo != hi").select("doc_id")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("_key")) - 1
    others = keep(ids.join(several, "doc_id", "left_semi").distinct().withColumn("_nth", nth).where("_nth > 0"), "others")
    return keyed.join(others, ["doc_id", "_key"], "left").withColumn("nth", F.coalesce("_nth", F.lit(0))).drop("_key", "_nth")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, nth, repeats): ranges of starts of each document's windows whose words also start earlier.

    ``docs`` has doc_id long, nth int and text, none null; a window is earlier in a smaller doc_id, or in the
    same document at an earlier start.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()
    shards = max(1, -(-(size[0] or 0) // SHARD_BYTES))
    dealt = docs.select("doc_id", "nth", "text", F.pmod(F.xxhash64("doc_id", "nth"), F.lit(shards)).cast("int").alias("shard"))
    posts = keep(dealt.mapInArrow(_post, "phrase long, shard int, doc_id long, nth int, place int")
                 .withColumn("kind", F.least("place", F.lit(0))), "posts")
    again = keep(posts.groupBy("phrase", "kind").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
                 .where("n > 1").select("phrase", "kind", "first", "n"), "phrases")
    # phrases with one in HOT of all posts or more (HOT of them at most) are joined by as many salts
    least = max(1, posts.count() // HOT)
    hot = F.broadcast(again.where(F.col("n") > least).select("phrase", "kind", F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "nth"), F.lit(HOT)).cast("int")).otherwise(0)
    salts = F.when(F.col("n") > least, F.sequence(F.lit(0), F.lit(HOT - 1))).otherwise(F.array(F.lit(0)))
    met = posts.join(hot, ["phrase", "kind"], "left").withColumn("salt", salt).join(
        again.select("phrase", "kind", "first", F.explode(salts).alias("salt")), ["phrase", "kind", "salt"])
    copy = [F.when(F.col("kind") < 0, F.col(c)).alias(f"copy_{c}") for c in ("doc_id", "nth")]
    # nth and place of one row as one number, which a hash aggregate can carry
    at = F.shiftleft(F.col("nth").cast("long"), 32) + F.col("place")
    low = (F.pmod(F.col("at") + (1 << 31), F.lit(1 << 32)) - (1 << 31)).cast("int")
    needed = keep(met.groupBy("shard", "phrase", "kind", *copy)
                  .agg(F.max("doc_id").alias("doc_id"), F.max_by(at, "doc_id").alias("at"), F.min("first").alias("first"))
                  .withColumn("place", low).select("shard", "doc_id", F.shiftright(F.col("at") - F.col("place"), 32).cast("int").alias("nth"), "place", "first"), "needed")
    drop(posts, again)
    windows = keep(dealt.groupBy("shard").cogroup(needed.groupBy("shard")).applyInPandas(_locate, _FOUND), "windows")
    drop(needed)
    # a shard has one window of each hash and id here, so a document has it once and its place needs no more than its id
    each = windows.select("doc_id", "nth", F.inline(F.arrays_zip("ha", "hb", "start")))
    firsts = keep(each.groupBy("ha", "hb").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
                  .where("n > 1").select("ha", "hb", "first"), "firsts")
    far = each.join(firsts, ["ha", "hb"]).where("doc_id > first").select("doc_id", "nth", F.col("start").alias("b"), (F.col("start") + 1).alias("e"))
    near = windows.select("doc_id", "nth", F.inline(F.arrays_zip(F.col("again_from").alias("b"), F.col("again_to").alias("e"))))
    out = keep(far.unionByName(near.select("doc_id", "nth", "b", "e")).groupBy("doc_id", "nth").agg(F.collect_list(F.struct("b", "e")).alias("repeats")), "repeats")
    drop(windows, firsts)
    return out


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", as_is: bool = False) -> DataFrame:
    """The columns of ``docs`` without its text, and kept_text, n_words, n_removed.

    Words covered by a window of ``WINDOW`` words that also starts earlier are removed; the others
    are joined by one space (with ``as_is``, a text that loses nothing keeps its white space). A null text has no words. Texts of fewer words than a window are kept. Rows with
    a null id are kept whole and make no other text a repeat. Rows that repeat an id and text are one document:
    each is cut as the first would be. Rows that repeat an id with another text are documents of their own, none of them earlier than
    the other. Columns of ``docs`` named kept_text, n_words or n_removed are replaced.
    """
    plain = [c for c in docs.columns if c not in (text_col, "kept_text", "n_words", "n_removed")]
    packed = numbered(docs.select(F.struct(*plain).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    starts = repeated_windows(packed.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "nth", "text"))
    joined = packed.join(starts, ["doc_id", "nth"], "left").select("row", "text", "repeats")
    to = T.StructType([joined.schema["row"], T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()),
                       T.StructField("n_removed", T.LongType())])
    return joined.mapInArrow(_cut(as_is), to).select("row.*", "kept_text", "n_words", "n_removed")


def digest(texts: DataFrame) -> DataFrame:
    return texts.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
