"""Best-fit packing of token sequences by a configuration linear program (operator 7).

Texts become pieces of at most ``CAPACITY`` tokens. The program has a row for each piece length and a variable for
each configuration (a multiset of lengths that fits); it needs the length histogram alone, at most ``CAPACITY`` numbers, whatever the
corpus. Multiplicative weights solve it: lengths that are covered least weigh most, and a knapsack dynamic program prices the
configuration of greatest weight. The solution is rounded, and solved anew for the pieces that are left, in a few phases; what then is left is
packed best-fit, longest first, on the histogram. Spark tokenizes, counts, numbers the pieces of each length, and each piece finds its
place by its number.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmetrics.llm import text as X
from shopmetrics.llm.store import keep

CAPACITY = 1024
END_ID = 2
#: Phases; in each, rounds of the multiplicative weights, and the share by which a round's full cover changes a weight.
PHASES, ROUNDS, STEP = 12, 100, 0.3
#: A length's weight at a phase's start is its power: over 1, long pieces are placed while short ones are left to fill up beside them.
POWER = 1.3
#: A configuration is used if it leaves this many tokens at most.
SLACK = 4
#: Bytes of text that share one table of distinct segments.
ROUND_BYTES = 1 << 22
#: Pieces of one numbering range, about.
RANGE_ROWS = 4000

# Tokens


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The tokenizer, and for its plain segments an encoder that joins the same merges faster."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tok, tiktoken.Encoding("segments", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _odd_space(buf: np.ndarray) -> np.ndarray:
    """Places of white space outside ASCII's six (and of the separators 1C to 1F)."""
    hit = (buf >= 0x1C) & (buf <= 0x1F)
    if len(buf) > 1:
        a, b = buf[:-1], buf[1:]
        hit[:-1] |= (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    if len(buf) > 2:
        a, b, c = buf[:-2], buf[1:-1], buf[2:]
        hit[:-2] |= ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        hit[:-2] |= (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    return np.flatnonzero(hit)


def _segments(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of segments that the tokenizer never merges across, and the first segment of each row.

    A word takes a space right before it; what white space is left before that is a segment, and
    so is a last white space that isn't a space.
    """
    s, e, first = X.word_bounds(buf, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    before = np.empty_like(s)
    if len(s):
        before[1:] = e[:-1]
        lead = first[:-1][np.diff(first) > 0]
        before[lead] = offsets[row[lead]]
    gap = s - before
    spaced = (gap > 0) & (buf[np.maximum(s - 1, 0)] == 32)
    last = offsets[:-1].copy()
    full = np.diff(first) > 0
    last[full] = e[first[1:][full] - 1]
    tail = last < offsets[1:]
    starts = np.concatenate([before[gap > 1], (s - 1)[(gap > 0) & ~spaced], s - spaced, last[tail]])
    ends = np.concatenate([(s - 1)[gap > 1], s[(gap > 0) & ~spaced], e, offsets[1:][tail]])
    order = np.argsort(starts, kind="stable")
    starts = starts[order]
    return starts, ends[order], np.searchsorted(starts, offsets)


class _Known:
    """Ids of the segments that a worker has met, by hash: sorted hashes, and begin and length in one array of ids."""

    MOST = 1 << 21

    def __init__(self) -> None:
        self.hashes, self.begin, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.total = np.zeros(0, np.uint32), 0

    def look_up(self, hashes: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, enc) -> tuple[np.ndarray, np.ndarray]:
        """Begin and length of each of these distinct segments; new ones are encoded."""
        if len(self.hashes) + len(hashes) > self.MOST:
            self.__init__()
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        new = np.flatnonzero(self.hashes[at] != hashes) if len(self.hashes) else np.arange(len(hashes))
        if len(new):
            ids, length = _encode_segments(buf, starts[new], ends[new], enc)
            begin = self.total + np.cumsum(length) - length
            self.flat, self.total = np.concatenate([self.flat, ids]), self.total + len(ids)
            order = np.argsort(merged := np.concatenate([self.hashes, hashes[new]]), kind="stable")
            self.hashes = merged[order]
            self.begin, self.length = np.concatenate([self.begin, begin])[order], np.concatenate([self.length, length])[order]
            at = np.searchsorted(self.hashes, hashes)
        return self.begin[at], self.length[at]


_known: dict[str, _Known] = {}


def _encode_segments(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, enc) -> tuple[np.ndarray, np.ndarray]:
    """Ids of segments one after another, and how many each has."""
    raw = buf.tobytes()
    plain = ~X.SPACE[buf[ends - 1]]
    length = np.zeros(len(starts), np.int64)
    newline = enc.encode_ordinary("\n")[0]
    # words never hold a line break, so it parts them without changing any of their ids
    joined = b"\n".join([raw[a:b] for a, b in zip(starts[plain].tolist(), ends[plain].tolist(), strict=True)])
    words = np.array(enc.encode_ordinary(joined.decode()), dtype=np.uint32) if plain.any() else np.zeros(0, np.uint32)
    cuts = np.flatnonzero(words == newline)
    length[plain] = np.diff(np.concatenate([[-1], cuts, [len(words)]]))[: plain.sum()] - 1
    words = np.delete(words, cuts)
    spaces = [enc.encode_ordinary(raw[a:b].decode()) for a, b in zip(starts[~plain].tolist(), ends[~plain].tolist(), strict=True)]
    length[~plain] = [len(x) for x in spaces]
    flat = np.empty(int(length.sum()), np.uint32)
    begin = np.cumsum(length) - length
    flat[X.ranges(begin[plain], (begin + length)[plain])[0]] = words
    for b, x in zip(begin[~plain], spaces, strict=True):
        flat[b : b + len(x)] = x
    return flat, length


def encode(buf: np.ndarray, offsets: np.ndarray, path: str) -> Iterator[np.ndarray]:
    """Token ids of each row."""
    tok, enc = _tokenizer(path)
    for lo, hi in X.chunks(offsets, ROUND_BYTES):
        b, o = buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        odd = set((np.searchsorted(o, _odd_space(b), side="right") - 1).tolist())
        starts, ends, first = _segments(b, o)
        ok = np.ones(len(starts), bool)
        for i in odd:
            ok[first[i] : first[i + 1]] = False
        row = np.repeat(np.arange(hi - lo), np.diff(first))[ok]
        starts, ends = starts[ok], ends[ok]
        hashes, at, back = np.unique(X.word_hashes(b, starts, ends), return_index=True, return_inverse=True)
        known = _known.setdefault(path, _Known())
        begin, length = known.look_up(hashes, b, starts[at], ends[at], enc)
        n, begin = length[back], begin[back]
        ids = known.flat[X.ranges(begin, begin + n)[0]]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(row, weights=n, minlength=hi - lo).astype(np.int64))])
        for i in range(hi - lo):
            if i in odd:
                yield np.array(tok.encode(b[o[i] : o[i + 1]].tobytes().decode(), add_special_tokens=False).ids, dtype=np.uint32)
            else:
                yield ids[bounds[i] : bounds[i + 1]]


def _pieces(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc_id")
            buf, offsets = X.byte_column(batch.column("text"))
            rows: list[tuple] = []
            held = 0
            for i, ids in enumerate(encode(buf, offsets, path)):
                ids = np.append(ids, np.uint32(END_ID))
                cut = len(ids) % CAPACITY or CAPACITY
                start = 0
                for k in range(-(-len(ids) // CAPACITY)):
                    part = ids[start : start + (cut if k == 0 else CAPACITY)]
                    rows.append((i, k, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), part if with_ids else None))
                    start += len(part)
                held += len(ids) if with_ids else 0
                if held > 1 << 20:
                    yield _piece_batch(doc, rows, with_ids)
                    rows, held = [], 0
            if rows:
                yield _piece_batch(doc, rows, with_ids)

    return run


def _piece_batch(doc: pa.Array, rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    i, piece, start, length, crc, ids = zip(*rows, strict=True)
    cols = [doc.take(pa.array(i)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        cuts = np.cumsum([0, *length]).astype(np.int32)
        cols.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(ids).astype(np.int32))))
        names.append("ids")
    return pa.RecordBatch.from_arrays(cols, names=names)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): a text's ids and the end id, cut where longer than a sequence."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_pieces(path or tokenizer_path(), with_ids), schema)


# The program


def price(weights: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of greatest weight: {length: copies}. weights[l] is 0 for lengths that don't occur."""
    lengths = np.flatnonzero(weights)
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    value = weights[lengths]
    for room in range(1, capacity + 1):
        n = np.searchsorted(lengths, room, side="right")
        best[room], choice[room] = best[room - 1], 0
        if n:
            total = best[room - lengths[:n]] + value[:n]
            k = int(total.argmax())
            if total[k] > best[room]:
                best[room], choice[room] = total[k], lengths[k]
    found: dict[int, int] = {}
    room = capacity
    while room > 0:
        if not choice[room]:
            room -= 1
        else:
            found[int(choice[room])] = found.get(int(choice[room]), 0) + 1
            room -= int(choice[room])
    return found


def _phase(left: np.ndarray, rounds: int, step: float) -> dict[tuple, float]:
    """A fractional solution for the pieces left: {configuration: amount}. Lengths that are covered least weigh most."""
    lengths = np.flatnonzero(left)
    need, log_w = left.astype(np.float64), np.zeros(len(left))
    log_w[lengths] = POWER * np.log(lengths)
    used: dict[tuple, float] = {}
    for _ in range(rounds):
        w = np.zeros(len(left))
        w[lengths] = np.exp(log_w[lengths] - log_w[lengths].max()) + 1e-300
        pattern = price(w, len(left) - 1)
        at, copies = np.array(list(pattern)), np.array(list(pattern.values()))
        amount = float((need[at] / copies).min())
        key = tuple(sorted(pattern.items()))
        used[key] = used.get(key, 0.0) + amount
        log_w[at] -= step * amount * copies / need[at]
    return used


def solve(counts: np.ndarray, phases: int = PHASES, rounds: int = ROUNDS, step: float = STEP) -> list[tuple[dict[int, int], int]]:
    """Configurations and how often each is used, covering every piece exactly. counts[l]: pieces of length l.

    Each phase solves the program for what is left and rounds it: the fullest configurations first, each as often as its amount says
    (once at least) and the pieces left allow. What no phase places is packed best-fit. Where best-fit alone needs fewer sequences, its
    plan is taken."""
    capacity = len(counts) - 1
    left = counts.astype(np.int64).copy()
    full = [({capacity: 1}, int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    plain = best_fit(left)
    plan: list[tuple[dict[int, int], int]] = []
    for _ in range(phases):
        placed = False
        used = _phase(left, rounds, step) if np.count_nonzero(left) > 1 else {}
        for key, x in sorted(used.items(), key=lambda kv: (-sum(n * k for n, k in kv[0]), -kv[1], kv[0])):
            times = int(min([max(1.0, x), *(left[n] // k for n, k in key)]))
            if times and sum(n * k for n, k in key) >= capacity - SLACK:
                plan.append((dict(key), times))
                placed = True
                for n, k in key:
                    left[n] -= k * times
        if not placed:
            break
    plan += best_fit(left)
    return full + min(plan, plain, key=lambda p: sum(times for _, times in p))


def best_fit(left: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Best-fit, longest first, on a histogram: equal sequences are one group with a count."""
    capacity = len(left) - 1
    groups: dict[int, dict[tuple, int]] = {}  # room -> {pattern: sequences}
    for n in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[n])
        while todo:
            room = min((r for r in groups if r >= n), default=None)
            if room is None:
                each = capacity // n
                for k, times in ((each, todo // each), (todo % each, 1)):
                    if k and times:
                        groups.setdefault(capacity - k * n, {})[((n, k),)] = times
                todo = 0
                continue
            pattern = min(groups[room])
            have = groups[room].pop(pattern)
            if not groups[room]:
                del groups[room]
            times = min(have, todo)
            grown = dict(pattern)
            grown[n] = grown.get(n, 0) + 1
            key = tuple(sorted(grown.items()))
            bins = groups.setdefault(room - n, {})
            bins[key] = bins.get(key, 0) + times
            if have > times:
                rest = groups.setdefault(room, {})
                rest[pattern] = rest.get(pattern, 0) + have - times
            todo -= times
    return [(dict(p), t) for room in sorted(groups) for p, t in sorted(groups[room].items())]


def _places(plan: list[tuple[dict[int, int], int]], capacity: int):
    """Numbered pieces of each length -> sequence and offset. The plan is a few thousand rows at most, whatever the corpus."""
    table: list[list[tuple]] = [[] for _ in range(capacity + 1)]
    taken = np.zeros(capacity + 1, np.int64)
    first = 0
    for pattern, times in plan:
        offset = 0
        for n, copies in sorted(pattern.items(), reverse=True):
            table[n].append((int(taken[n]), copies, first, offset))
            taken[n] += copies * times
            offset += n * copies
        first += times
    arrays = {n: tuple(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) for n, rows in enumerate(table) if rows}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            number = batch.column("number").to_numpy(zero_copy_only=False)
            seq, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                begin, copies, base, off = arrays[int(n)]
                k = np.searchsorted(begin, number[at], side="right") - 1
                inside = number[at] - begin[k]
                seq[at] = base[k] + inside // copies[k]
                offset[at] = off[k] + inside % copies[k] * n
            keep_cols = [c for c in batch.schema.names if c != "number"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep_cols), pa.array(seq), pa.array(offset)],
                                             names=[*keep_cols, "sequence_id", "offset"])

    return run


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (doc_id, piece, length and more columns) with sequence_id and offset.

    Every piece is placed once, sequences have no gaps and at most ``capacity`` tokens. Pieces of equal length are numbered by hash,
    id and piece. ``cut`` must be a table that reads the same twice (see ``keep``).
    """
    hist = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").agg(F.count("*").alias("n")).where(F.col("length").between(1, capacity)).collect():  # at most ``capacity`` rows
        hist[r["length"]] = r["n"]
    plan = solve(hist)
    ranges = max(1, int(hist.sum()) // RANGE_ROWS)
    dealt = cut.withColumn("range", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(ranges)))
    sums = dealt.groupBy("length", "range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sums = keep(sums.select("length", "range", F.coalesce(before, F.lit(0)).alias("before")), "ranges")
    inside = F.row_number().over(Window.partitionBy("length", "range").orderBy("doc_id", "piece", *[c for c in cut.columns if c in ("start", "ids_crc32")]))
    numbered = (dealt.withColumn("number", inside - 1).join(sums.hint("merge"), ["length", "range"])
                .select(*cut.columns, (F.col("number") + F.col("before")).alias("number")))
    schema = ", ".join(f"`{c}` {t}" for c, t in cut.dtypes) + ", sequence_id long, offset long"
    return numbered.mapInArrow(_places(plan, capacity), schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Row per piece: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    A null or empty text is one piece, the end id. Rows that repeat, null ids included, are packed as documents of their
    own. Other columns are not read.
    """
    return pack(keep(pieces(docs, id_col, text_col, path, with_ids), "pieces"))
