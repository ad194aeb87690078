"""Language identification by a bidirectional gated recurrent network over bytes (operator 2).

The network reads windows of bytes: the words of a text, longer ones in pieces of ``LONGEST`` bytes. It runs over a window in
both directions from a zero state, labels every byte position, and a document's probabilities are
pooled from the log-probabilities of all its positions. As a window's labels depend on its bytes alone, a batch computes each
distinct window once. Training is backpropagation through time in numpy, on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmetrics.llm import text as X

UNKNOWN = "und"
#: Bound of the training sample: documents of each language and of all, and windows of each document, spread over its whole text.
SAMPLE_PER_LANG, SAMPLE_DOCS, SAMPLE_WORDS = 300, 6000, 60
LONGEST = 16
HIDDEN, EPOCHS, BATCH, RATE = 12, 3, 256, 0.01
FOLDS = 5
#: Bytes that one round of prediction looks at: more bytes, fewer windows computed twice.
ROUND_BYTES = 1 << 22


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0


# The network. Parameters: for each direction d the byte table x_d (256, 3H) and the state weights u_d (H, 3H); output w (2H, C), b (C).


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _run(x: np.ndarray, u: np.ndarray, seq: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States after each of the T steps over seq (T, B)."""
    hidden = u.shape[0]
    h = np.zeros((seq.shape[1], hidden), np.float32)
    out = np.empty((*seq.shape, hidden), np.float32)
    for t, byte in enumerate(seq):
        inp, g = x[byte], h @ u
        gate = _sigmoid(inp[:, : 2 * hidden] + g[:, : 2 * hidden])
        z, r = gate[:, :hidden], gate[:, hidden:]
        n = np.tanh(inp[:, 2 * hidden :] + r * g[:, 2 * hidden :])
        if trace is not None:
            trace.append((h, z, r, n, g[:, 2 * hidden :]))
        h = n + z * (h - n)
        out[t] = h
    return out


def _back(u: np.ndarray, trace: list, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the state weights and of each step's input, given those of the states."""
    du, dx = np.zeros_like(u), np.empty((*grad.shape[:2], u.shape[1]), np.float32)
    dh = np.zeros_like(grad[0])
    for t in range(len(trace) - 1, -1, -1):
        h, z, r, n, g = trace[t]
        dh = dh + grad[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * g * r * (1 - r)
        dg = np.concatenate([dz, dr, dn * r], axis=1)
        dx[t] = np.concatenate([dz, dr, dn], axis=1)
        du += h.T @ dg
        dh = dh * z + dg @ u.T
    return du, dx


def position_log_probs(model: dict, seq: np.ndarray, traces: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    """log-probabilities (T, B, C) of every position of windows seq (T, B) of one length, and the states."""
    a, b = traces or (None, None)
    states = np.concatenate([_run(model["x0"], model["u0"], seq, a), _run(model["x1"], model["u1"], seq[::-1], b)[::-1]], axis=2)
    logits = states @ model["w"] + model["b"]
    logits -= logits.max(axis=2, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=2, keepdims=True)), states


def train(windows: list[bytes], labels: np.ndarray, classes: int, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 2, weight: np.ndarray | None = None) -> dict:
    """Adam over batches of windows of one length; the loss is the cross-entropy of every position, times its label's ``weight``."""
    rng = np.random.default_rng(seed)
    model = {"b": np.zeros(classes, np.float32), "w": rng.normal(0, 0.3, (2 * hidden, classes)).astype(np.float32)}
    for d in "01":
        model["x" + d] = rng.normal(0, 0.5, (256, 3 * hidden)).astype(np.float32)
        model["u" + d] = rng.normal(0, 0.3, (hidden, 3 * hidden)).astype(np.float32)
    size = np.array([len(w) for w in windows])
    lots = []
    for n in np.unique(size):
        at = rng.permutation(np.flatnonzero(size == n))
        seq = np.frombuffer(b"".join(windows[i] for i in at), np.uint8).reshape(len(at), n)
        lots += [(seq[i : i + BATCH].T, labels[at[i : i + BATCH]]) for i in range(0, len(at), BATCH)]
    m1, m2 = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        for k in rng.permutation(len(lots)):
            seq, y = lots[k]
            step += 1
            traces = ([], [])
            logp, states = position_log_probs(model, seq, traces)
            d = np.exp(logp)
            d[:, np.arange(len(y)), y] -= 1
            d /= d.shape[0] * d.shape[1]
            if weight is not None:
                d *= weight[y][:, None]
            flat = d.reshape(-1, classes)
            grad = {"w": states.reshape(-1, 2 * hidden).T @ flat, "b": flat.sum(axis=0)}
            ds = d @ model["w"].T
            for side, (part, order) in enumerate(((ds[:, :, :hidden], seq), (ds[::-1, :, hidden:], seq[::-1]))):
                du, dx = _back(model[f"u{side}"], traces[side], part)
                hot = np.zeros((256, order.size), np.float32)
                hot[order.ravel(), np.arange(order.size)] = 1
                grad[f"u{side}"], grad[f"x{side}"] = du, hot @ dx.reshape(-1, 3 * hidden)
            rate = RATE * (1 - 0.9 * epoch / max(1, epochs - 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for name, g in grad.items():
                m1[name] += 0.1 * (g - m1[name])
                m2[name] += 0.001 * (g * g - m2[name])
                model[name] -= (rate * m1[name] / (np.sqrt(m2[name]) + 1e-8)).astype(np.float32)
    return model


# Windows of texts.


def windows_of(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the windows, and first window of each row."""
    starts, ends, first = X.word_bounds(buf, offsets)
    pieces = -(-(ends - starts) // LONGEST)
    if len(pieces) and pieces.max() > 1:
        nth, word = X.ranges(np.zeros(len(pieces), np.int64), pieces)
        starts = starts[word] + nth * LONGEST
        ends = np.minimum(starts + LONGEST, ends[word])
        first = np.concatenate([[0], np.cumsum(pieces)])[first]
    return starts, ends, first


def _window_scores(model: dict, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Summed log-probabilities of each window's positions."""
    out = np.empty((len(starts), len(model["b"])))
    size = ends - starts
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        for lo in range(0, len(at), 4096):
            rows = at[lo : lo + 4096]
            logp, _ = position_log_probs(model, buf[starts[rows] + np.arange(n)[:, None]])
            out[rows] = logp.sum(axis=0)
    return out


def _predict(model: dict | None, classes: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = X.byte_column(batch.column("text" if "text" in batch.schema.names else "kept_text"))
            letters = batch.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
            own = [c for c in ("row", "kept_text") if c in batch.schema.names]
            for lo, hi in X.chunks(offsets, ROUND_BYTES):  # what goes back is as small as what is worked on
                name, score = np.full(hi - lo, UNKNOWN, object), np.zeros(hi - lo)
                b, o = buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                starts, ends, first = windows_of(b, o)
                if model and len(starts):
                    _, at, back = np.unique(X.word_hashes(b, starts, ends), return_index=True, return_inverse=True)
                    sums = np.concatenate([np.zeros((1, len(classes))), np.cumsum(_window_scores(model, b, starts[at], ends[at])[back], axis=0)])
                    pooled = sums[first[1:]] - sums[first[:-1]]
                    pooled = np.exp(pooled - pooled.max(axis=1, keepdims=True))
                    pooled /= pooled.sum(axis=1, keepdims=True)
                    name, score = np.array(classes, object)[pooled.argmax(axis=1)], pooled.max(axis=1)
                name[~letters[lo:hi]], score[~letters[lo:hi]] = UNKNOWN, 0.0
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in own), pa.array(name, pa.string()), pa.array(score)],
                                                 names=[*own, "lang_pred", "score"])

    return run


def _sample_windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = []
        for lang, text in zip(f["lang"], f["text"], strict=True):
            raw = text.encode()
            buf = np.frombuffer(raw, np.uint8)
            starts, ends, _ = windows_of(buf, np.array([0, len(buf)]))
            for i in np.unique(np.linspace(0, len(starts) - 1, min(SAMPLE_WORDS, len(starts))).astype(int)) if len(starts) else ():
                rows.append((lang, raw[starts[i] : ends[i]]))
        yield pd.DataFrame(rows, columns=["lang", "word"])


def _balanced(labels: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows, those of rarer languages again up to the commonest's number (in all twice the sample's bound at most), and a weight
    of each language that makes its parts equal, so that a position's label carries no prior."""
    rng = np.random.default_rng(22)
    own = np.bincount(labels, minlength=classes)
    each = np.maximum(own, min(own.max(), SAMPLE_DOCS * SAMPLE_WORDS // classes))
    take = np.concatenate([np.resize(rng.permutation(np.flatnonzero(labels == k)), n) for k, n in enumerate(each)])
    return take, (each.sum() / (classes * each)).astype(np.float32)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[dict | None, list[str]]:
    """The model and its languages, from a sample (bounded by SAMPLE_*) of labelled rows outside the held-out fold."""
    learn = (docs.where(F.col(lang_col).isNotNull() & ~held_out(id_col) & (F.length(F.trim(text_col)) > 0))
             .select(F.col(id_col).alias("sample_id"), F.col(lang_col).cast("string").alias("lang")))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("sample_id"), "sample_id"))
    ids = learn.withColumn("nth", nth).where(F.col("nth") <= SAMPLE_PER_LANG).orderBy("nth", "lang").limit(SAMPLE_DOCS).select("sample_id").distinct()
    own = docs.select(F.col(id_col).alias("sample_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = (own.where("lang IS NOT NULL AND text IS NOT NULL").join(F.broadcast(ids), "sample_id").select("lang", "text")
            .mapInPandas(_sample_windows, "lang string, word binary").toPandas())
    rows = rows.sort_values(["lang", "word"]).reset_index(drop=True)
    classes = sorted(rows["lang"].unique().tolist())
    if not classes:
        return None, []
    labels = np.searchsorted(np.array(classes), rows["lang"].to_numpy(str))
    take, weight = _balanced(labels, len(classes))
    windows = [bytes(w) for w in rows["word"].iloc[take]]
    return train(windows, labels[take], len(classes), weight=weight), classes


def identify(docs: DataFrame, model: dict | None, classes: list[str], text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of docs (all by default), lang_pred and score of every row.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no letter, or nothing was learned. All bytes of a text count.
    Columns of ``docs`` named lang_pred or score are replaced.
    """
    wanted = [c for c in (columns or docs.columns) if c not in ("lang_pred", "score")]
    plain = [c for c in wanted if c != text_col]
    text = F.col(text_col).cast("string")
    packed = docs.select(F.struct(*plain).alias("row"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    fields = [packed.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if text_col in wanted:
        packed = packed.withColumnRenamed("text", "kept_text")
        fields.insert(1, T.StructField("kept_text", T.StringType()))
    named = packed.mapInArrow(_predict(model, classes), T.StructType(fields))
    return named.select(*(F.col("kept_text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in wanted), "lang_pred", "score")
