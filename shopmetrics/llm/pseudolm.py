"""Scoring of documents by masked pseudo-likelihood (operator 5).

A window network sees ``SIDE`` words on either side of a place and predicts the word that stands there. A document's score is the sum over
all its words of the log-probability given both sides.

The vocabulary comes from the counts of every word of the corpus: the most frequent (``TOP``, or half the root of the distinct
words where that is more) have a class each, all others share ``BUCKETS`` classes by hash. Within its class a word is as likely as it is frequent: the
counts stay a table, which the distinct words of each chunk of documents are joined with. Training runs where the data lie: the documents
are dealt by hash to ``ROUNDS`` rounds, so each is trained on once; in a round every partition trains a copy of the network on its
documents of that round, and the copies are averaged by their words, added in two levels of tasks.

The classes are dealt to about as many groups as a group has classes. The network predicts a word's group and, by the group's own
outputs, the class inside it: the product is one distribution over all classes, at the cost of two short ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmetrics.llm import text as X
from shopmetrics.llm.store import keep, short_batches

TOP, BUCKETS = 256, 64
CLASSES = TOP + BUCKETS
SIDE, EMBED, HIDDEN = 3, 16, 32
ROUNDS = 4
BATCH, RATE = 4096, 0.01
#: Copies of the network that meet in a task, at the first of two levels: one in so many of the partitions.
FAN_OUT = 64
ROUND_BYTES = 1 << 22


def _shapes(classes: int) -> dict[str, tuple[int, ...]]:
    members = math.isqrt(classes - 1) + 1
    groups = -(-classes // members)
    return {"e": (classes + 1, EMBED), "w": (2 * SIDE, EMBED, HIDDEN), "h": (HIDDEN,), "g": (HIDDEN, groups), "a": (groups,),
            "o": (groups, HIDDEN, members), "b": (groups, members)}


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The rows in chunks of about ``limit`` bytes of text, the same ones however the rows are dealt to batches."""
    rest = []
    for batch in batches:
        for rows in pa.Table.from_batches([*rest, batch]).combine_chunks().to_batches():
            *full, last = X.chunks(X.byte_column(rows.column("text"))[1], limit)
            for lo, hi in full:
                yield rows.slice(lo, hi - lo)
            rest = [rows.slice(last[0])]  # more rows may belong to it
    yield from rest


def _words(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and ``first`` of word_bounds."""
    buf, offsets = X.byte_column(chunk.column("text"))
    s, e, first = X.word_bounds(buf, offsets)
    return X.word_hashes(buf, s, e, lower=True), first


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in _chunks(batches, ROUND_BYTES):
        word, n = np.unique(_words(chunk)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])


class Vocabulary:
    """Classes of word hashes; of each class the log of its distinct words, and of each bucket the occurrences in the corpus.

    ``counts`` is the table (word, n) of all words; workers don't get it.
    """

    def __init__(self, top: list[int], distinct: dict[int, int], total: dict[int, int], counts: DataFrame) -> None:
        self.first_bucket = max(TOP, len(top))
        self.size = self.first_bucket + BUCKETS
        top = np.array(top, np.int64).view(np.uint64)
        self.classes = np.argsort(top, kind="stable")
        self.top = top[self.classes]
        self.inside, self.total = np.zeros(self.size), np.zeros(BUCKETS)
        for bucket, n in distinct.items():
            self.inside[self.first_bucket + bucket] = np.log(max(n, 1))
            self.total[bucket] = total[bucket]
        self.counts = counts

    def __getstate__(self) -> dict:
        return {**self.__dict__, "counts": None}

    def of(self, words: np.ndarray) -> np.ndarray:
        own = words.view(np.int64)
        at = pc.index_in(pa.array(own), value_set=pa.array(self.top.view(np.int64))).fill_null(-1).to_numpy()
        rare = self.first_bucket + (own & (BUCKETS - 1))
        return np.where(at >= 0, self.classes[at], rare) if len(self.top) else rare


def vocabulary(docs: DataFrame, text_col: str = "text") -> Vocabulary:
    with short_batches(docs.sparkSession):
        counts = keep(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_counts, "word long, n long")
                      .groupBy("word").agg(F.sum("n").alias("n")), "counts")
    most = max(TOP, math.isqrt(counts.count()) // 2)
    top = {r["word"]: r["n"] for r in counts.orderBy(F.desc("n"), "word").limit(most).collect()}  # half the root of the distinct words
    bucket = F.col("word").bitwiseAND(BUCKETS - 1)
    # every word counts towards its bucket; the few frequent ones among them are taken off
    distinct, total = {}, {}
    for b, n, words in counts.groupBy(bucket).agg(F.count("*"), F.sum("n")).collect():  # BUCKETS rows
        distinct[b], total[b] = n, words
    for w, n in top.items():
        distinct[w & (BUCKETS - 1)] -= 1
        total[w & (BUCKETS - 1)] -= n
    return Vocabulary(list(top), distinct, total, counts)


# The network


def start(seed: int = 5, classes: int = CLASSES) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    scale = {"e": 0.5, "w": 0.1, "h": 0.0, "g": 0.1, "a": 0.0, "o": 0.1, "b": 0.0}
    model = {k: (rng.normal(0, 1, s) * scale[k]).astype(np.float32) for k, s in _shapes(classes).items()}
    model["b"].reshape(-1)[classes:] = -1e9  # places of the last group that no class has
    return model


def contexts(classes: np.ndarray, first: np.ndarray, beyond: int = CLASSES) -> np.ndarray:
    """Classes of the 2 * SIDE neighbours of every word; ``beyond`` beyond the document's ends."""
    n = len(classes)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.full((n, 2 * SIDE), beyond, np.int32)
    for k, d in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        a, b = max(0, -d), n - max(0, d)
        if a < b:
            out[a:b, k] = np.where(doc[a:b] == doc[a + d : b + d], classes[a + d : b + d], beyond)
    return out


# What is summed over the few groups or members has a column for each place: the sums then run along the places.


def _inputs(model: dict, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The embeddings around every place, side by side, and the hidden units."""
    x = model["e"].take(around.ravel(), axis=0).reshape(len(around), -1)
    h = x @ model["w"].reshape(-1, HIDDEN)
    h += model["h"]
    return x, np.tanh(h, out=h)


def _softmax(z: np.ndarray, share: float) -> np.ndarray:
    """In place: ``share`` times the softmax of each column."""
    z -= z.max(axis=0)
    np.exp(z, out=z)
    z *= share / z.sum(axis=0)
    return z


def _log_prob(z: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The log-softmax of each column at its ``row``."""
    z -= z.max(axis=0)
    at = z[row, np.arange(len(row))]
    return at - np.log(np.exp(z, out=z).sum(axis=0))


def _by_group(target: np.ndarray, members: int) -> tuple[np.ndarray, np.ndarray]:
    """Group and place of every class; few groups are short integers, which numpy sorts by digits."""
    group, place = np.divmod(target, members)
    return group.astype(np.uint16 if len(group) and group.max() < 1 << 16 else np.int64), place


def _runs(group: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(group, from, to) of sorted groups."""
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield int(group[lo]), lo, hi


def log_probs(model: dict, around: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log-probability of each target's class given the words around it: of its group, and of it inside that."""
    out = np.empty(len(target))
    group, place = _by_group(target, model["b"].shape[1])
    order = np.argsort(group, kind="stable")
    for begin in range(0, len(order), 8192):
        part = order[begin : begin + 8192]
        _, h = _inputs(model, around.take(part, axis=0))
        its, inside = group.take(part), place.take(part)
        found = _log_prob(model["g"].T @ h.T + model["a"][:, None], its).astype(np.float64)
        for k, lo, hi in _runs(its):
            found[lo:hi] += _log_prob(model["o"][k].T @ h[lo:hi].T + model["b"][k][:, None], inside[lo:hi])
        out[part] = found
    return out


def train(model: dict, around: np.ndarray, target: np.ndarray, state: dict) -> None:
    """One pass of Adam over the places given, in batches."""
    rng = np.random.default_rng(len(target))
    order, (group, place) = rng.permutation(len(target)), _by_group(target, model["b"].shape[1])
    for begin in range(0, len(order), BATCH):
        at = order[begin : begin + BATCH]
        at = at.take(np.argsort(group.take(at), kind="stable"))
        a, n, its, inside = around.take(at, axis=0), len(at), group.take(at), place.take(at)
        x, h = _inputs(model, a)
        grad = {k: np.zeros_like(model[k]) for k in ("o", "b")}
        each = np.arange(n)
        z = _softmax(model["g"].T @ h.T + model["a"][:, None], 1 / n)
        z[its, each] -= 1 / n
        grad["g"], grad["a"], dh = (z @ h).T, z.sum(axis=1), z.T @ model["g"].T
        for k, lo, hi in _runs(its):
            z = _softmax(model["o"][k].T @ h[lo:hi].T + model["b"][k][:, None], 1 / n)
            z[inside[lo:hi], each[: hi - lo]] -= 1 / n
            grad["o"][k], grad["b"][k] = (z @ h[lo:hi]).T, z.sum(axis=1)
            dh[lo:hi] += z.T @ model["o"][k].T
        dh *= 1 - h * h
        grad["h"], grad["w"] = dh.sum(axis=0), (x.T @ dh).reshape(model["w"].shape)
        dx, words = model["w"].reshape(-1, HIDDEN) @ dh.T, a.T.astype(np.intp, order="C")
        e = np.zeros((EMBED, len(model["e"])), model["e"].dtype)
        for i in range(2 * SIDE * EMBED):
            np.add.at(e[i % EMBED], words[i // EMBED], dx[i])
        grad["e"] = e.T
        state["step"] = t = state.get("step", 0) + 1
        rate = float(RATE / (1 + t / 500) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t))  # no numpy number, which would make doubles of the rest
        for name, g in grad.items():
            m1, m2 = state.setdefault(name, (np.zeros(g.shape, g.dtype), np.zeros(g.shape, g.dtype)))
            m1 *= 0.9
            m1 += 0.1 * g
            g *= g
            g *= 0.001
            m2 *= 0.999
            m2 += g
            by = np.sqrt(m2, out=g)
            by += 1e-8
            model[name] -= np.divide(rate * m1, by, out=by)


def _flat(model: dict) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in _shapes(CLASSES)])


def _shaped(flat: np.ndarray, classes: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in _shapes(classes).items():
        n = int(np.prod(s))
        out[k] = flat[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


def _train_partition(model: dict, vocab: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, words = {k: v.copy() for k, v in model.items()}, {}, 0
        for chunk in _chunks(batches, X.CHUNK_BYTES):
            hashes, first = _words(chunk)
            if len(hashes):
                classes = vocab.of(hashes)
                train(own, contexts(classes, first, vocab.size), classes, state)
                words += len(classes)
        if words:
            yield _weighed(TaskContext.get().partitionId() % FAN_OUT, _flat(own).astype(np.float64) * words, words)

    return run


_MODELS = "at int, value binary, words long"


def _weighed(at: int, value: np.ndarray, words: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([value.tobytes()], pa.binary()), pa.array([words], pa.int64())],
                                      names=["at", "value", "words"])


def _added(rows: pa.Table) -> pa.Table:
    """The copies of one task added, for the next level."""
    total = None
    for value in rows.column("value"):
        one = np.frombuffer(value.as_buffer(), np.float64)
        total = one.copy() if total is None else total.__iadd__(one)
    return pa.Table.from_batches([_weighed(0, total, pc.sum(rows.column("words")).as_py())])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[dict, Vocabulary]:
    """The averaged network and the corpus's vocabulary."""
    # a worker has one core: more threads for its small products would only wait for each other
    docs.sparkSession.sparkContext.environment.update(dict.fromkeys(("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"), "1"))
    vocab = vocabulary(docs, text_col)
    model = start(classes=vocab.size)
    for k in range(ROUNDS):
        turn = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(ROUNDS)) == k
        part = docs.where(turn & F.col(text_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"))
        copies = part.mapInArrow(_train_partition(model, vocab), _MODELS)
        for _ in range(2):
            copies = copies.groupBy("at").applyInArrow(_added, _MODELS)
        with short_batches(docs.sparkSession):
            found = copies.collect()  # one network
        for one in found:
            model = _shaped(np.frombuffer(one["value"], np.float64) / one["words"], vocab.size)
    return model, vocab


def score(docs: DataFrame, model: dict, vocab: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row per document: doc_id, n_words, log_likelihood (sum over its words), mean_log_likelihood.

    A text that is null, empty or without words has n_words 0, log_likelihood 0 and a null mean. Every word of a text is
    scored; one that the corpus doesn't have counts as one occurrence of its bucket. Rows that repeat are scored each; null ids keep
    their row. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, rows in enumerate(_chunks(batches, X.CHUNK_BYTES), 1):
            words, first = _words(rows)
            classes = vocab.of(words)
            sums = np.concatenate([[0.0], np.cumsum(log_probs(model, contexts(classes, first, vocab.size), classes))])
            # the buckets' words, as places in the chunk's distinct ones, which its first row has
            at = classes >= vocab.first_bucket
            found = pa.array(words[at].view(np.int64)).dictionary_encode()
            rare, place = np.unique(found.dictionary.to_numpy(), return_inverse=True)  # sorted: neighbours share their bytes
            cuts = np.concatenate([[0], np.cumsum(at)])[first]
            own = [rare, *[None] * (len(rows) - 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), (TaskContext.get().partitionId() << 32) + k)), rows.column("doc_id"), pa.array(np.diff(first).astype(np.int64)),
                 pa.array(sums[first[1:]] - sums[first[:-1]]), pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(place.astype(np.int32)[found.indices.to_numpy()])),
                 pa.array(own, pa.list_(pa.int64()))],
                names=["chunk", "doc_id", "n_words", "of_classes", "places", "words"])

    def finish(rows: pa.Table, known: pa.Table) -> pa.Table:
        place = known.column("place").to_numpy()
        inside = np.empty(len(place))
        packed = known.column("packed").to_numpy()
        inside[place] = np.log(packed // BUCKETS) - np.log(vocab.total[packed % BUCKETS] + 1)
        places = rows.column("places")
        flat = pc.list_flatten(places).to_numpy()
        n = pc.list_value_length(places).to_numpy().astype(np.int64)
        sums = np.concatenate([[0.0], np.cumsum(inside[flat])])
        ends = np.cumsum(n)
        total = rows.column("of_classes").to_numpy() + sums[ends] - sums[ends - n]
        return pa.table({"doc_id": rows.column("doc_id"), "n_words": rows.column("n_words"), "log_likelihood": pa.array(total)})

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    with short_batches(docs.sparkSession):
        part = keep(src.mapInArrow(run, "chunk long, doc_id long, n_words long, of_classes double, places array<int>, words array<long>"), "classes")
    met = part.where("words IS NOT NULL").select("chunk", F.posexplode("words").alias("place", "word"))
    # a word that is missing there counts as one occurrence: those that have one needn't be joined
    known = met.join(vocab.counts.where("n > 1").hint("merge"), "word", "left").select(F.col("chunk").alias("its"), "place",
        (F.coalesce("n", F.lit(1)) * BUCKETS + F.col("word").bitwiseAND(BUCKETS - 1)).alias("packed"))  # occurrences and bucket
    done = part.drop("words").groupBy("chunk").cogroup(known.groupBy("its")).applyInArrow(finish, "doc_id long, n_words long, log_likelihood double")
    return done.withColumn("mean_log_likelihood", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))
