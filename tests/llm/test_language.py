"""Language ID and document scores: gradients, held-out accuracy, whole texts, edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopmetrics.llm import langid, pseudolm
from shopmetrics.llm.store import on_workers, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def _workers(spark):
    on_workers(spark)


def test_backpropagation_through_time_is_the_gradient():
    rng = np.random.default_rng(0)
    hidden, classes = 3, 2
    model = {"b": rng.normal(size=classes), "w": rng.normal(size=(2 * hidden, classes))}
    for d in "01":
        model["x" + d], model["u" + d] = rng.normal(size=(256, 3 * hidden)), rng.normal(size=(hidden, 3 * hidden))
    seq, y = rng.integers(0, 256, (4, 3)), np.array([0, 1, 1])

    def states(u):
        return langid._run(model["x0"], u, seq)

    weight = rng.normal(size=(4, 3, hidden))
    trace = []
    langid._run(model["x0"], model["u0"], seq, trace)
    du, dx = langid._back(model["u0"], trace, weight.astype(np.float32))
    for i, j in [(0, 0), (1, 4), (2, 8)]:
        step = np.zeros_like(model["u0"])
        step[i, j] = 1e-3
        slope = ((states(model["u0"] + step) - states(model["u0"] - step)) * weight).sum() / 2e-3
        assert abs(slope - du[i, j]) < 1e-2 * max(1, abs(slope))
    logp, _ = langid.position_log_probs(model, seq)
    assert logp.shape == (4, 3, 2) and np.allclose(np.exp(logp).sum(axis=2), 1) and len(y) == 3


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    model, classes = langid.fit(docs)
    assert classes == ["de", "en", "es", "fr"]
    out = langid.identify(docs.withColumn("held_out", langid.held_out()), model, classes, columns=["doc_id", "lang", "held_out"])
    n, right, low, high = out.where("held_out AND lang IS NOT NULL").agg(
        F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert n > 150 and right / n > 0.97 and 0 <= low <= high <= 1


def test_a_rare_label_takes_no_windows_from_others(monkeypatch):
    labels = np.repeat([0, 1, 2], [9000, 7000, 1])
    take, weight = langid._balanced(labels, 3)
    assert set(take) == set(range(len(labels))) and (np.bincount(labels[take]) == 9000).all() and np.allclose(weight, 1)
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 100)
    take, weight = langid._balanced(labels, 3)
    n = np.bincount(labels[take])
    assert set(take) == set(range(len(labels))) and n.tolist() == [9000, 7000, 2000] and np.allclose(n * weight, 6000)


def test_a_rare_label_leaves_the_predictions_right(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    rare = spark.range(10_000_001, 10_000_006).select(F.col("id").alias("doc_id"), F.lit("saluton mondo").alias("text"), F.lit("eo").alias("lang"))
    model, classes = langid.fit(docs.unionByName(rare))
    assert "eo" in classes
    n, right = langid.identify(docs, model, classes).where(langid.held_out() & F.col("lang").isNotNull()).agg(
        F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert right / n > 0.97


def test_language_inputs_and_edges(spark):
    docs = table(spark, SF, "documents").limit(400)
    model, classes = langid.fit(docs)
    long = "the thing and that with " * 40_000
    rows = [(1, None, "x", 9), (2, "", "x", 9), (3, "12 -- 4", "x", 9), (4, long, None, 9), (4, long, "zz", 8), (None, "der und die", "fr", 7), (5, "ééé" * 50_000, None, 1)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int").withColumn("row", F.lit(3)).withColumn("kept_text", F.lit("k"))
    got = langid.identify(odd, model, classes, columns=["doc_id", "text", "row"]).collect()
    assert [r["lang_pred"] for r in got[:3]] == ["und"] * 3 and [r["score"] for r in got[:3]] == [0.0] * 3
    assert got[3]["lang_pred"] == got[4]["lang_pred"] == "en" and got[3]["score"] == got[4]["score"]
    assert got[4]["text"] == long and got[5]["row"] == 3 and got[6]["lang_pred"] in classes
    empty = odd.limit(0)
    assert langid.fit(empty) == (None, []) and langid.identify(empty, None, []).collect() == []
    assert {r["lang_pred"] for r in langid.identify(odd, None, []).collect()} == {"und"}


def test_all_bytes_of_a_long_word_count():
    buf = np.frombuffer(b"a" * 40 + b" bc", np.uint8)
    starts, ends, first = langid.windows_of(buf, np.array([0, len(buf)]))
    assert [(a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)] == [(0, 16), (16, 32), (32, 40), (41, 43)] and first.tolist() == [0, 4]


def test_masked_network_gradient_and_context():
    model = pseudolm.start()
    classes = np.arange(20) % 7
    around = pseudolm.contexts(classes, np.array([0, 12, 12, 20]))
    assert around[0].tolist() == [pseudolm.CLASSES] * 3 + [1, 2, 3] and around[11, 3:].tolist() == [pseudolm.CLASSES] * 3
    before = pseudolm.log_probs(model, around, classes).sum()
    state = {}
    for _ in range(60):
        pseudolm.train(model, around, classes, state)
    after = pseudolm.log_probs(model, around, classes)
    assert after.sum() > before + 20 and (after <= 0).all()
    # each probability is one of a distribution over all classes
    every = np.array([pseudolm.log_probs(model, around[[4]], np.array([c]))[0] for c in range(pseudolm.CLASSES)])
    assert abs(np.exp(every).sum() - 1) < 1e-4


def test_scores_of_documents(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    model, vocab = pseudolm.fit(docs)
    odd = spark.createDataFrame([(-1, None, 1), (-2, " ", 1), (None, "the of and", 1), (-3, "qqqz " * 30_000, 1)], "doc_id long, text string, n_words int")
    got = {r["doc_id"]: r for r in pseudolm.score(docs.withColumn("n_words", F.lit(0)).unionByName(odd), model, vocab).collect()}
    assert got[-1][1:] == got[-2][1:] == (0, 0.0, None) and got[None]["n_words"] == 3 and got[-3]["n_words"] == 30_000
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(got[d]["n_words"] == len(t.encode().split()) for d, t in text.items())
    # words in order are likelier than the same words shuffled
    rng = np.random.default_rng(0)
    mixed = spark.createDataFrame([(d, " ".join(rng.permutation(t.split()))) for d, t in text.items()], "doc_id long, text string")
    worse = {r["doc_id"]: r["mean_log_likelihood"] for r in pseudolm.score(mixed, model, vocab).collect()}
    assert np.mean([got[d]["mean_log_likelihood"] - worse[d] for d in text if got[d]["n_words"] > 20]) > 0
    untrained = pseudolm.score(docs, pseudolm.start(), vocab).agg(F.avg("mean_log_likelihood")).first()[0]
    assert np.mean([got[d]["mean_log_likelihood"] for d in text]) > untrained + 0.3
    model, vocab = pseudolm.fit(docs.limit(0))
    assert pseudolm.score(docs.limit(0), model, vocab).collect() == []


def test_vocabulary_counts_the_whole_corpus(spark):
    vocab = pseudolm.vocabulary(table(spark, SF, "documents"))
    words = {}
    for r in table(spark, SF, "documents").collect():
        for w in r.text.encode().lower().split():
            words[w] = words.get(w, 0) + 1
    assert len(vocab.top) == pseudolm.TOP
    assert round(np.exp(vocab.inside[pseudolm.TOP :]).sum()) == len(words) - pseudolm.TOP


def test_rare_words_score_by_their_counts(spark):
    """Two words of one bucket, far below the frequent ones: in the same place the commoner is likelier, by the log of its counts."""
    names = np.array([f"w{i}" for i in range(3000)])
    buf, offsets = pseudolm.X.byte_column(pseudolm.pa.array([" ".join(names)]))
    hashes = pseudolm.X.word_hashes(buf, *pseudolm.X.word_bounds(buf, offsets)[:2], lower=True).view(np.int64)
    a, b = names[hashes & (pseudolm.BUCKETS - 1) == 7][:2]
    rows = [(i, " ".join(f"top{k}" for k in range(pseudolm.TOP))) for i in range(60)] + [(100 + i, a) for i in range(40)] + [(200 + i, b) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, vocab = pseudolm.fit(docs)
    got = {r["doc_id"]: r["log_likelihood"] for r in pseudolm.score(docs.unionByName(docs.where("doc_id >= 100")), model, vocab).collect()}
    assert abs(got[100] - got[200] - np.log(20)) < 1e-4
    new = spark.createDataFrame([(1, "never"), (2, a)], "doc_id long, text string")
    assert np.isfinite([r["log_likelihood"] for r in pseudolm.score(new, model, vocab).collect()]).all()


def test_a_documents_score_by_hand(spark):
    """Word by word, in plain sums over all groups and classes, with the counts taken anew."""
    docs = table(spark, SF, "documents").select("doc_id", "text").limit(60)
    model, vocab = pseudolm.fit(docs)
    rows = {r.doc_id: r.text for r in docs.collect()}
    counts, hashed = {}, {}
    for t in rows.values():
        buf, offsets = pseudolm.X.byte_column(pseudolm.pa.array([t]))
        words = pseudolm.X.word_hashes(buf, *pseudolm.X.word_bounds(buf, offsets)[:2], lower=True)
        hashed[t] = words
        for w in words.tolist():
            counts[w] = counts.get(w, 0) + 1
    frequent = {w: c for w, c in zip(vocab.top.tolist(), vocab.classes.tolist())}
    of = lambda w: frequent.get(w, vocab.first_bucket + (w & (pseudolm.BUCKETS - 1)))
    in_bucket = {}
    for w, n in counts.items():
        in_bucket[of(w)] = in_bucket.get(of(w), 0) + n
    got = {r["doc_id"]: r["log_likelihood"] for r in pseudolm.score(docs, model, vocab).collect()}
    for d in sorted(rows, key=lambda d: len(rows[d]))[3:9]:
        words, total = [int(w) for w in hashed[rows[d]]], 0.0
        for i, w in enumerate(words):
            x = model["h"].astype(np.float64).copy()
            for k, off in enumerate([-3, -2, -1, 1, 2, 3]):
                c = of(words[i + off]) if 0 <= i + off < len(words) else vocab.size
                x += model["e"][c].astype(np.float64) @ model["w"][k]
            h, members = np.tanh(x), model["b"].shape[1]
            group, place = divmod(of(w), members)
            for z, at in ((h @ model["g"] + model["a"], group), (h @ model["o"][group] + model["b"][group], place)):
                total += z[at] - np.log(np.exp(z).sum())
            if of(w) >= vocab.first_bucket:
                total += np.log(counts[w] / (in_bucket[of(w)] + 1))
        assert abs(total - got[d]) < 1e-3 * max(1, abs(total))


def test_the_networks_gradient(monkeypatch):
    """One step of ``train`` moves each weight against the slope of the mean log-probability."""
    model = pseudolm.start(classes=30)
    rng = np.random.default_rng(1)
    around, target = rng.integers(0, 31, (50, 6)), rng.integers(0, 30, 50)
    stepped, state = {k: v.copy() for k, v in model.items()}, {}
    pseudolm.train(stepped, around, target, state)
    for name in ("e", "w", "h", "g", "a", "o", "b"):
        flat = state[name][0].ravel() / 0.1  # the gradient, as Adam's first moment has it
        for i in np.argsort(-np.abs(flat))[:3]:
            sides = []
            for step in (1e-2, -1e-2):
                moved = {k: v.astype(np.float64) for k, v in model.items()}
                moved[name].reshape(-1)[i] += step
                sides.append(-pseudolm.log_probs(moved, around, target).mean())
            assert abs((sides[0] - sides[1]) / 2e-2 - flat[i]) < 0.02 * abs(flat[i]) + 1e-4, name


def test_every_document_is_trained_on_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def count(model, vocab):
        def run(batches):
            for batch in batches:
                seen.add(sum(len(t.split()) for t in batch.column("text").to_pylist()))
            yield from ()

        return run

    monkeypatch.setattr(pseudolm, "_train_partition", count)
    pseudolm.fit(spark.createDataFrame([(i, "a b c") for i in range(200)] + [(None, "d e")], "doc_id long, text string"))
    assert seen.value == 602


def test_classes_grow_with_the_distinct_words(spark, monkeypatch):
    monkeypatch.setattr(pseudolm, "TOP", 4)
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(50)], "doc_id long, text string")
    vocab = pseudolm.vocabulary(docs)
    assert len(vocab.top) == 15 and vocab.size == 15 + pseudolm.BUCKETS and round(vocab.total.sum()) == 1000 - 15
