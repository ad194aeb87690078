"""MinHash near-duplicates, substring removal and components against brute force, and their edge cases."""

import os
import random
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from shopmetrics.llm import components, minhash, phrases  # noqa: E402
from shopmetrics.llm import text as X  # noqa: E402
from shopmetrics.llm.store import on_workers, table  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def _workers(spark):
    on_workers(spark)


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def edits(rng, words, share):
    return [f"x{rng.random()}" if rng.random() < share else w for w in words]


def corpus(seed=1):
    """Families of near copies with edits from none to heavy, and documents that share passages."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    out = []
    passage = rng.choices(vocab, k=30)
    for family in range(6):
        base = rng.choices(vocab, k=rng.choice([3, 8, 60, 150]))
        for copy in range(14):
            words = edits(rng, base, rng.choice([0, 0, 0.005, 0.01, 0.02, 0.04]))
            if copy % 5 == 0:
                words = words + passage
            out.append(" ".join(words))
    out += [" ".join(rng.choices(vocab, k=40) + passage + rng.choices(vocab, k=20)) for _ in range(20)]
    out += ["", " \t\n", "One", "one", "ONE two", "a b c d", "A  b\tc\nd", "a b c d e", None]
    rng.shuffle(out)
    return list(enumerate(out, start=100))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_are_those_of_brute_force(spark, seed):
    docs = corpus(seed)
    got = {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(frame(spark, docs)).collect()}
    assert got == brute.near_duplicates(docs)


def test_near_dedup_stage_links_at_80_percent(spark):
    """Pairs of one changed word: n - 9 of n + 1 shingles are shared, 0.80 to 0.88."""
    import corpus_pipeline as P

    rng = random.Random(4)
    docs = []
    for k in range(40):
        base = [f"v{k}x{i}" for i in range(rng.choice([48, 52, 58, 64, 80]))]
        other = [f"new{k}" if i == 20 else w for i, w in enumerate(base)]
        docs += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    want, strict = brute.near_duplicates(docs, 80), brute.near_duplicates(docs)
    assert want != strict
    given = frame(spark, docs)
    assert {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(given, percent=80).collect()} == want
    assert {r["doc_id"] for r in dict(P.STAGES)["near_dedup"](spark, given, SF).collect()} == {d for d, x in want.items() if x[2]}


def test_thresholds_of_the_signatures():
    assert minhash.least_equal(minhash.COORDS, 85, minhash.MISSED) == 10
    assert minhash.least_equal(minhash.SKETCH, 85, minhash.SKETCH_MISSED) == 815
    assert minhash.least_equal(minhash.COORDS, 80, minhash.MISSED) == 8


def test_near_duplicates_on_the_given_documents(spark):
    docs = table(spark, SF, "documents")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == brute.near_duplicates([(r.doc_id, r.text) for r in docs.collect()])


def test_a_large_group_of_near_copies_makes_no_pairs_of_all(spark):
    """Blocks and hubs: 1,300 near copies are one component or their own, as brute force says."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(70)]
    docs = [(i, " ".join(edits(rng, base, rng.choice([0.0, 0.004, 0.01])))) for i in range(1300)]
    got = {r[0]: tuple(r)[1:] for r in minhash.near_duplicates(frame(spark, docs)).collect()}
    assert got == brute.near_duplicates(docs)


def test_near_duplicates_of_nulls_repeats_and_no_rows(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "A b c d e f", "y"), (2, None, "z"), (None, "only here", "q")]
    docs = frame(spark, rows, "doc_id long, text string, rep string").selectExpr("*", "1 AS sig", "'k' AS component_id", "2 AS label")
    got = sorted((tuple(r) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (2, 0, 2, True), (None, 1, None, False)], key=str)
    assert minhash.near_duplicates(frame(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7)]
    nodes = {n for x in links for n in x if x[0] != x[1]}
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: c for n, c in brute.components(sorted({n for x in links for n in x}), links).items() if n in nodes}


def cut(spark, rows, **kw):
    out = phrases.cut_repeats(frame(spark, rows), **kw)
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in out.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_cut_repeats_is_that_of_brute_force(spark, seed):
    rng = random.Random(seed)
    vocab = [f"é{i}" for i in range(30)]
    passages = [rng.choices(vocab, k=n) for n in (20, 21, 25, 60)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(6)):
            words += rng.choice([rng.choices(vocab, k=rng.randrange(30)), rng.choice(passages), rng.choice(passages)[3:], ["z"] * rng.randrange(45)])
        docs.append((i * 3, rng.choice([" ", "\n", " \t"]).join(words)))
    assert cut(spark, docs) == brute.cut_repeats(docs)


def test_cut_repeats_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_BYTES", 20_000)
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert cut(spark, docs) == brute.cut_repeats(docs)


def test_cut_repeats_of_nulls_repeats_and_no_rows(spark):
    long = " ".join(f"w{i}" for i in range(25))
    rows = [(5, long), (5, long), (7, long + "  tail"), (8, None), (9, ""), (None, long), (10, "a  b")]
    docs = frame(spark, rows).selectExpr("*", "1 AS starts", "2 AS row", "3 AS n_words", "4 AS shard")
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"], r["row"]) for r in phrases.cut_repeats(docs).collect()), key=str)
    assert got == sorted([(5, 25, 0, long, 2), (5, 25, 0, long, 2), (7, 26, 25, "tail", 2), (8, 0, 0, "", 2), (9, 0, 0, "", 2),
                          (None, 25, 0, long, 2), (10, 2, 0, "a b", 2)], key=str)
    assert cut(spark, [(10, "a  b")], as_is=True)[10] == (2, 0, "a  b")
    assert cut(spark, []) == {}


def test_words_are_those_of_the_pattern():
    import re

    import pyarrow as pa

    rng = random.Random(4)
    texts = ["".join(rng.choices("aé中 \t\n\x0b\x0c\r\x1c\x85  Z", k=rng.randrange(30))) for _ in range(300)] + [None, ""]
    buf, offsets = X.byte_column(pa.array(texts))
    starts, ends, first = X.word_bounds(buf, offsets)
    raw = buf.tobytes()
    got = [[raw[a:b].decode() for a, b in zip(starts[i:j], ends[i:j], strict=True)] for i, j in zip(first[:-1], first[1:], strict=True)]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    hashes = X.word_hashes(buf, starts, ends)
    words = [w for ws in got for w in ws]
    assert len(set(zip(words, hashes.tolist(), strict=True))) == len(set(words)) == len(np.unique(hashes))
    sliced = pa.array(texts).slice(5, 20)
    assert X.byte_column(sliced)[0].tobytes().decode() == "".join(t or "" for t in texts[5:25])


def test_rows_that_repeat_an_id_with_another_text_are_linked_by_their_own(spark):
    """(1, a), (1, b), (2, near b): the copy of id 2 is found, whichever of id 1's texts comes first."""
    rng = random.Random(8)
    a, b, c = (" ".join(f"w{rng.randrange(10_000)}" for _ in range(80)) for _ in range(3))
    given = [(1, a), (1, b), (2, b + " one two"), (3, c), (1, c), (9, c), (7, a + " x"), (1, "")]
    got = minhash.near_duplicates(spark.createDataFrame(given, "doc_id long, text string").repartition(3)).collect()
    want = {(1, 76): (1, True), (2, 78): (1, False), (3, 76): (1, False), (9, 76): (1, False), (7, 77): (1, False), (1, 0): (1, True)}
    assert len(got) == len(given) and all(want[r["doc_id"], r["n_shingles"]] == (r["component_id"], r["kept"]) for r in got)


def test_a_bucket_writes_a_forest(spark):
    """A large group of near copies: links fewer than members, not pairs; the group is whole."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    want = brute.near_duplicates(docs, percent=80)
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), percent=80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == want
    rows = []
    sig = np.zeros((300, minhash.COORDS), np.int32)
    for i in range(300):
        rows.append({"rep": i, "n": 100, "sig": sig[i], "posted": (1 << minhash.COORDS) - 1, "label": i, "sketch": bytes(minhash.SKETCH),
                     "shingles": np.arange(100), "coord": 0, "block": 0, "key": 1, "one": 0, "two": 0})
    links = minhash._compare_lists(80)(pd.DataFrame(rows))
    assert len(links) == 299 and len(set(brute.components(range(300), links.itertuples(index=False, name=None)).values())) == 1


def test_rows_that_repeat_an_id_are_cut_by_their_own_texts(spark):
    rng = random.Random(11)
    a, b, c = (" ".join(f"w{rng.randrange(10_000)}" for _ in range(60)) for _ in range(3))
    given = [(1, a), (3, a), (3, b), (3, b), (3, c + " " + b), (5, c), (7, "x " + b)]
    got = phrases.cut_repeats(spark.createDataFrame(given, "doc_id long, text string").repartition(4)).collect()
    left = sorted((r["doc_id"], r["n_words"], r["kept_text"]) for r in got)
    assert left == sorted([(1, 60, a), (3, 60, ""), (3, 60, b), (3, 60, b), (3, 120, c + " " + b), (5, 60, ""), (7, 61, "x")])


def test_a_phrase_in_a_third_of_all_documents(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HOT", 7)
    rng = random.Random(12)
    shared = " ".join(f"s{i}" for i in range(30))
    docs = [(i, " ".join([*(f"w{rng.randrange(10**6)}" for _ in range(30)), *([shared] if i % 3 == 0 else [])])) for i in range(120)] + [(500 + i, shared) for i in range(60)]
    got = phrases.cut_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in got} == brute.cut_repeats(docs)
