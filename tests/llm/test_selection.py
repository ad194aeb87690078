"""License scans, importance resampling and the filter audit: against brute force, edge cases, hot keys."""

import math
import os
import random
import re
import sys
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from shopmetrics.llm import alnum, audit, importance, licenses  # noqa: E402
from shopmetrics.llm.store import on_workers, table  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def _workers(spark):
    on_workers(spark)


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, 0) for i, t in rows], DOCS)


ODD = [(None, None), (None, "x"), (7, "x"), (7, "y\n\n z"), (7, "x"), (8, ""), (9, "\n\n"), (10, "ÀB c1\x00d e \U0001f600f"), (11, "w " * 3000 + "q" * 5000),
       (12, "a\nb\nc\nd\ne f g"), (13, "under THE\nmit--License"), (14, "apache license version 2" * 2), (15, "CC BY-NC " * 40)]


def test_words_and_crcs_of_bytes():
    texts = [t for _, t in ODD]
    for lo, hi, buf, starts, ends, first in alnum.word_chunks(pa.array(texts)):
        got = [bytes(buf[s:e]).decode() for s, e in zip(starts, ends)]
        assert got == [w for t in texts[lo:hi] for w in words(t)] and np.diff(first).tolist() == [len(words(t)) for t in texts[lo:hi]]
        assert alnum.crc32_spans(buf, starts, ends).tolist() == [zlib.crc32(w.encode()) for w in got]
        out, s, e = alnum.joined(buf, starts, ends)
        assert bytes(out).decode() == "".join(w + " " for w in got) and [bytes(out[a:b]).decode() for a, b in zip(s, e)] == got


# op 11 ------------------------------------------------------------------------------------------------


def brute_places(text):
    w, out = words(text), []
    for label, phrase in licenses.PHRASES:
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return len(w), out


def check_places(rows, got):
    want = Counter()
    for d, t in rows:
        n, at = brute_places(t)
        want[d, n, len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))] += 1
    assert want == Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got)


def test_base_places_of_given_and_odd_documents(spark):
    docs = table(spark, SF, "documents")
    got = licenses.scan(docs).collect()
    check_places([(r.doc_id, r.text) for r in docs.collect()], got)
    assert any(r["n_base"] for r in got) and all(set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)
    assert all((r["score"] == 1) >= (r["n_base"] > 0) for r in got)
    odd = licenses.scan(frame(spark, ODD).withColumn("t1", F.col("text")).withColumnRenamed("n_chars", "label"))
    check_places(ODD, odd.collect())
    assert licenses.scan(frame(spark, [])).count() == 0


def test_spans_with_words_put_in_left_out_and_changed(spark):
    label, text = licenses.TEMPLATES[7]
    assert label == "mit"
    w = text.split()
    noise = ["lorem", "ipsum", "dolor", "sit"] * 10
    cases = {
        1: noise + w + noise,
        2: noise + w[:12] + ["very"] + w[12:] + noise,  # put in: two neighbouring diagonals
        3: w[:10] + w[12:20] + w[21:],  # left out
        4: w[:8] + ["x"] + w[9:],  # changed
        5: w[: len(w) // 2],  # half is no license
        6: [x for pair in zip(w, noise) for x in pair],  # no run of three words in common
        7: w[:10] + noise + w[10:],  # the halves are too far apart
        8: "this work is licensed under the gnu general public license version 3".split(),
    }
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, [(i, " ".join(c).title()) for i, c in cases.items()])).collect()}
    assert [got[i]["labels"] for i in sorted(cases)] == ["mit", "mit", "mit", "mit", "", "", "", "gpl"]
    assert got[1]["score"] == 1 and got[2]["score"] == 1 and 0.8 <= got[4]["score"] < 1 and 0.4 < got[5]["score"] < 0.6 and got[6]["score"] == 0
    assert all(r["n_base"] == 0 and r["base_labels"] == "" for r in got.values())


def test_equal_rows_share_their_work_and_stay_rows(spark):
    rows = [(3, "under the mit license")] * 50 + [(3, "apache license version 2")] * 2 + [(4, "under the mit license")]
    got = Counter((r["doc_id"], r["labels"], r["n_base"]) for r in licenses.scan(frame(spark, rows).repartition(5)).collect())
    assert got == {(3, "mit", 1): 50, (3, "apache-2", 1): 2, (4, "mit", 1): 1}


# op 12 ------------------------------------------------------------------------------------------------


def brute_resample(docs, target, grams=1, buckets=10_000, least=20, percent=10):
    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, grams + 1) for i in range(len(w) - k + 1)]

    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(features(x))
    for x in target:
        t.update(features(x))
    ns, nt, out = s.total(), t.total(), []
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (ns + buckets) / ((s[b] + 1.0) * (nt + buckets)))) for b in set(s) | set(t)}
    for d, x in docs:
        f = features(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(brute.sha(f"2024:{'' if d is None else d}")[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(x))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = i
    return Counter(tuple(r[:5]) for r in out)


def check_draw(spark, rows, target, **kw):
    names = {"least": "least_words"}
    got = importance.resample(frame(spark, rows), spark.createDataFrame([(x,) for x in target], "text string"),
                              **{names.get(k, k): v for k, v in kw.items()})
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()) == brute_resample(rows, target, **kw)


def test_draw_of_the_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    check_draw(spark, rows, [r.text for r in table(spark, SF, "benchmark").collect()])


@pytest.mark.parametrize("grams", [1, 2, 3])
def test_draw_with_runs_across_lines(spark, grams):
    rng = random.Random(grams)
    lines = [" ".join(rng.choice("ab cd ef gh ij é K 12".split()) for _ in range(rng.randrange(0, 7))) for _ in range(12)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 9)))) for i in range(60)] + ODD
    check_draw(spark, rows, lines[:3] + [None], grams=grams, buckets=50, least=5, percent=40)


def test_draw_of_odd_tables_and_a_line_in_all_documents(spark):
    check_draw(spark, ODD, [None, ""], least=1, percent=50)
    assert importance.resample(frame(spark, []), spark.createDataFrame([], "text string")).count() == 0
    same = [(i, "the same line\n" * 5 + f"w{i}") for i in range(300)] + [(1, "the same line")] * 40
    check_draw(spark, same, ["the line"], least=2, percent=33)
    wide = frame(spark, ODD).withColumnRenamed("source", "rank").withColumnRenamed("lang", "l1").withColumnRenamed("n_chars", "score")
    assert importance.resample(wide, wide.select("text")).count() == len(ODD)


# op 13 ------------------------------------------------------------------------------------------------


def brute_audit(docs, labels):
    low, good, toxic = {}, set(), set()
    for d, t, _ in docs:
        if d is not None:
            low[t or ""] = min(d, low.get(t or "", d))
    for d, q, x in labels:
        good |= {d} if q == 1 else set()
        toxic |= {d} if x == 1 else set()
    parts = {}
    for d, t, p in docs:
        t, w = t or "", brute.split(t)
        fails = "".join(f for f, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)),
            d is not None and d > low[t])) if bad)
        parts.setdefault(p or "", []).append((fails, d is not None and d in good, d is not None and d in toxic))
    out = set()
    for p, rows in parts.items():
        steps = {}
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for i, f in enumerate(order):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                steps[order, i + 1] = (len(left), len(gone), sum(f in r[0] for r in rows) - len(gone), sum(r[0] == f for r in rows),
                                       sum(r[1] for r in gone), sum(r[2] for r in gone))
        for (order, i), v in steps.items():
            out.add((p, order, i, *v, sum(x[1] for (o, j), x in steps.items() if o[j - 1] == order[i - 1])))
    return out


def check_audit(spark, docs, labels):
    got = audit.audit(spark.createDataFrame([(d, t, p, None, 0) for d, t, p in docs], DOCS),
                      spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    want = brute_audit(docs, labels)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_audit_of_the_given_documents(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in table(spark, SF, "documents").collect()]
    check_audit(spark, docs, [(r.doc_id, r.quality, r.toxic) for r in table(spark, SF, "labels").collect()])


def test_audit_of_odd_and_repeated_rows(spark):
    rng = random.Random(3)
    texts = [t for _, t in ODD] + ["A" * 5, " ".join(f"w{i}" for i in range(100)), " ".join(f"w{i % 79}" for i in range(100)), " ".join(f"w{i % 80}" for i in range(100)), "# b",
                                   "Ab" + "é" * 8, "A" + "é" * 9]
    docs = [(rng.choice([None, *range(30)]), rng.choice(texts), rng.choice([None, "", "en", "fr"])) for _ in range(400)]
    check_audit(spark, docs, [(i % 25, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(40)] + [(None, 1, 1)])
    check_audit(spark, [], [])
    check_audit(spark, docs[:3], [])


def test_wide_integers_hold_one_removal_in_each_order_and_never_overflow(monkeypatch, spark):
    assert audit.WIDE[0] == 0
    for mask in range(1, 32):
        fields = np.frombuffer(audit.WIDE[mask].to_bytes(audit.WIDE_BYTES, "little"), "<u8").reshape(120, 5)
        assert (fields.sum(axis=1) == 1).all()
    most = 2**62
    table_ = audit._sums({"p": [audit.WIDE[31] * most] * 3 + [[0] * 31 + [most]]})
    summed = next(audit._unpack(iter([table_])))
    assert {(r["kept"], r["removed"]) for r in summed.to_pylist()} == {(0, most), (0, 0)}
    # a task that holds more parts than it may sends its sums on early: the same result
    monkeypatch.setattr(audit, "PARTS_HELD", 2)
    rows = [(p, m, 0, 0, 1) for p in "abcd" for m in (0, 5)] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["part", "mask", "good", "toxic", "n"])
    out = pa.Table.from_batches(list(audit._add_rows(iter([batch]))))
    assert out.num_rows > 4 and sum(sum(m) for m in out.column("masks").to_pylist()) == len(rows)
