"""The pipeline's stages, each against brute force on its own input; the registered queries' columns."""

import os
import random
import sys
from collections import Counter

import pytest

import corpus_pipeline as P

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from shopmetrics.llm import langid, queries  # noqa: E402
from shopmetrics.llm.store import keep, on_workers, table  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGE = dict(P.STAGES)


@pytest.fixture(autouse=True)
def _workers(spark):
    on_workers(spark)


@pytest.fixture(scope="module")
def through(spark):
    """The input and output of each stage."""
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in P.STAGES:
        after = keep(stage(spark, docs, SF), name)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_columns(through):
    for name, (_, after) in through.items():
        assert name == "best_fit_packing" or after.columns == COLUMNS


def test_language_keeps_recognised_documents_as_they_are(spark, through):
    docs, after = through["language_id"]
    named = langid.identify(docs, *langid.fit(docs)).collect()
    want = [tuple(r)[:5] for r in named if r["lang_pred"] != "und" and r["score"] >= P.LEAST_SCORE]
    assert rows(after) == sorted(want, key=str) and len(want) > 0.98 * len(named)
    odd = spark.createDataFrame([(1, None, "en", "s", 0), (2, "12 34", "en", "s", 5), (3, "the and with", "en", "s", 12)], docs.schema)
    assert [r["doc_id"] for r in STAGE["language_id"](spark, odd.unionByName(docs), SF).where("doc_id IN (1, 2, 3) AND source = 's'").collect()] == [3]


def test_near_dedup_keeps_the_first_of_each_group(through):
    docs, after = through["near_dedup"]
    want = brute.near_duplicates([(r.doc_id, r.text) for r in docs.collect()], percent=P.LEAST_SIMILAR)
    assert {r.doc_id for r in after.collect()} == {d for d, (_, _, kept) in want.items() if kept}
    assert set(rows(after)) <= set(rows(docs))


def test_substring_dedup_cuts_as_brute_force(through):
    docs, after = through["substring_dedup"]
    want = brute.cut_repeats([(r.doc_id, r.text) for r in docs.collect()])
    before = {r.doc_id: r.text for r in docs.collect()}
    got = {r["doc_id"]: r for r in after.collect()}
    assert got.keys() == {d for d, (n, gone, _) in want.items() if gone < n or n == 0}
    for d, r in got.items():
        assert r["text"] == (want[d][2] if want[d][1] else before[d]) and r["n_chars"] == len(r["text"])


def test_mix_repeats_documents_near_the_targets(through):
    docs, after = through["mix_sources"]
    size = {r.doc_id: (len(r.text.encode().split()), r.source) for r in docs.collect()}
    total, taken = {}, {}
    for n, s in size.values():
        total[s] = total.get(s, 0) + n
    copies = Counter(r["doc_id"] for r in after.collect())
    assert set(copies.values()) <= {1, 2} and set(rows(after)) <= set(rows(docs))
    for d, k in copies.items():
        taken[size[d][1]] = taken.get(size[d][1], 0) + k * size[d][0]
    want, most = brute.water_fill(total), max(n for n, _ in size.values())
    assert all(abs(taken.get(s, 0) - want[s]) <= 2 * most for s in want)


def test_packing_holds_every_document_of_the_mix(through):
    docs, after = through["best_fit_packing"]
    first = Counter(r["doc_id"] for r in after.collect() if r["piece"] == 0)
    assert first == Counter(r["doc_id"] for r in docs.collect())


def test_stages_of_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, component_id int"
    odd = spark.createDataFrame([(1, "a b c d e f", "en", None, 11, 1), (1, "a b c d e f", "en", None, 11, 1), (2, None, None, "s", None, 1), (3, "", "en", "s", 0, 1),
                                 (None, "x y z", "en", "s", 5, 1), (4, "w " * 50_000, "en", "s", 100_000, 1)], schema)
    for docs in (odd, odd.limit(0)):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            ids = {r["doc_id"] for r in out.select("doc_id").collect()}
            assert ids <= {r["doc_id"] for r in docs.collect()} and (name == "best_fit_packing" or out.columns == docs.columns)
    assert sorted(r["doc_id"] or 0 for r in STAGE["near_dedup"](spark, odd, SF).collect()) == [0, 1, 2, 3, 4]


def test_near_dedup_takes_rows_not_ids(spark):
    """A repeated id with another text is a row of its own; copies of either text go."""
    rng = random.Random(4)
    a, b, c = (" ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(99)) for _ in range(60)) for _ in range(3))
    given = [(1, a), (1, b), (1, b), (2, b + " x"), (3, a), (4, c), (4, c + " y"), (5, ""), (5, ""), (6, None), (5, "   ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in given], "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r["doc_id"], r["text"]) for r in STAGE["near_dedup"](spark, docs, SF).collect())
    of_four = [x for x in got if x[0] == 4]  # one of the two, by its hash
    assert len(of_four) == 1 and of_four[0] in [(4, c), (4, c + " y")]
    assert got == Counter([(1, a), (1, b), of_four[0], (5, ""), (5, "   "), (6, None)])


def test_run_is_the_stages_in_turn(spark, through):
    got, want = P.run(spark, SF), through["best_fit_packing"][1]
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_registered_queries():
    import __spark_entry__ as E

    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries()) and set(queries.ORACLE) <= set(E.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
