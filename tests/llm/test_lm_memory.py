"""What a worker of operator 5 is sent at once is bounded in bytes, and neither its chunks nor its results depend on it."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shopmetrics.llm import pseudolm
from shopmetrics.llm.store import SHORT, on_workers, short_batches

TEXTS = ["a b", "", None, "c" * 9, "dd ee ff", "x"] * 5


def _batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])


def test_chunks_are_the_same_however_rows_are_dealt_to_batches():
    def chunks(*cuts):
        batches = (_batch(TEXTS[a:b]) for a, b in zip(cuts[:-1], cuts[1:]))
        return [c.column("text").to_pylist() for c in pseudolm._chunks(batches, 12)]

    whole = chunks(0, 30)
    assert len(whole) > 3 and sum(whole, []) == TEXTS
    for cuts in ((0, 1, 2, 3, 30), (0, 0, 7, 7, 30, 30), (0, 29, 30), range(31)):
        assert chunks(*cuts) == whole
    assert chunks(0) == chunks(0, 0) == []


def test_texts_reach_the_workers_in_batches_of_bounded_bytes(spark, monkeypatch):
    """24 MB of text in one partition were one batch before, in the JVM's Arrow buffers, on the way and in the worker."""
    sent, large = (spark.sparkContext.accumulator(0) for _ in range(2))
    docs = spark.range(24, numPartitions=1).select(F.col("id").alias("doc_id"), F.expr("repeat(concat(repeat('x', 999), ' '), 1000)").alias("text"))
    plain = type(docs).mapInArrow

    def counted(self, func, *args, **more):
        def run(batches):
            def each():
                for batch in batches:
                    sent.add(1)
                    large.add(int(batch.column("text").nbytes > 6_000_000))
                    yield batch

            return func(each())

        return plain(self, run, *args, **more)

    monkeypatch.setattr(type(docs), "mapInArrow", counted)
    on_workers(spark)
    got = pseudolm.score(docs, *pseudolm.fit(docs)).agg(F.count("*"), F.sum("n_words")).first()
    assert tuple(got) == (24, 24_000) and sent.value > 0
    assert large.value == 0


def test_the_sessions_own_settings_hold_again(spark):
    before = {k: spark.conf.get(k, None) for k in SHORT}
    with pytest.raises(ValueError), short_batches(spark):
        assert {k: spark.conf.get(k) for k in SHORT} == SHORT
        raise ValueError
    assert {k: spark.conf.get(k, None) for k in SHORT} == before
