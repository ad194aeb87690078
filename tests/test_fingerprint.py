import time

from shopmetrics.operators import fingerprint as FP
from shopmetrics.sources import tables as TB


def test_content_fingerprint_order_insensitive_duplicate_sensitive(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (1, "x")], "k int, v string").repartition(3)
    c = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k int, v string")
    d = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (2, "y")], "k int, v string")
    fa, fb, fc = (FP.content_fingerprint(x, "t").first() for x in (a, b, c))
    fd = FP.content_fingerprint(d, "t").first()
    assert fa.hash == fb.hash and fa.rows == 2
    assert fc.hash != fa.hash and fd.hash != fa.hash and fd.hash != fc.hash


def test_changed_tables(spark):
    old = spark.createDataFrame([("same", 1, 10), ("diff", 1, 11), ("gone", 1, 12)], "table_name string, rows long, hash long")
    new = spark.createDataFrame([("same", 1, 10), ("diff", 1, 99), ("new", 2, 13)], "table_name string, rows long, hash long")
    got = {r.table_name: r.status for r in FP.changed_tables(old, new).collect()}
    assert got == {"same": "unchanged", "diff": "changed", "gone": "gone", "new": "new"}
    assert {r.table_name for r in FP.changed_tables(old, new, only_changes=True).collect()} == {"diff", "gone", "new"}


def test_file_fingerprint_and_retrain_rule(spark, workdir):
    df = spark.range(10)
    TB.write_table(df, f"{workdir}/t")
    f1 = FP.file_fingerprint(spark, "t", f"{workdir}/t")
    r1 = f1.first()
    assert r1.rows >= 1
    time.sleep(1.1)
    TB.write_table(df, f"{workdir}/t")
    f2 = FP.file_fingerprint(spark, "t", f"{workdir}/t")
    ch = FP.changed_tables(f1, f2)
    assert ch.first().status == "changed"
    same = FP.changed_tables(f2, f2)
    assert FP.should_retrain(same, 10, 90, False) is False
    assert FP.should_retrain(same, 100, 90, False) is True
    assert FP.should_retrain(ch, 10, 90, False) is True
    assert FP.should_retrain(ch, 100, 90, True) is False
