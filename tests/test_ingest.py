import os
import random

import pytest
from pyspark.sql import functions as F

from shopmetrics import schema as S
from shopmetrics.sources import ingest as IN
from shopmetrics.sources import quoted as Q

from conftest import rows

RAW = "\n".join([
    "ProductID,ProductName,Category,Price,Rating,NumReviews,StockQuantity,Sales,Discount,DateAdded,City,StockStatus",
    "1, Lamp ,home,19.99,4.5,120,30,0.5,10,2024-03-01,Oslo!,TRUE",
    '2,"Desk, oak",home,500.01,5.0,5001,1001,12.0,51,n/a,St. John 3,FALSE',
    "3,Pen,office,-1,0.9,-5,-2,-3,150,2024-04-02,Rome,true",
    "4,Cup,home,x,4,1,1,1,0,2024-04-02,Rome,TRUE",
    "5,Mug,home,7.5,4,1,1,1,0,2024-04-02,Rome",
    "6,Hat,home,7.5,4,1",
    "7,Cap,home,7.5,4,1,1,1,0,2024-04-02",
    '8,"Say ""hi""",,7.5,4,1,1,1,0,,,TRUE',
]) + "\n"


def _write(path, text, name="products.csv"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_csv_parse_keeps_and_rejects(spark, workdir):
    d = workdir.replace("file:", "")
    _write(d, RAW)
    _write(d, "ignored", name="notes.txt")
    valid, rejected = IN.products_from_csv(IN.read_product_csv(spark, d))
    v = {r.ProductID: r for r in valid.collect()}
    assert sorted(v) == [1, 2, 3, 5, 8]
    assert v[1].ProductName == " Lamp " and v[1].StockStatus is True
    assert v[2].ProductName == "Desk, oak" and v[2].Price == 500.01 and v[2].StockStatus is False
    assert v[3].StockStatus is False          # 'true' is not 'TRUE'
    assert v[5].StockStatus is False          # 11 fields: StockStatus missing
    assert v[8].ProductName == 'Say "hi"' and v[8].Category == "" and v[8].City == ""
    rej = {r.ProductID: r.RejectReason for r in rejected.collect()}
    assert rej == {4: "Price", 6: "StockQuantity", 7: "field_count"}


def test_csv_narrow_projection_still_rejects_short_rows(spark, workdir):
    d = workdir.replace("file:", "")
    _write(d, RAW)
    valid, _ = IN.products_from_csv(IN.read_product_csv(spark, d))
    assert sorted(r[0] for r in valid.select("ProductID").collect()) == [1, 2, 3, 5, 8]


def test_json_message_roundtrip(spark):
    msg = ('{"ProductID":1,"ProductName":" Lamp ","Category":"home","Price":19.99,"Rating":4.5,'
           '"NumReviews":120,"StockQuantity":30,"Sales":0.5,"Discount":10,"DateAdded":"2024-03-01",'
           '"City":"Oslo!","StockStatus":true}')
    df = IN.decode_messages(spark.createDataFrame([(msg,)], "value string"))
    assert df.columns == S.BRONZE_COLUMNS
    r = df.first()
    assert (r.ProductID, r.Price, r.Discount, r.StockStatus, r.ProcessedTimestamp) == (1, 19.99, 10, True, None)
    again = IN.decode_messages(IN.encode_messages(df))
    assert again.collect() == df.collect()


def test_stamp_arrival(spark):
    df = spark.createDataFrame([("a", None), ("b", "2020-01-01T00:00:00")], "k string, ProcessedTimestamp string")
    lit = {r.k: r.ProcessedTimestamp for r in IN.stamp_arrival(df, ts="2024-01-01T00:00:00").collect()}
    assert lit == {"a": "2024-01-01T00:00:00", "b": "2024-01-01T00:00:00"}
    kept = {r.k: r.ProcessedTimestamp for r in IN.stamp_arrival(df, keep_existing=True).collect()}
    assert kept["b"] == "2020-01-01T00:00:00" and kept["a"][:2] == "20" and "T" in kept["a"]


def test_split_valid_rejected_null_predicate_rejects(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    v, r = IN.split_valid_rejected(df, [("x", F.col("x") > 0)])
    assert [t.x for t in v.collect()] == [1]
    assert sorted((t.x is None, t.RejectReason) for t in r.collect()) == [(False, "x"), (True, "x")]


def test_csv_multiline_quoted_field(spark, workdir):
    d = workdir.replace("file:", "")
    _write(d, RAW.splitlines()[0] + "\n" + '9,"Two\nlines",home,7.5,4,1,1,1,0,2024-04-02,Rome,TRUE\n')
    valid, rejected = IN.products_from_csv(IN.read_product_csv(spark, d, multiline=True))
    got = [(r.ProductID, r.ProductName) for r in valid.collect()]
    assert got == [(9, "Two\nlines")] and rejected.count() == 0


def test_csv_line_breaks_in_quotes_and_number_texts(spark, workdir):
    d = workdir.replace("file:", "")
    _write(d, '1,"a\nb",c,1.5,4,1,1,1,0,d,e,TRUE\n2,x,c,1.5d,4,1,1,1,0,d,e,TRUE\n3,x,c,1e2,4,1,1,1,0,d,e,TRUE\n', name="one.csv")
    _write(d, "4,x,c,.5,4,1,1,1,0,d,e,TRUE\n5,x,c,1,4,1.0,1,1,0,d,e,TRUE\n", name="two.csv")
    open_ = Q.lines_with_open_quotes(Q.lines_of(spark, d, "*.csv"))
    assert [r.file.rsplit("/", 1)[1] for r in open_.select("file").distinct().collect()] == ["one.csv"]
    valid, rejected = IN.products_from_csv(IN.read_product_csv(spark, d, header=False))
    assert {r.ProductID: (r.ProductName, r.Price) for r in valid.collect()} == {1: ("a\nb", 1.5), 3: ("x", 100.0), 4: ("x", 0.5)}
    assert {r.ProductID: r.RejectReason for r in rejected.collect()} == {2: "Price", 5: "NumReviews"}


@pytest.mark.parametrize("seed", range(4))
def test_records_are_cut_in_splits_as_by_the_whole_file_reader(spark, workdir, seed):
    """Files of many splits against the reader that takes each whole: quoted line breaks, doubled and lone quotes, commas in quotes."""
    rng = random.Random(seed)
    d = workdir.replace("file:", "")
    pieces = ["x", "a b", ",", "\n", '""', "é", ", ", "\n\n", "1.5"]

    def field():
        kind = rng.randrange(8)
        if kind == 0:
            return '"' + "".join(rng.choice(pieces) for _ in range(rng.randrange(12))) + '"'
        return rng.choice(["", "a", "TRUE", '5"', 'TV 55" wide', "b c", "7", "'q'"])  # lone quotes open nothing

    for k in range(3):
        body = "".join(",".join([str(i), *(field() for _ in range(11))]) + "\n" for i in range(150))
        _write(d, ",".join(S.CSV_FIELDS) + "\n" + body, name=f"f{k}.csv")
    whole = IN.read_product_csv(spark, d, multiline=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)  # a split holds some ten records and begins anywhere in one
    try:
        lines = Q.lines_of(spark, d, "*.csv")
        assert lines.select("file", "block").distinct().count() > 20
        split = IN.read_product_csv(spark, d)
        fields = S.CSV_FIELDS
        assert sorted(rows(split.select(*fields)), key=str) == sorted(rows(whole.select(*fields)), key=str)
        typed = [sorted(rows(part), key=str) for df in (split, whole) for part in IN.products_from_csv(df)]
        assert typed[0] == typed[2] and len(typed[1]) == len(typed[3])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


def test_lines_of_a_split_are_neither_stored_nor_shuffled(spark, workdir):
    """The largest split decides nothing about memory: between the two looks at the lines, a row for each split is all that is kept."""
    d = workdir.replace("file:", "")
    _write(d, "".join(f'{i},"a{i}\nb",c,1.5,4,1,1,1,0,d,e,TRUE\n' for i in range(20_000)))
    kept = spark.sparkContext.getCheckpointDir().replace("file:", "")
    had = _size(kept)
    records = Q.records(Q.lines_of(spark, d, "*.csv"))
    assert records.count() == 20_000 and records.agg(F.max("record")).first()[0] == 20_000
    assert _size(kept) - had < _size(d) / 10
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("MapInArrow") == 1


def _by_hand(text):
    """The records of a file, a character at a time."""
    out, record, state, k = [], "", "start", 0
    text = text.removesuffix("\n")
    while k < len(text):
        c = text[k]
        if state == "in":
            if text[k:k + 2] == '""':
                record, k = record + c, k + 1
            elif c == '"':
                state = "rest"
        elif c == "\n":
            out.append(record)
            record, state, k = "", "start", k + 1
            continue
        else:
            state = "start" if c == "," else "in" if c == '"' and state == "start" else "rest"
        record, k = record + c, k + 1
    return [*out, record]


@pytest.mark.parametrize("split,batch", [(200, 3), (200, 10_000), (100_000, 1), (100_000, 7)])
def test_records_over_splits_and_batches(spark, workdir, split, batch):
    """Records that run over whole splits and batches of lines, two splits in one task, and quotes that are never closed."""
    d = workdir.replace("file:", "")
    rng = random.Random(split + batch)
    texts = {}
    for k in range(3):
        made = [rng.choice(['{},a,b', '{},"x\ny",b', '{},5" b,"c"', '{},"x ""y""\n\n, z"', '"{}\n","\n"', '{},"é\n1,"']).format(i) for i in range(120)]
        made[40] = '40,"' + "line of a long field, and on\n" * 60 + '",b'
        made[119] = '119,"never closed' * (k == 1) + "\n1,2" * 50 if k else made[119]
        texts[f"f{k}.csv"] = "\n".join(made) + "\n"
        _write(d, texts[f"f{k}.csv"], name=f"f{k}.csv")
    confs = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.execution.arrow.maxRecordsPerBatch": batch}
    before = {c: spark.conf.get(c) for c in confs}
    for c, v in confs.items():
        spark.conf.set(c, v)
    try:
        records = Q.records(Q.lines_of(spark, d, "*.csv"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", 77_777)  # the splits are those of the first look
        got = sorted((r.file.rsplit("/", 1)[1], r.record, r.value) for r in records.collect())
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert got == sorted((name, n + 1, value) for name, text in texts.items() for n, value in enumerate(_by_hand(text)))


def test_a_line_as_a_function_of_the_state_before_it(spark):
    cases = {'a,b': (0, 1), '"a': (1, 0), 'a,"b': (1, 0), '"a","b': (1, 1), 'b",c': (0, 0), 'b","c': (1, 1), '""': (0, 1), 'x"y,z': (0, 0), '"a""': (1, 0),
             '"a"""': (0, 0), '': (0, 1), ',,"': (1, 0), 'TV 5",c': (0, 0), '"a"b",c': (0, 0), '"a", "b': (0, 0)}
    df = spark.createDataFrame([(v,) for v in cases], "value string")
    got = df.select("value", *(Q.ends_inside(F.col("value"), bool(k)).cast("int").alias(f"s{k}") for k in (0, 1))).collect()
    assert {r.value: (r.s0, r.s1) for r in got} == cases


def _runs(df, parser):
    return df._jdf.queryExecution().optimizedPlan().toString().lower().count(parser)


def test_each_record_is_parsed_once(spark, workdir):
    spark.createDataFrame([('1,"a\nb",c,1,2,3,4,5,6,2024-01-01,x,TRUE',), ("2,d",)], "value string").coalesce(1).write.text(f"{workdir}/q")
    valid, rejected = IN.products_from_csv(IN.read_product_csv(spark, f"{workdir}/q", header=False, glob="part-*"))
    assert [r.ProductName for r in valid.collect()] == ["a\nb"] and rejected.count() == 1
    assert _runs(valid, "from_csv") == 1     # not once more for each field that a filter looks at
    for df in IN.split_messages(spark.read.text(f"{workdir}/q")):
        assert _runs(df, "from_json") == 1


def test_a_file_with_quoted_line_breaks_is_read_in_one_way(spark, workdir):
    for k, text in enumerate(['1,"a\nb",c,1,2,3,4,5,6,2024-01-01,x,TRUE', '2,"d",c,1,2,3,4,5,6,2024-01-01,x,TRUE']):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(f"{workdir}/two")
    raw = IN.read_product_csv(spark, f"{workdir}/two", header=False, glob="part-*")
    assert sorted(r.ProductName for r in IN.products_from_csv(raw)[0].collect()) == ["a\nb", "d"]
    assert "Join LeftAnti" not in raw._jdf.queryExecution().optimizedPlan().toString()
