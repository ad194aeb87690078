import os

import pytest

from pyspark.sql import functions as F

from shopmetrics import schema as S
from shopmetrics.operators import gold as G
from shopmetrics.operators import partials as PT
from shopmetrics.operators import silver as SV
from shopmetrics.plans import incremental as INC
from shopmetrics.plans.refresh import LakePaths, read_bronze
from shopmetrics.sources import ingest as IN
from shopmetrics.sources import tables as TB
from shopmetrics.streaming import stream as ST

from conftest import rows


def _records(spark, n=60):
    data = [(i % 13, f" p{i} ", " cat%d " % (i % 3), float(i % 50), 1.0 + i % 5, i, i % 9, float(i % 7), i % 120,
             "2024-0%d-01" % (1 + i % 9), " City!", i % 2 == 0, f"2024-01-01T00:00:{i % 60:02d}") for i in range(n)]
    return spark.createDataFrame(data, S.BRONZE_SCHEMA)


def _write_messages(df, path, files):
    IN.encode_messages(df).repartition(files).write.text(path)


def _run(spark, src, root, max_files=1, refresh=False):
    paths = LakePaths.under(f"{root}/lake")
    q = ST.start_bronze_stream(ST.read_message_stream(spark, path=src, max_per_trigger=max_files), paths,
                               f"{root}/checkpoint", refresh=refresh, keep_existing_stamp=True)
    q.awaitTermination()
    assert q.exception() is None
    return q, paths


def test_stream_equals_batch_for_any_file_split(spark, workdir):
    recs = _records(spark)
    results = []
    for files in (1, 3, 6):
        src = f"{workdir}/in{files}"
        _write_messages(recs, src, files)
        q, paths = _run(spark, src, f"{workdir}/run{files}")
        assert ST.rows_processed(q) == 60
        results.append(sorted(rows(read_bronze(spark, paths.bronze))))
    assert results[0] == results[1] == results[2] == sorted(rows(recs))


def test_restart_from_checkpoint_adds_nothing(spark, workdir):
    src = f"{workdir}/in"
    _write_messages(_records(spark), src, 2)
    _, paths = _run(spark, src, f"{workdir}/run")
    q2, _ = _run(spark, src, f"{workdir}/run")
    assert ST.rows_processed(q2) == 0
    assert read_bronze(spark, paths.bronze).count() == 60


def test_refresh_builds_silver_and_gold(spark, workdir):
    src = f"{workdir}/in"
    _write_messages(_records(spark), src, 2)
    _, paths = _run(spark, src, f"{workdir}/run", refresh=True)
    silver = TB.read_table(spark, paths.silver)
    assert silver.count() == 13 and "scaled_features" in silver.columns
    rev = TB.read_gold(spark, paths.gold, "revenue_per_category")
    assert sum(r.ProductCount for r in rev.collect()) == 13
    for name in S.GOLD_TABLES:
        assert TB.read_gold(spark, paths.gold, name).count() > 0


def test_csv_file_stream(spark, workdir):
    d = workdir.replace("file:", "") + "/csv"
    os.makedirs(d, exist_ok=True)
    header = ",".join(S.CSV_FIELDS)
    for k in range(3):
        with open(f"{d}/f{k}.csv", "w") as f:
            f.write(header + "\n" + f"{k},a,b,1.5,4,1,1,1,0,2024-01-01,X,TRUE\n" + f"{k + 10},a,b,x,4,1,1,1,0,d,X\n")
    valid = ST.read_csv_stream(spark, d, max_files_per_trigger=1)
    q = valid.writeStream.format("memory").queryName("csv_stream_test").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(r.ProductID for r in spark.sql("SELECT * FROM csv_stream_test").collect())
    assert got == [0, 1, 2]


def test_missing_table_error(spark, workdir):
    import pytest
    with pytest.raises(TB.TableNotFound):
        TB.read_table(spark, f"{workdir}/nothing", fmt=("delta", "parquet"))


def _bronze_batches(spark, paths, batches, **options):
    """Append each batch to bronze and run the refresh query after it; the folders that each run touched."""
    out = []
    for k, b in enumerate(batches):
        ST.append_batch(b, k, paths.bronze, "test")
        out.append(INC.refresh_now(spark, paths, state_partitions=2, **options))
    return out


def _same_as_full(spark, paths, recs):
    """Silver, its vectors and all gold tables against the batch code over all records."""
    full = SV.clean_products(SV.latest_per_product(recs))
    stored = INC.read_silver(spark, paths.silver)
    assert sorted(rows(stored.select(*full.columns)), key=str) == sorted(rows(full), key=str)
    near = lambda v: [None if x is None else round(x, 9) for x in v]
    vectors = lambda df: sorted((r.ProductID, near(r.features), near(r.scaled_features)) for r in df.collect())
    assert vectors(INC.scaled_silver(spark, paths)) == vectors(SV.scale_columns(full, vectors=True))
    for name, table in G.gold_tables(full).items():
        got, want = ([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()]
                     for df in (TB.read_gold(spark, paths.gold, name), table))
        assert sorted(got, key=str) == sorted(want, key=str), name


def test_incremental_refresh_equals_full(spark, workdir):
    recs = _records(spark, 90)
    batches = [recs.where(F.col("NumReviews") % 3 == k) for k in range(3)]  # products recur across batches
    paths = LakePaths.under(f"{workdir}/inc")
    _bronze_batches(spark, paths, batches)
    _same_as_full(spark, paths, recs)
    assert INC.refresh_now(spark, paths) == []  # nothing new: no micro-batch
    ST.append_batch(batches[2], 7, paths.bronze, "again")  # records that are there already change nothing
    INC.refresh_now(spark, paths)
    _same_as_full(spark, paths, recs)
    assert not os.listdir(f"{paths.state}/staged".replace("file:", ""))  # staging goes when it has been published


def _product(spark, number, day, price=5.0, stamp="2024-06-01T00:00:00", category="c"):
    return spark.createDataFrame([(number, "p", category, price, 4.0, 3, 3, 2.0, 10, day, "X", True, stamp)], S.BRONZE_SCHEMA)


def test_a_change_rewrites_the_folders_it_touches(spark, workdir):
    """A product that changes its month leaves the old folder; no other folder's files are written again."""
    paths = LakePaths.under(f"{workdir}/lake")
    first = _records(spark, 60).unionByName(_product(spark, 500, "2020-02-02")).unionByName(_product(spark, 501, None))
    moved = _product(spark, 500, "2024-03-09", stamp="2024-07-01T00:00:00")
    (all_,), = _bronze_batches(spark, paths, [first])
    assert (2020, 2) in all_ and (None, None) in all_

    def files(root):
        d = root.replace("file:", "")
        return {f"{os.path.relpath(p, d)}/{n}" for p, _, names in os.walk(d) for n in names if n.endswith(".parquet")}

    roots = [paths.silver, f"{paths.partials}/by_key", f"{paths.partials}/by_price"]
    before = [files(r) for r in roots]
    ST.append_batch(moved, 1, paths.bronze, "test")
    (folders,) = INC.refresh_now(spark, paths)
    assert folders == [(2020, 2), (2024, 3)]
    for r, old in zip(roots, before):
        now = files(r)
        assert not any("Year=2020/Month=2/" in f for f in now)  # its last row has left
        assert {f for f in old ^ now if "Year=2024/Month=3/" not in f and "Year=2020/Month=2/" not in f} == set()
    _same_as_full(spark, paths, first.unionByName(moved))
    plan = INC.rewritten(INC.read_silver(spark, paths.silver), INC.read_silver(spark, paths.silver).limit(1), folders)
    scan = [x for x in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x][0]
    assert "Year" in scan.split("PartitionFilters: ")[1].split("]")[0]  # other folders are not read


@pytest.mark.parametrize("step", ["staged", "silver", "partials", "gold"])
def test_a_run_killed_between_two_writes_is_made_good(spark, workdir, monkeypatch, step):
    recs = _records(spark, 90)
    batches = [recs.where(F.col("NumReviews") % 2 == k) for k in range(2)]
    paths = LakePaths.under(f"{workdir}/lake")
    _bronze_batches(spark, paths, batches[:1])
    replace, publish, calls = INC.replace_folders, INC.publish, []

    def killed(*a, **kw):
        raise RuntimeError("killed")

    def replace_some(df, path, emptied):
        if step == "staged" or (step == "silver" and path != paths.silver):
            killed()
        replace(df, path, emptied)
        if step == "silver":  # the worst that a killed overwrite leaves: folders removed and their new files not yet there
            for folder in calls:
                TB.remove(spark, INC.folder_path(path, folder))

    touched = INC.touched_folders
    monkeypatch.setattr(INC, "touched_folders", lambda *a: calls.extend(touched(*a)) or list(calls))
    monkeypatch.setattr(INC, "replace_folders", replace_some)
    if step != "staged":
        monkeypatch.setattr(INC, "publish", killed if step == "partials" else (lambda *a, **kw: (publish(*a, **kw), killed())))
    ST.append_batch(batches[1], 1, paths.bronze, "test")
    with pytest.raises(Exception, match="killed"):
        INC.refresh_now(spark, paths)
    monkeypatch.undo()
    INC.refresh_now(spark, paths)
    _same_as_full(spark, paths, recs)


def test_odd_values_merge_as_in_one_pass(spark, workdir):
    """Constant columns, nulls, values that no decimal carries, one-row groups, a null category, a rounding tie."""
    def rec(i, cat, price, rating, sales, disc, day):
        return (i, "p", cat, price, rating, 7, 3, sales, disc, day, "X", True, "2024-01-01T00:00:00")
    data = [rec(i, "const", 0.1, 3.3, 1.05 + i % 2, 5, f"2024-0{1 + i % 7}-01") for i in range(21)] + \
        [rec(100, None, None, None, None, None, None), rec(101, "one", 2.5, 2.0, 4.0, 0, "2023-01-01"),
         rec(102, "nan", 3.0, 2.0, float("nan"), 0, "2023-01-01"), rec(103, "nan", 4.0, 5.0, 1e30, 3, "2023-02-01"),
         rec(104, "tie", 4.0, 5.0, 2.34, 3, "2023-02-01"), rec(105, "tie", 4.0, 5.0, 2.35, 3, "2023-03-01"), rec(106, "tie", 9.0, 1.0, 2.345, 0, "2023-03-01")]
    recs = spark.createDataFrame(data, S.BRONZE_SCHEMA)
    full = SV.clean_products(SV.latest_per_product(recs))
    stored, by_price = PT.partials(full), PT.price_partials(full)
    merged, want = PT.gold_from_partials(stored, by_price), G.gold_tables(full)
    for name in S.GOLD_TABLES:
        got, one = (sorted(([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in t.collect()]), key=str) for t in (merged[name], want[name]))
        assert str(got) == str(one), name
    same = full.where("Category = 'CONST'")
    r = PT.scaling_from_partials(PT.partials(same)).first()
    assert r["n_Price"] == 21 and r["sd_Price"] == 0.0 and r["sd_Sales"] > 0
    assert PT.scaling_from_partials(PT.partials(full.limit(0))).first()["n_Price"] == 0


def test_observed_reject_counts(spark):
    from pyspark.sql import Observation
    raw = spark.createDataFrame([("1", "a", "b", "1.0", "4", "1", "1", "1", "0", "d", "c", "TRUE", None),
                                 ("x", "a", "b", "1.0", "4", "1", "1", "1", "0", "d", "c", "TRUE", None)],
                                IN.RAW_CSV_SCHEMA)
    obs = Observation("csv")
    valid, _ = IN.products_from_csv(raw, observe=obs)
    assert valid.count() == 1
    assert obs.get == {"rows": 2, "rejected": 1}


def test_failed_batch_is_replayed_without_duplicates(spark, workdir):
    """A batch that dies after its bronze write (before the commit) is replayed on restart and
    replaces its own partition: bronze ends with every record exactly once."""
    recs = _records(spark, 60)
    src = f"{workdir}/in"
    _write_messages(recs, src, 3)
    paths = LakePaths.under(f"{workdir}/lake")
    checkpoint = f"{workdir}/checkpoint"
    failed = {"done": False}

    def crash_once(batch, batch_id):
        if batch_id == 1 and not failed["done"]:
            failed["done"] = True
            raise RuntimeError("simulated executor loss after the bronze write")

    stream = ST.read_message_stream(spark, path=src, max_per_trigger=1)
    q = ST.start_bronze_stream(stream, paths, checkpoint, keep_existing_stamp=True, on_batch=crash_once)
    try:
        q.awaitTermination()
    except Exception:
        pass
    assert failed["done"] and q.exception() is not None
    q2 = ST.start_bronze_stream(ST.read_message_stream(spark, path=src, max_per_trigger=1), paths, checkpoint,
                                keep_existing_stamp=True)
    q2.awaitTermination()
    assert q2.exception() is None
    assert sorted(rows(read_bronze(spark, paths.bronze))) == sorted(rows(recs))


def _one_stream(spark, recs, root, name, refresh, files=1):
    """One source with its own checkpoint, writing to the lake under ``root``."""
    src = f"{root}/in-{name}"
    _write_messages(recs, src, files)
    paths = LakePaths.under(f"{root}/lake")
    q = ST.start_bronze_stream(ST.read_message_stream(spark, path=src, max_per_trigger=1, keep_rejected=True), paths,
                               f"{root}/checkpoint-{name}", refresh=refresh, keep_existing_stamp=True)
    q.awaitTermination()
    assert q.exception() is None
    return paths


@pytest.mark.parametrize("refresh", ["full", "incremental"])
def test_two_streams_append_to_one_lake(spark, workdir, refresh):
    recs = _records(spark, 45)
    first, second = recs.where("NumReviews < 30"), recs.where("NumReviews >= 30")
    _one_stream(spark, first, workdir, "a", refresh, files=2)
    paths = _one_stream(spark, second, workdir, "b", refresh)
    assert sorted(rows(read_bronze(spark, paths.bronze))) == sorted(rows(recs))
    full = SV.clean_products(SV.latest_per_product(recs))
    assert sorted(rows(TB.read_table(spark, paths.silver).select(*full.columns)), key=str) == sorted(rows(full), key=str)
    assert sum(r.ProductCount for r in TB.read_gold(spark, paths.gold, "revenue_per_category").collect()) == 13
    assert sorted(r["rows"] for r in ST.rows_stored(spark, paths).collect()) == [15, 30]


def test_a_lost_checkpoint_loses_nothing(spark, workdir):
    """The source is read again under a new stream id: bronze keeps what was there, silver and gold are unchanged. The same
    for the refresh query: under a new checkpoint it reads all of bronze again."""
    recs = _records(spark, 40)
    paths = _one_stream(spark, recs, workdir, "a", "incremental")
    q = ST.start_bronze_stream(ST.read_message_stream(spark, path=f"{workdir}/in-a"), paths, f"{workdir}/another",
                               refresh="incremental", keep_existing_stamp=True)
    q.awaitTermination()
    assert q.exception() is None
    assert read_bronze(spark, paths.bronze).distinct().count() == 40 and read_bronze(spark, paths.bronze).count() == 80
    _same_as_full(spark, paths, recs)
    INC.refresh_now(spark, paths, checkpoint=f"{workdir}/third", state_partitions=2)
    _same_as_full(spark, paths, recs)


def test_several_streams_and_one_refresh_query(spark, workdir):
    """Two sources append side by side; one query takes in what both have gained, in micro-batches of one file."""
    recs = _records(spark, 45)
    _one_stream(spark, recs.where("NumReviews < 30"), workdir, "a", None, files=2)
    paths = _one_stream(spark, recs.where("NumReviews >= 30"), workdir, "b", None)
    assert len(INC.refresh_now(spark, paths, max_files_per_trigger=1, state_partitions=2)) >= 2
    _same_as_full(spark, paths, recs)


@pytest.mark.parametrize("refresh", ["full", "incremental"])
def test_a_batch_without_a_valid_row_does_no_harm(spark, workdir, refresh):
    d = workdir.replace("file:", "")
    os.makedirs(f"{d}/csv", exist_ok=True)
    paths = LakePaths.under(f"{workdir}/lake")

    def run():
        records = ST.read_csv_stream(spark, f"{d}/csv", header=False, keep_rejected=True, max_files_per_trigger=1)
        q = ST.start_bronze_stream(records, paths, f"{workdir}/checkpoint", refresh=refresh, stamp="2024-01-01")
        q.awaitTermination()
        assert q.exception() is None

    with open(f"{d}/csv/a.csv", "w") as f:
        f.write("1,a,b,x,4,1,1,1,0,d,c,TRUE\n")
    run()
    assert [r.RejectReason for r in spark.read.parquet(paths.rejected).collect()] == ["Price"]
    with open(f"{d}/csv/b.csv", "w") as f:
        f.write('2,"two\nlines",b,1.5,4,1,1,1,0,d,c,TRUE\n3,a,b,1.5d,4,1,1,1,0,d,c,TRUE\n')
    run()
    assert [(r.ProductID, r.ProductName) for r in read_bronze(spark, paths.bronze).collect()] == [(2, "two\nlines")]
    assert TB.read_gold(spark, paths.gold, "revenue_per_category").count() == 1
    assert sorted(r.ProductID for r in spark.read.parquet(paths.rejected).collect()) == [1, 3]


def test_malformed_messages_are_rejected(spark, workdir):
    values = ['{"ProductID":1}', "not json", '{"ProductID":"x"}', "", None, "[1]", "{}"]
    valid, bad = IN.split_messages(spark.createDataFrame([(v,) for v in values], "value string"))
    assert [r.ProductID for r in valid.collect()] == [1, None] and valid.columns == S.BRONZE_COLUMNS
    assert [r.value for r in bad.collect()] == ["not json", '{"ProductID":"x"}', "", None, "[1]"]


def test_state_partitions_grow_with_bronze(spark, workdir, monkeypatch):
    paths = LakePaths.under(f"{workdir}/lake")
    assert INC.state_partitions_for(spark, paths) == 8
    ST.append_batch(_records(spark), 0, paths.bronze, "test")
    assert INC.state_partitions_for(spark, paths) == 8
    monkeypatch.setattr(INC, "STATE_PARTITION_BYTES", 100)
    assert INC.state_partitions_for(spark, paths) > 8


def test_message_files_are_bounded_and_micro_batches_few(spark, monkeypatch):
    from shopmetrics.plans import catalog as C
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(C, "FILE_ROWS", 500)
    src = C._messages(spark, sf)
    files = spark.read.text(src).inputFiles()
    assert len(files) > C.MICRO_BATCHES and all(f.endswith(".gz") for f in files)
    assert max(r["n"] for r in spark.read.text(src).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()) <= 500
    assert len(files) / C._files_per_trigger(spark, src, 1) <= C.MICRO_BATCHES
    paths = C._run_stream(spark, sf, refresh=None)
    stored = spark.read.parquet(paths.bronze)
    assert stored.select("_batch_id").distinct().count() == C.MICRO_BATCHES
    assert sorted(rows(read_bronze(spark, paths.bronze)), key=str) == sorted(rows(C.q_bronze_products(spark, sf)), key=str)


def test_a_batch_is_parsed_again_only_for_rejected_rows(spark, workdir, monkeypatch):
    written, append = [], ST.append_batch
    monkeypatch.setattr(ST, "append_batch", lambda df, k, path, stream="batch": (written.append(path), append(df, k, path, stream)))
    paths = LakePaths.under(f"{workdir}/lake")
    good = IN.encode_messages(_records(spark, 20))
    ST.refresh_batch(IN.tag_messages(good), 0, paths, None, "a")
    assert written == [paths.bronze]
    bad = spark.createDataFrame([("no message",)], "value string")
    ST.refresh_batch(IN.tag_messages(good.unionByName(bad)), 1, paths, None, "a")
    ST.refresh_batch(IN.tag_messages(bad), 2, paths, None, "a")
    assert written[1:] == [paths.bronze, paths.rejected] * 2
    assert read_bronze(spark, paths.bronze).count() == 40
    assert [r.value for r in spark.read.parquet(paths.rejected).collect()] == ["no message"] * 2


def test_a_count_that_is_not_told_is_unknown(spark):
    from pyspark.sql import Observation
    never = Observation()
    spark.range(3).observe(never, F.count("*").alias("rejected"))
    assert ST.observed(never, "rejected", seconds=0.5) is None


def test_a_products_records_stand_in_one_file(spark, workdir):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ST.append_batch(_records(spark, 60).repartition(5), 0, f"{workdir}/bronze", "a")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(f"{workdir}/bronze").select("ProductID", F.input_file_name().alias("file"))
    assert stored.select("file").distinct().count() > 1
    assert stored.groupBy("ProductID").agg(F.countDistinct("file").alias("n")).where("n > 1").isEmpty()


def test_a_refresh_inside_a_stream_has_its_own_state_partitions(spark, workdir, monkeypatch):
    monkeypatch.setattr(ST, "state_partitions_for", lambda *_: 3)
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    paths = _one_stream(spark, _records(spark, 30), workdir, "a", "incremental")
    state = f"{paths.state}/checkpoint/state/0".replace("file:", "")
    assert sorted(d for d in os.listdir(state) if d.isdigit()) == ["0", "1", "2"]
    assert {name: spark.conf.get(name) for name in before} == before
    _same_as_full(spark, paths, _records(spark, 30))
