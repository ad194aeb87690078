"""Job entry points for ``spark-submit`` (the reference's scripts, as Spark jobs).

    spark-submit -m shopmetrics.jobs refresh --root <lake>
    spark-submit -m shopmetrics.jobs publish --csv <dir> --messages <dir> | --kafka host:port/topic
    spark-submit -m shopmetrics.jobs ingest  --root <lake> --csv <dir> | --messages <dir> | --kafka host:port/topic
    spark-submit -m shopmetrics.jobs train   --root <lake> --model <dir> [--keys Category ...] [--small]
    spark-submit -m shopmetrics.jobs score   --model <dir> --requests <json dir> --out <dir>
    spark-submit -m shopmetrics.jobs lookup  --root <lake> --table revenue_per_category [--category X]
    spark-submit -m shopmetrics.jobs coordinate --root <lake> --model <dir> --state <dir> [--min-interval 90]

The session comes from ``spark-submit`` (master, memory, checkpoint dir); nothing is set here.
"""

from __future__ import annotations

import argparse
import sys
import time

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from . import schema as S
from .operators import fingerprint as FP
from .operators import lookup as LK
from .operators import model as ML
from .plans import medallion as MD
from .plans.incremental import refresh_now, start_refresh_stream
from .plans.refresh import LakePaths, refresh_tables
from .sources import ingest as IN
from .sources import tables as TB
from .streaming import stream as ST


def _paths(root: str) -> LakePaths:
    return LakePaths.under(root.rstrip("/"))


def cmd_publish(spark: SparkSession, a) -> None:
    """The producer: every CSV file in a folder -> valid product records -> JSON messages.
    Rejected rows are written next to the messages (``<messages>_rejected``) when a folder is given."""
    valid, rejected = IN.products_from_csv(IN.read_product_csv(spark, a.csv))
    if a.kafka:
        servers, topic = a.kafka.split("/", 1)
        IN.publish_messages(valid, kafka={"bootstrap": servers, "topic": topic})
    else:
        IN.publish_messages(valid, path=a.messages)
        rejected.write.mode("append").json(f"{a.messages.rstrip('/')}_rejected")


def cmd_refresh(spark: SparkSession, a) -> None:
    paths = _paths(a.root)
    if a.continuous:
        start_refresh_stream(spark, paths, available_now=False, processing_time=a.trigger).awaitTermination()
    elif a.incremental:
        refresh_now(spark, paths)
    else:
        refresh_tables(spark, paths)


def cmd_ingest(spark: SparkSession, a) -> None:
    paths = _paths(a.root)
    if a.csv:
        records = ST.read_csv_stream(spark, a.csv, max_files_per_trigger=a.max_per_trigger, keep_rejected=True)
    elif a.kafka:
        servers, topic = a.kafka.split("/", 1)
        records = ST.read_message_stream(spark, kafka={"bootstrap": servers, "topic": topic},
                                         max_per_trigger=a.max_per_trigger, keep_rejected=True)
    else:
        records = ST.read_message_stream(spark, path=a.messages, max_per_trigger=a.max_per_trigger, keep_rejected=True)
    q = ST.start_bronze_stream(records, paths, a.checkpoint or f"{a.root.rstrip('/')}/_checkpoint",
                               refresh=None if a.refresh == "none" else a.refresh, available_now=not a.continuous,
                               processing_time=a.trigger)
    q.awaitTermination()


def cmd_train(spark: SparkSession, a) -> None:
    paths = _paths(a.root)
    keys = a.keys or ["Category"]
    silver = TB.read_table(spark, paths.silver)
    feats = MD.features_from_silver(silver, keys)
    cfg = ML.StackConfig.small() if a.small else ML.StackConfig()
    model, _ = ML.train(feats, keys, config=cfg, leaky=a.leaky)
    imp = ML.feature_importance(spark, model.stack.bases[0], model.names, top=None)
    ML.save_model(model, spark, a.model, importances=imp)


def cmd_score(spark: SparkSession, a) -> None:
    model = ML.load_model(spark, a.model)
    requests = spark.read.schema(ML.REQUEST_SCHEMA).json(a.requests)
    valid, rejected = ML.validate_requests(requests)
    model.score(ML.request_features(valid)).write.mode("overwrite").parquet(f"{a.out}/predictions")
    rejected.write.mode("overwrite").parquet(f"{a.out}/rejected")


def cmd_lookup(spark: SparkSession, a) -> None:
    gold = _paths(a.root).gold
    if a.table == "categories":  # the category list comes from the revenue table
        out = LK.categories(TB.read_gold(spark, gold, "revenue_per_category"))
    else:
        out = LK.lookup(TB.read_gold(spark, gold, a.table), a.category, strict=True)
    if a.out:
        out.write.mode("overwrite").json(a.out)
    else:  # every row, a partition at a time
        for line in out.toJSON().toLocalIterator():
            print(line)


def gold_fingerprints(spark: SparkSession, gold_root: str) -> DataFrame | None:
    """File fingerprints of every stored gold table (the reference hashes their file times)."""
    out = None
    for name in S.GOLD_TABLES:
        try:
            fp = FP.file_fingerprint(spark, name, f"{gold_root}/{name}_parquet")
        except AnalysisException as e:  # a table not written yet has no fingerprint
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        out = fp if out is None else out.unionByName(fp)
    return out


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def cmd_coordinate(spark: SparkSession, a) -> bool:
    """One coordinator tick: retrain when gold changed or the minimum interval has passed.

    State is a small table (table_name, rows, hash, trained_at). A ``_RUNNING`` marker, created
    without overwriting, keeps two ticks from training at once; it is removed afterwards, and one that a killed
    driver left counts no more after ``--lease`` seconds."""
    fs, marker = _fs(spark, f"{a.state}/_RUNNING")
    now = time.time()
    if fs.exists(marker) and now - fs.getFileStatus(marker).getModificationTime() / 1000 > a.lease:
        fs.delete(marker, False)
    new = gold_fingerprints(spark, _paths(a.root).gold)
    if new is None:
        return False
    try:
        old = TB.read_table(spark, f"{a.state}/fingerprints")
        last = old.agg({"trained_at": "max"}).first()[0] or 0.0  # one value
    except TB.TableNotFound:
        old, last = new.limit(0), 0.0
    changes = FP.changed_tables(old.select(*FP.FINGERPRINT_COLUMNS), new)
    if not FP.should_retrain(changes, now - last, a.min_interval, fs.exists(marker)):
        return False
    try:
        fs.create(marker, False).close()
    except Py4JJavaError:
        if fs.exists(marker):  # another tick was first
            return False
        raise
    try:
        cmd_train(spark, a)
        from pyspark.sql import functions as F
        TB.write_table(new.withColumn("trained_at", F.lit(now)), f"{a.state}/fingerprints")
    finally:
        fs.delete(marker, False)
    return True


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shopmetrics.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    pb = sub.add_parser("publish")
    pb.add_argument("--csv", required=True)
    dst = pb.add_mutually_exclusive_group(required=True)
    dst.add_argument("--messages")
    dst.add_argument("--kafka", help="bootstrap-servers/topic")
    r = sub.add_parser("refresh")
    r.add_argument("--root", required=True)
    r.add_argument("--incremental", action="store_true", help="what bronze has gained since the last such run, not the whole of it")
    r.add_argument("--continuous", action="store_true", help="incremental, and keep running: one such job per lake")
    r.add_argument("--trigger", default="10 seconds")
    i = sub.add_parser("ingest")
    i.add_argument("--root", required=True)
    src = i.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv")
    src.add_argument("--messages")
    src.add_argument("--kafka", help="bootstrap-servers/topic")
    i.add_argument("--checkpoint")
    i.add_argument("--refresh", choices=["full", "incremental", "none"], default="incremental",
                   help="none: only append (several ingest jobs beside one 'refresh --continuous')")
    i.add_argument("--max-per-trigger", type=int, dest="max_per_trigger")
    i.add_argument("--continuous", action="store_true", help="keep running with a processing-time trigger")
    i.add_argument("--trigger", default="10 seconds")
    t = sub.add_parser("train")
    t.add_argument("--root", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--keys", nargs="*")
    t.add_argument("--small", action="store_true")
    t.add_argument("--leaky", action="store_true")
    s = sub.add_parser("score")
    s.add_argument("--model", required=True)
    s.add_argument("--requests", required=True)
    s.add_argument("--out", required=True)
    lk = sub.add_parser("lookup")
    lk.add_argument("--root", required=True)
    lk.add_argument("--table", required=True)
    lk.add_argument("--category")
    lk.add_argument("--out")
    c = sub.add_parser("coordinate")
    c.add_argument("--root", required=True)
    c.add_argument("--model", required=True)
    c.add_argument("--state", required=True)
    c.add_argument("--min-interval", type=float, default=S.MIN_RETRAIN_SECONDS, dest="min_interval")
    c.add_argument("--lease", type=float, default=24 * 3600.0, help="seconds after which a marker left by a killed run is ignored")
    c.add_argument("--keys", nargs="*")
    c.add_argument("--small", action="store_true")
    c.add_argument("--leaky", action="store_true")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"shopmetrics-{a.cmd}").getOrCreate()
    {"publish": cmd_publish, "refresh": cmd_refresh, "ingest": cmd_ingest, "train": cmd_train,
     "score": cmd_score, "lookup": cmd_lookup, "coordinate": cmd_coordinate}[a.cmd](spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
