"""Incremental refresh: the products that a batch changed, the silver folders that hold them, and gold from partial aggregates.

One streaming query per lake reads the bronze table, to which any number of streams append. Spark's state store keeps the latest
record of each product (``groupBy(ProductID).agg(max(struct))`` in update mode), so a micro-batch holds the products that have
new records and nothing else. Per micro-batch (STR-3, SNK-3, SLV-15, GLD-2..18):

1. the changed products are cleaned and stored once, so the micro-batch is evaluated once;
2. the ``Year``/``Month`` folders that hold them now or will hold them are rewritten, with their other rows, in a staging folder;
3. the staged folders replace those of silver by dynamic partition overwrite; a folder that has lost its last row goes;
4. the partial aggregates of the same folders are computed from the staged rows and replaced in the same way;
5. the six gold tables and the scaling divisors are merged from the partial aggregates.

There is no log: after a failure Spark runs the micro-batch again with the same products. If its staging folder was complete, steps 3
to 5 are repeated from it (so a folder that was half replaced is whole again), else it is made anew. Every step gives the same
result when repeated. The staging folder has the stream's own id in its name: a new checkpoint never finds another's.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache, partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructType

from .. import schema as S
from ..operators import partials as P
from ..operators import silver as SV
from ..sources import tables as TB
from .refresh import BATCH_COLUMN, STREAM_COLUMN, LakePaths, stream_id

PARTITION = list(P.PARTITION)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


@cache
def _schemas(keys: tuple[str, ...]) -> dict[str, StructType]:
    """The schemas of the stored tables, as their operators make them: worked out once, not in every micro-batch."""
    silver = SV.clean_products(SparkSession.active().createDataFrame([], S.BRONZE_SCHEMA))
    return {"silver": silver.schema, "by_key": P.partials(silver, keys).schema, "by_price": P.price_partials(silver, keys).schema}


def silver_schema() -> StructType:
    return _schemas(P.KEYS)["silver"]


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Stored silver (without vectors, which ``scaled_silver`` adds); empty where there is none yet."""
    schema = silver_schema()
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def scaled_silver(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Stored silver with its two vectors, by the stored divisors."""
    return P.scale_by(read_silver(spark, paths.silver), spark.read.parquet(paths.scaling))


def changed_products(spark: SparkSession, paths: LakePaths, order: Sequence[str] | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of bronze's latest record per product; in update mode a micro-batch has the products with new records.

    A bronze batch that is replayed replaces its files: the old ones may be gone before they are read, and the new ones hold the same
    records, so missing files are passed over. A record that is read twice changes no maximum."""
    schema = StructType(list(S.BRONZE_SCHEMA.fields)).add(STREAM_COLUMN, StringType()).add(BATCH_COLUMN, LongType())
    r = spark.readStream.schema(schema).option("ignoreMissingFiles", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return SV.latest_per_product(r.parquet(paths.bronze).select(*S.BRONZE_COLUMNS), order=order)


def in_folders(folders: Sequence[tuple[int | None, int | None]]) -> Column:
    """A predicate on the partition columns alone: only these folders are listed and read."""
    code = F.coalesce(F.col("Year"), F.lit(0)) * 100 + F.coalesce(F.col("Month"), F.lit(0))
    return code.isin([(y or 0) * 100 + (m or 0) for y, m in folders])


def _folders(df: DataFrame) -> list[tuple[int | None, int | None]]:
    """The distinct (Year, Month): as many as months, whatever the rows."""
    return sorted({(r["Year"], r["Month"]) for r in df.select(*PARTITION).distinct().collect()}, key=str)


def touched_folders(silver: DataFrame, changed: DataFrame) -> list[tuple[int | None, int | None]]:
    """Where the changed products are in ``silver`` and where their new rows belong. Of silver, ids are read only."""
    ids = changed.select(F.col("ProductID").alias("_id"))
    now = silver.select("ProductID", *PARTITION).join(ids, F.col("ProductID").eqNullSafe(F.col("_id")), "left_semi")
    return _folders(now.select(*PARTITION).unionByName(changed.select(*PARTITION)))


def rewritten(silver: DataFrame, changed: DataFrame, folders: Sequence[tuple[int | None, int | None]]) -> DataFrame:
    """The rows of the touched folders after the change: theirs without the changed products, and these."""
    ids = changed.select(F.col("ProductID").alias("_id"))
    rest = silver.where(in_folders(folders)).join(ids, F.col("ProductID").eqNullSafe(F.col("_id")), "left_anti")
    return rest.unionByName(changed.select(*silver.columns))


def folder_path(root: str, folder: tuple[int | None, int | None]) -> str:
    null = "__HIVE_DEFAULT_PARTITION__"
    year, month = (null if v is None else v for v in folder)
    return f"{root}/Year={year}/Month={month}"


def together(*steps: Callable[[], object]) -> None:
    """Run independent jobs side by side: most micro-batches are small, and then it is the jobs' number that takes the time."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(inheritable_thread_target(SparkSession.active())(step)) for step in steps]:
            done.result()


def replace_folders(df: DataFrame, path: str, emptied: Sequence[tuple[int | None, int | None]]) -> None:
    """Replace the folders that ``df`` has rows of, and remove those that have no rows any more."""
    TB.write_table(df, path, partition_by=PARTITION, dynamic_overwrite=True)
    for folder in emptied:
        TB.remove(df.sparkSession, folder_path(path, folder))


def _stage(spark: SparkSession, stage: str, changed: DataFrame, paths: LakePaths) -> None:
    """Everything that the later steps need, under one folder; ``folders``, written last, marks it complete."""
    TB.write_table(SV.clean_products(changed), f"{stage}/changed")
    new = spark.read.schema(silver_schema()).parquet(f"{stage}/changed")
    silver = read_silver(spark, paths.silver)
    folders = touched_folders(silver, new)
    TB.write_table(rewritten(silver, new, folders), f"{stage}/silver", partition_by=PARTITION)
    TB.write_table(spark.createDataFrame(folders, "Year int, Month int").coalesce(1), f"{stage}/folders")


def refresh_changed(spark: SparkSession, paths: LakePaths, changed: DataFrame, stage: str, keys: Sequence[str] = P.KEYS,
                    formats: Sequence[str] = ("parquet",)) -> list[tuple[int | None, int | None]]:
    """Bring silver, the partial aggregates, gold and the divisors up to date with the latest raw records of the changed products.
    Returns the touched folders. May be repeated at any time, also after a failure in it."""
    if exists(spark, f"{stage}/folders/_SUCCESS"):
        changed.write.format("noop").mode("overwrite").save()  # the state store keeps a micro-batch only when its plan has run
    else:
        _stage(spark, stage, changed, paths)
    folders = [(r["Year"], r["Month"]) for r in spark.read.parquet(f"{stage}/folders").collect()]
    if folders:
        staged = read_silver(spark, f"{stage}/silver")
        emptied = sorted(set(folders) - set(_folders(staged)), key=str)
        together(lambda: replace_folders(staged, paths.silver, emptied),
                 lambda: replace_folders(P.partials(staged, keys), f"{paths.partials}/by_key", emptied),
                 lambda: replace_folders(P.price_partials(staged, keys), f"{paths.partials}/by_price", emptied))
        publish(spark, paths, keys, formats)
    TB.remove(spark, stage)
    return folders


def read_partials(spark: SparkSession, paths: LakePaths, keys: Sequence[str] = P.KEYS) -> tuple[DataFrame, DataFrame]:
    """Both stored partial tables, with fixed schemas (no inference over their files)."""
    return tuple(spark.read.schema(_schemas(tuple(keys))[name]).parquet(f"{paths.partials}/{name}") for name in ("by_key", "by_price"))


def publish(spark: SparkSession, paths: LakePaths, keys: Sequence[str] = P.KEYS, formats: Sequence[str] = ("parquet",)) -> None:
    """Gold and the scaling divisors from the stored partial aggregates; silver is not read."""
    stored, by_price = read_partials(spark, paths, keys)
    gold = P.gold_from_partials(stored, by_price, keys)
    together(lambda: TB.replace_table(P.scaling_from_partials(stored), paths.scaling),
             *(partial(TB.write_gold, {name: df}, paths.gold, formats=tuple(formats), replace=True) for name, df in gold.items()))


def start_refresh_stream(spark: SparkSession, paths: LakePaths, checkpoint: str | None = None, keys: Sequence[str] = P.KEYS,
                         order: Sequence[str] | None = None, formats: Sequence[str] = ("parquet",), available_now: bool = True,
                         processing_time: str | None = None, max_files_per_trigger: int | None = None,
                         state_partitions: int | None = None, on_batch=None) -> StreamingQuery:
    """Keep silver and gold up to date with bronze: one such query per lake, whatever number of streams append to its bronze.

    ``on_batch(batch_id, folders)`` is called after each micro-batch with the folders it touched.
    ``state_partitions`` is the number of partitions of the state store (default: the session's shuffle partitions). It is fixed with
    the checkpoint: give as many as the state will need (one record per product; about 200 MB each), as adaptive execution doesn't
    change it."""
    checkpoint = checkpoint or f"{paths.state}/checkpoint"

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stage = f"{paths.state}/staged/{stream_id(session, checkpoint)}-{batch_id}"
        folders = refresh_changed(session, paths, batch, stage, keys, formats)
        if on_batch is not None:
            on_batch(batch_id, folders)

    w = changed_products(spark, paths, order, max_files_per_trigger).writeStream.outputMode("update") \
        .foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    settings = {"spark.sql.files.maxPartitionBytes": SCAN_BYTES, "spark.sql.shuffle.partitions": state_partitions}
    settings = {name: value for name, value in settings.items() if value is not None}
    session_has = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)  # a query takes its settings when it starts
    try:
        return w.start()
    finally:
        for name, value in session_has.items():
            spark.conf.set(name, value)


#: Bytes of bronze files that a task of the refresh reads: it sorts their rows, which are many times as large in memory.
SCAN_BYTES = 16 << 20
#: Bytes of bronze files, as stored when a lake's first refresh starts, for each partition of its state.
STATE_PARTITION_BYTES = 16 << 20


def state_partitions_for(spark: SparkSession, paths: LakePaths, least: int = 8) -> int:
    """Partitions of the state store that grow with what bronze holds, so that one task's share of rows and state does not."""
    fs, p = _path(spark, paths.bronze)
    return max(least, -(-fs.getContentSummary(p).getLength() // STATE_PARTITION_BYTES)) if fs.exists(p) else least


def refresh_now(spark: SparkSession, paths: LakePaths, **options) -> list[list[tuple[int | None, int | None]]]:
    """Run the refresh query until it has seen all of bronze; the folders touched by each of its micro-batches."""
    touched: list[list[tuple[int | None, int | None]]] = []
    if exists(spark, paths.bronze):
        q = start_refresh_stream(spark, paths, on_batch=lambda _, folders: touched.append(folders), **options)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return touched
