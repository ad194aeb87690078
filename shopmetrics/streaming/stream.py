"""Structured Streaming ingest: CSV files or JSON messages -> bronze (append) -> silver/gold refresh.

(SRC-2, SRC-3, STR-1..5, STR-7, SNK-2.) The checkpoint replaces the reference's file watcher and
consumer offsets; a micro-batch replaces the count-based 100-message buffer; ``availableNow``
drains everything and stops, which also flushes the last partial batch.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import Thread

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..sources import ingest as IN
from ..sources import tables as TB
from ..plans.incremental import exists, refresh_now, state_partitions_for
from ..plans.refresh import BATCH_COLUMN, STREAM_COLUMN, LakePaths, refresh_tables, stream_id


def read_csv_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                    header: bool = True, glob: str = "*.csv", multiline: bool = True,
                    keep_rejected: bool = False) -> DataFrame:
    """Valid product records from every existing and every new ``*.csv`` file in ``path``.

    ``multiline`` accepts line breaks in quoted fields (a file is then read by one task; turn it off for a
    stream of large files without such fields). With ``keep_rejected``, rejected rows stay, with ``RejectReason``: the bronze
    stream writes them to the lake's rejected table.
    """
    raw = IN.csv_reader(spark, stream=True, header=header, max_files_per_trigger=max_files_per_trigger,
                        glob=glob, multiline=multiline).csv(path)
    if keep_rejected:
        return IN.with_reject_reason(IN.parse_products(raw), IN.csv_rules()).drop("_fields")
    return IN.products_from_csv(raw)[0]


def read_message_stream(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
                        max_per_trigger: int | None = None, keep_rejected: bool = False) -> DataFrame:
    """Decoded product messages; with ``keep_rejected`` also those that are no valid message, with
    their ``value`` and ``RejectReason``. ``kafka`` (bootstrap servers, topic) needs the Kafka connector on
    the classpath; otherwise ``path`` is a folder of JSON-lines files, one message per line."""
    if kafka:
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", kafka["bootstrap"]).option("subscribe", kafka["topic"])
             .option("startingOffsets", "earliest"))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        values = r.load().select(F.col("value").cast("string").alias("value"))
    else:
        r = spark.readStream.format("text")
        if max_per_trigger:
            r = r.option("maxFilesPerTrigger", max_per_trigger)
        values = r.load(path)
    return IN.tag_messages(values) if keep_rejected else IN.decode_messages(values)


def append_batch(batch: DataFrame, batch_id: int, path: str, stream: str = "batch") -> None:
    """Idempotent append: each micro-batch owns the partition of its stream and batch id, written with
    dynamic partition overwrite, so a replayed batch (after a failure) replaces itself, and never
    what another stream or another checkpoint has written. A ``rebalance`` first lets AQE size
    the batch's files (no file per input task), by the hash of the product where there is one: the records of a product then stand in
    the same file, and who looks for its latest has one row of it to shuffle for each file. By a hash, as AQE may then split what a
    hot product fills."""
    met = batch.withColumn("_near", F.xxhash64("ProductID")).hint("rebalance", "_near").drop("_near") if "ProductID" in batch.columns \
        else batch.hint("rebalance")
    (met.withColumns({STREAM_COLUMN: F.lit(stream), BATCH_COLUMN: F.lit(batch_id)})
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(STREAM_COLUMN, BATCH_COLUMN).parquet(path))


def observed(seen: Observation, name: str, seconds: float = 60) -> int | None:
    """A metric of a job that has ended; None where Spark hasn't told it in this time (its listeners may lose events)."""
    told: list[dict] = []
    asked = Thread(target=lambda: told.append(seen.get), daemon=True)
    asked.start()
    asked.join(seconds)
    return told[0].get(name) if told else None


def refresh_batch(batch: DataFrame, batch_id: int, paths: LakePaths, refresh: str | None = "full",
                  stream: str = "batch", session: SparkSession | None = None) -> None:
    """The ``foreachBatch`` body: append to bronze, then rebuild silver and gold.

    ``refresh="full"`` recomputes from the whole bronze history (the reference's behaviour);
    ``"incremental"`` runs the lake's refresh query over what bronze has gained (see ``plans.incremental``): for one stream
    at a time; where several append at once, give them ``None``, which only appends, and start one refresh query. Rows with a
    ``RejectReason`` go to the rejected table. A batch without a valid row changes no other table. The job that stores the valid
    rows counts the rejected ones: a batch without any isn't read and parsed again for them.
    """
    if refresh not in ("full", "incremental", None):
        raise ValueError(f"unknown refresh mode: {refresh}")
    spark = batch.sparkSession
    here = f"{paths.bronze}/{STREAM_COLUMN}={stream}/{BATCH_COLUMN}={batch_id}"
    if "RejectReason" in batch.columns:
        bad, seen = F.col("RejectReason").isNotNull(), Observation()
        counted = batch.observe(seen, F.count_if(bad).alias("rejected"))
        append_batch(counted.where(~bad).select(*S.BRONZE_COLUMNS), batch_id, paths.bronze, stream)
        # where nothing was stored, adaptive execution may have dropped the job's plan and the count with it
        if not exists(spark, here) or observed(seen, "rejected") != 0:
            append_batch(batch.where(bad), batch_id, paths.rejected, stream)
    else:
        append_batch(batch.select(*S.BRONZE_COLUMNS), batch_id, paths.bronze, stream)
    if refresh is None or not exists(spark, here):
        return
    if refresh == "full":
        refresh_tables(spark, paths)
    else:
        # in the user's session: a stream's own keeps that stream's number of state partitions for queries that start in it
        refresh_now(session or spark, paths, state_partitions=state_partitions_for(spark, paths))


def start_bronze_stream(records: DataFrame, paths: LakePaths, checkpoint: str, refresh: str | bool | None = None,
                        available_now: bool = True, processing_time: str | None = None,
                        stamp: str | None = None, keep_existing_stamp: bool = False,
                        on_batch: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Stamp arrivals, append each micro-batch to bronze, then (optionally) rebuild silver and gold
    (``refresh``: None, ``"full"`` or ``"incremental"``; ``True`` means ``"full"``). Any number of streams, each
    with its own checkpoint, may write to one lake."""
    stamped = IN.stamp_arrival(records, ts=stamp, keep_existing=keep_existing_stamp)
    mode = "full" if refresh is True else (None if refresh is False else refresh)

    def handle(batch: DataFrame, batch_id: int) -> None:
        refresh_batch(batch, batch_id, paths, mode, stream_id(batch.sparkSession, checkpoint), records.sparkSession)
        if on_batch is not None:
            on_batch(batch, batch_id)

    w = stamped.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def rows_stored(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """(stream, batches, rows) over everything that streams have appended: a running total that doesn't end with
    the progress reports that a query retains. Partition values and row counts come from file footers."""
    stored = spark.read.schema(S.BRONZE_SCHEMA).parquet(paths.bronze)
    return stored.groupBy(F.col(STREAM_COLUMN).alias("stream")).agg(
        F.countDistinct(BATCH_COLUMN).alias("batches"), F.count(F.lit(1)).alias("rows"))


def rows_processed(query: StreamingQuery) -> int:
    """Input rows over the progress reports that Spark retains (the last 100 by default; see ``rows_stored``)."""
    return sum(int(p.get("numInputRows", 0)) for p in query.recentProgress)


def stream_dirs(spark: SparkSession, name: str) -> tuple[str, LakePaths, str]:
    """(input folder, lake paths, checkpoint) for one run, under the shared checkpoint folder."""
    root = TB.shared_dir(spark, "stream", name, unique=True)
    return f"{root}/input", LakePaths.under(f"{root}/lake"), f"{root}/checkpoint"
