"""Product ingest: raw CSV parse, row validation, JSON message encode/decode, arrival stamp.

(SRC-1..4, SNK-1, STR-2, STR-6.) Parsing runs on executors; no row goes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from . import quoted as Q

CORRUPT = "_corrupt_record"
RAW_CSV_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in S.CSV_FIELDS]
    + [T.StructField(CORRUPT, T.StringType(), True)])


def csv_reader(spark: SparkSession, stream: bool = False, header: bool = True,
               max_files_per_trigger: int | None = None, glob: str = "*.csv", multiline: bool = False):
    """All-string positional CSV reader with standard quoting (a doubled quote inside a quoted
    field). ``columnPruning`` is off so that a short row stays flagged in the corrupt-record
    column even under a narrow projection. ``multiline`` accepts line breaks inside quoted fields, as Python's csv module does; each
    file is then read by one task (see ``read_product_csv`` for how that is kept to the files that need it)."""
    r = (spark.readStream if stream else spark.read).schema(RAW_CSV_SCHEMA) \
        .option("header", header).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False) \
        .option("quote", '"').option("escape", '"') \
        .option("pathGlobFilter", glob)
    if multiline:
        r = r.option("multiLine", True)
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r


def read_product_csv(spark: SparkSession, path: str, header: bool = True, glob: str = "*.csv",
                     multiline: bool | None = None) -> DataFrame:
    """Raw product rows from every file matching ``glob`` under ``path`` (batch).

    Line breaks inside quoted fields are accepted. By default (``multiline=None``) one scan finds the
    files that hold any; those are cut into records by splits as well (``sources.quoted``). ``True``
    reads every file whole, one task each, ``False`` none (a quoted line break then gives rejected rows).
    """
    if multiline is not None:
        return csv_reader(spark, header=header, glob=glob, multiline=multiline).csv(path)
    lines = Q.lines_of(spark, path, glob)
    split = csv_reader(spark, header=header, glob=glob).csv(path)
    if Q.lines_with_open_quotes(lines).isEmpty():
        return split
    # the names of files that the driver has listed already: no larger than that list. Each file is read in one of the two ways only
    quoted = [r["file"] for r in Q.lines_with_open_quotes(lines).select("file").distinct().collect()]
    rest = split.where(~F.col("_metadata.file_path").isin(quoted))
    return rest.unionByName(Q.parsed(Q.lines_of(spark, path, glob, quoted), RAW_CSV_SCHEMA, CORRUPT, header))


def field_count(line: Column) -> Column:
    """Number of CSV fields in a raw line, commas inside quotes not counted."""
    return F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), ",", -1))


# What Python's int() and float() take: Spark's cast also accepts a type letter (``1.5d``).
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_TEXT = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"


def number(text: Column, pattern: str, kind: str) -> Column:
    return F.when(text.rlike(pattern), text).try_cast(kind)


def parse_products(raw: DataFrame) -> DataFrame:
    """Typed product columns from all-string positional fields, plus ``_fields`` (field count).

    Numbers use ``try_cast`` (NULL when they do not parse); text fields that are present but
    empty become ``''``; StockStatus is true only for the exact text ``TRUE``.
    """
    c = F.col
    nfields = F.when(c(CORRUPT).isNull(), F.lit(len(S.CSV_FIELDS))).otherwise(field_count(c(CORRUPT)))
    out = []
    for i, name in enumerate(S.CSV_FIELDS):
        if name in S.CSV_INT_FIELDS:
            out.append(number(c(name), INT_TEXT, "int").alias(name))
        elif name in S.CSV_FLOAT_FIELDS:
            out.append(number(c(name), FLOAT_TEXT, "double").alias(name))
        elif name in S.CSV_TEXT_FIELDS:
            out.append(F.when(nfields > i, F.coalesce(c(name), F.lit(""))).alias(name))
        else:  # StockStatus
            out.append(F.coalesce(c(name) == F.lit("TRUE"), F.lit(False)).alias(name))
    return raw.select(*out, nfields.alias("_fields"))


def csv_rules() -> list[tuple[str, Column]]:
    """Validity rules of a parsed CSV row, in the order the reference fails on them."""
    nums = ["ProductID", "Price", "Rating", "NumReviews", "StockQuantity", "Sales", "Discount"]
    return [(n, F.col(n).isNotNull()) for n in nums] + [
        ("field_count", F.col("_fields") >= S.CSV_MIN_FIELDS)]


def with_reject_reason(df: DataFrame, rules: Sequence[tuple[str, Column]], col: str = "RejectReason") -> DataFrame:
    """Name of the first failing rule (a NULL predicate fails), NULL when the row is valid."""
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules])
    return df.withColumn(col, reason)


def split_valid_rejected(df: DataFrame, rules: Sequence[tuple[str, Column]],
                         col: str = "RejectReason", observe=None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the reason). Both are lazy filters of one tagged plan.

    ``observe`` (a ``pyspark.sql.Observation`` or, for streams, a metric name) collects
    ``rows`` and ``rejected`` counts as a side effect of whichever action runs the plan."""
    tagged = with_reject_reason(df, rules, col)
    if observe is not None:
        tagged = tagged.observe(observe, F.count(F.lit(1)).alias("rows"),
                                F.count(F.col(col)).alias("rejected"))
    return tagged.where(F.col(col).isNull()).drop(col), tagged.where(F.col(col).isNotNull())


def products_from_csv(raw: DataFrame, observe=None) -> tuple[DataFrame, DataFrame]:
    """Raw CSV rows -> (valid product records in bronze field order, rejected rows)."""
    valid, rejected = split_valid_rejected(parse_products(raw), csv_rules(), observe=observe)
    return valid.drop("_fields"), rejected.drop("_fields")


def message(columns: Sequence[str]) -> Column:
    """One JSON object of these columns."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]))


def encode_messages(df: DataFrame) -> DataFrame:
    """One JSON object per row, in a ``value`` column (Kafka value or a text-file line)."""
    return df.select(message(df.columns).alias("value"))


def publish_messages(df: DataFrame, path: str | None = None, kafka: dict | None = None) -> None:
    """Publish each row as one JSON message: to a Kafka topic (needs the Kafka connector) or as
    JSON-lines files under ``path`` (appended, one file per task)."""
    values = encode_messages(df)
    if kafka:
        (values.write.format("kafka").option("kafka.bootstrap.servers", kafka["bootstrap"])
               .option("topic", kafka["topic"]).save())
    else:
        values.write.mode("append").text(path)


def tag_messages(df: DataFrame, schema: T.StructType = S.BRONZE_SCHEMA) -> DataFrame:
    """The fixed schema applied to JSON message values, with ``value`` and ``RejectReason``: ``message`` where
    the value is no JSON object or a field is not of its type, else NULL."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    value = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # by a generator: filters pushed below a plain projection would parse each message again, once for each field they look at
    parsed = df.select(value.alias("value"), F.explode(F.array(F.from_json(value, full, options))).alias("m"))
    bad = F.col("m").isNull() | F.col(f"m.{CORRUPT}").isNotNull() | (F.trim("value") == "")
    return parsed.select(*[F.col(f"m.{f.name}").alias(f.name) for f in schema.fields], "value",
                         F.when(F.coalesce(bad, F.lit(True)), F.lit("message")).alias("RejectReason"))


def split_messages(df: DataFrame, schema: T.StructType = S.BRONZE_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(valid records in schema order, rejected message values with the reason)."""
    tagged = tag_messages(df, schema)
    return (tagged.where(F.col("RejectReason").isNull()).select(*schema.names),
            tagged.where(F.col("RejectReason").isNotNull()).select("value", "RejectReason"))


def decode_messages(df: DataFrame, schema: T.StructType = S.BRONZE_SCHEMA) -> DataFrame:
    """The valid records of JSON message values; columns in schema order."""
    return split_messages(df, schema)[0]


def stamp_arrival(df: DataFrame, ts: str | None = None, keep_existing: bool = False,
                  col: str = "ProcessedTimestamp") -> DataFrame:
    """Arrival stamp as ISO-8601 text: a literal ``ts`` (tests), else the micro-batch time.
    ``keep_existing`` keeps a stamp the message already carries (replays)."""
    now = F.lit(ts) if ts is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    stamp = F.coalesce(F.col(col), now) if keep_existing and col in df.columns else now
    return df.withColumn(col, stamp)
