"""CSV records with line breaks inside quoted fields, read in splits (SRC-1).

Whether a line begins a record or goes on inside a quoted field depends on all of the file before it. Each line is therefore taken as
a function of two states, outside and inside a quoted field: the state after it, for either state before it. Such functions
compose, so each split of a file composes its own lines for both states at once, a prefix over the splits (one row each) tells every
split the state that it begins in, and all splits cut their records side by side. A task goes through the lines of its splits in the order
that it reads them in, an Arrow batch at a time: they are neither shuffled nor sorted nor stored, however large a split is. Only the lines of a
record that runs over the end of a split are put together by its number in the file. No file is read by one task.

A quote opens a field at its start only, a doubled quote is a quote, and what follows a closing quote belongs to the field up to the
next comma, as for Spark's own reader: a lone quote such as in ``TV 55",x`` opens nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need numpy and pyarrow, but not this package

_INSIDE = r'[^"]*+(?:""[^"]*+)*+'  # of a quoted field, to its closing quote or the line's end
_FIELDS = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?+,)*+'  # whole fields
#: The line ends inside a quoted field: from outside, and from inside one.
OPENS = rf'^{_FIELDS}"{_INSIDE}$'
STAYS = rf'^{_INSIDE}(?:"[^,]*+,{_FIELDS}"{_INSIDE})?+$'


def ends_inside(value: Column, inside: bool) -> Column:
    """Whether a line that begins inside or outside a quoted field ends inside one; a line without a quote ends as it begins."""
    return F.when(F.contains(value, F.lit('"')), value.rlike(STAYS if inside else OPENS)).otherwise(F.lit(inside))


def lines_of(spark: SparkSession, path: str | Sequence[str], glob: str, files: Sequence[str] | None = None) -> DataFrame:
    """(value, file, block, at): the lines of all files, or of ``files`` alone; ``block`` is the split's first byte, ``at`` grows along a split."""
    text = spark.read.option("pathGlobFilter", glob).text(path)
    if files is not None:
        text = text.where(F.col("_metadata.file_path").isin(list(files)))
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("at"))


def lines_with_open_quotes(lines: DataFrame) -> DataFrame:
    """Lines that end inside a quoted field if they begin outside one: files without any have no line break in quotes."""
    return lines.where(ends_inside(F.col("value"), False))


def _states(df: DataFrame, of: Sequence[str], by: str, after: tuple[Column, Column]) -> DataFrame:
    """Adds ``from_0`` and ``from_1``: the state before each row of a run (``of``, in the order of ``by``) that begins in state 0 or 1,
    where ``after`` is a row's state after it, from 0 and from 1.

    A row either keeps the state, swaps it or sets it: the state is what the last setting row set, swapped by the rows since."""
    run = Window.partitionBy(*of).orderBy(by)
    sets, swap = after[0] == after[1], F.when((after[0] == 1) & (after[1] == 0), 1).otherwise(0)
    df = df.withColumn("_swaps", F.sum(swap).over(run.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(sets, F.struct(after[0].alias("to"), F.col("_swaps").alias("swaps"))), ignorenulls=True)
    df = df.withColumn("_set", last.over(run.rowsBetween(Window.unboundedPreceding, -1)))
    swaps = F.col("_swaps") - swap
    for k in (0, 1):
        state = F.when(F.col("_set").isNotNull(), F.col("_set.to") + swaps - F.col("_set.swaps")).otherwise(swaps + k)
        df = df.withColumn(f"from_{k}", (state % 2).cast("int"))
    return df.drop("_swaps", "_set")


def _pinned(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions whenever they are looked at: the splits are planned once."""
    spark = df.sparkSession
    rows = df._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, df._jdf.schema(), False), spark)


def _runs(batch) -> Iterator[tuple]:
    """(file, block), first row, end: the rows of each split in a batch; a split's rows lie together."""
    import numpy as np
    file, block = batch["file"].dictionary_encode().indices.to_numpy(), batch["block"].to_numpy()
    cuts = (np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1).tolist()
    for lo, hi in zip([0, *cuts], [*cuts, len(block)]):
        if hi > lo:
            yield (batch["file"][lo].as_py(), int(block[lo])), lo, hi


def _through(outside, inside, start: int):
    """The states before each line and after the last one, if the first begins in ``start``; a line's state after it is in ``outside``
    or ``inside``, by the state before it.

    A line either keeps the state, swaps it or sets it: the state is what the last setting line set, swapped by the lines since."""
    import numpy as np
    last = np.maximum.accumulate(np.where(outside == inside, np.arange(len(outside)), -1))
    swaps = np.cumsum(outside > inside)
    after = np.where(last >= 0, outside[last] + swaps - swaps[last], start + swaps) % 2
    return np.concatenate(([start], after))


def _after(batch, lo: int, hi: int) -> list:
    return [batch[f"after_{k}"].to_numpy(zero_copy_only=False)[lo:hi].astype("int64") for k in (0, 1)]


_ENDS = "file string, block long, " + ", ".join(f"to_{k} int, all_{k} long, first_{k} long, last_{k} long" for k in (0, 1))


def _ends(batches) -> Iterator:
    """Of each split, for either state before it: the state after it, the records begun in it, and where the first and the last begin."""
    import numpy as np
    import pyarrow as pa

    names = [c.split()[0] for c in _ENDS.split(", ")]
    types = [pa.string(), pa.int64(), *[pa.int32(), pa.int64(), pa.int64(), pa.int64()] * 2]

    def row(key, found):
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([*key, *found[0], *found[1]], types)], names=names)

    key, found = None, []
    for batch in batches:
        at = batch["at"].to_numpy()
        for split, lo, hi in _runs(batch):
            if split != key:
                if key:
                    yield row(key, found)
                key, found = split, [[k, 0, None, None] for k in (0, 1)]
            after = _after(batch, lo, hi)
            for x in found:
                states = _through(*after, x[0])
                begins = np.flatnonzero(states[:-1] == 0)
                x[0], x[1] = int(states[-1]), x[1] + len(begins)
                if len(begins):
                    x[2], x[3] = int(at[lo + begins[0]]) if x[2] is None else x[2], int(at[lo + begins[-1]])
    if key:
        yield row(key, found)


def _cut(batches) -> Iterator:
    """The records of each split's lines, which begin and end outside quoted fields, numbered on from ``before``."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    key, state, begun, held = None, 0, 0, []  # held: the lines so far of a record that goes on in the next batch
    for batch in batches:
        for split, lo, hi in _runs(batch):
            if split != key:
                key, state, begun, held = split, 0, batch["before"][lo].as_py(), []
            states = _through(*_after(batch, lo, hi), state)
            begins, state = np.flatnonzero(states[:-1] == 0), int(states[-1])
            value = batch["value"].slice(lo, hi - lo)
            done = len(value) if not state else int(begins[-1]) if len(begins) else 0  # the lines before it are of whole records
            if done:
                lines = pa.concat_arrays([*held, value.slice(0, done)])
                more = sum(map(len, held))
                starts = np.concatenate(([0] if more else [], begins[begins < done] + more, [len(lines)])).astype("int32")
                found = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts), lines), "\n")
                number = pa.array(np.arange(begun + 1, begun + 1 + len(found)), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.repeat(batch["file"][lo], len(found)), number, found], names=["file", "record", "value"])
                begun, held = begun + len(found), []
            if state:
                held.append(value.slice(done))


def records(lines: DataFrame) -> DataFrame:
    """(file, record, value): the records of the files, numbered from 1 in each; line breaks inside a record are ``\\n``.

    The lines are read once for the splits' ends and again for the records; what is kept in between, by a reliable checkpoint, is a row for
    each split. A quote that is never closed makes the rest of its file one record, as for any reader that takes line breaks in quotes."""
    line = _pinned(lines.select("file", "block", "at", "value"))
    after = [ends_inside(F.col("value"), bool(k)).alias(f"after_{k}") for k in (0, 1)]
    splits = _states(line.select("file", "block", "at", *after).mapInArrow(_ends, _ENDS), ["file"], "block", (F.col("to_0"), F.col("to_1")))

    def own(name: str) -> Column:
        return F.when(F.col("from_0") == 0, F.col(f"{name}_0")).otherwise(F.col(f"{name}_1"))

    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = checkpointed(splits.select(
        "file", "block", own("first").alias("_first"), F.when(own("to") == 1, own("last")).alias("_open"),
        F.coalesce(F.sum(own("all")).over(before), F.lit(0)).alias("before"), own("all").alias("_all")))

    known = line.join(F.broadcast(splits), ["file", "block"])  # one row per split
    since = F.coalesce(F.col("at") >= F.col("_first"), F.lit(False))  # else of a record that an earlier split has begun
    whole = since & F.coalesce(F.col("at") < F.col("_open"), F.lit(True))
    cut = known.where(whole).select("file", "block", "before", "value", *after).mapInArrow(_cut, "file string, record long, value string")
    number = F.col("before") + F.when(since, F.col("_all")).otherwise(0)
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    long = (known.where(~whole).groupBy("file", number.alias("record"))
            .agg(F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("value")))
    return cut.unionByName(long)


def parsed(lines: DataFrame, schema: StructType, corrupt: str, header: bool) -> DataFrame:
    """The records' fields by ``schema`` (with the corrupt-record column); blank lines are no records, the first of a file is its header."""
    rows = records(lines)
    rows = (rows.where("record > 1") if header else rows).where(F.trim("value") != "")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "quote": '"', "escape": '"'}
    # by a generator: a field of ``from_csv`` in a filter or a projection above would be a parser of its own, run for every line
    return rows.select(F.inline(F.array(F.from_csv("value", ddl, options))))
