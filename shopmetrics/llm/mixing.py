"""Mixing of sources to target weights by weighted fair queueing (operator 4).

Each source's documents are shuffled by a hash; a document's virtual finish time is the source's cumulative
words up to it, divided by the source's target. Queued round after round, a document comes up once in each pass over its source. All
entries in order of finish time, truncated at the total budget, are the mix.

Both running sums (words within a source; words of the whole mix) are taken over ranges: a sum per range, running
totals of the few range sums, and a window within each range. So neither a source that holds a third of all rows
nor the whole mix ever meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmetrics.llm import text as X
from shopmetrics.llm.store import drop, keep

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_PASSES = 2
#: Rows of one range of a running sum, about.
RANGE_ROWS = 4000


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = X.byte_column(batch.column("text"))
        n: list[int] = []
        for lo, hi in X.chunks(offsets):
            _, _, first = X.word_bounds(buf[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            n.extend((first[1:] - first[:-1]).tolist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), pa.array(n, pa.int64())],
                                         names=["doc_id", "source", "size"])


def word_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(source_col).cast("string").alias("source")).mapInArrow(_sizes, "doc_id long, source string, size long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_PASSES) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size).

    The budget ``share`` times all words is dealt by weight; a target stops at ``most`` times its source's words, and
    what is over goes to the others by weight until none is above. With the sources in order of
    size / weight, those that stop come first: source k stops if its limit is no more than its part of what the
    earlier ones leave. Work is on one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    up = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    limit = F.col("source_size") * float(most)
    ranked = (sources.withColumn("w", w).withColumn("limit", limit)
              .withColumn("left", F.lit(share) * F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("limit").over(before), zero))
              .withColumn("w_left", F.sum("w").over(Window.partitionBy()) - F.coalesce(F.sum("w").over(before), zero))
              .withColumn("nth", F.row_number().over(up))
              .withColumn("level", F.when(F.col("left") * F.col("w") < F.col("limit") * F.col("w_left"), F.col("left") / F.col("w_left"))))
    # the first source that doesn't stop sets the level for all after it
    open_ = F.when(F.col("level").isNotNull(), F.struct(F.col("nth"), F.col("level")))
    level = F.min(open_).over(Window.partitionBy())["level"]
    return ranked.withColumn("level", level).select(
        "source", "source_size", F.when(F.col("level").isNull(), F.col("limit")).otherwise(F.least(F.col("limit"), F.col("w") * F.col("level"))).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 4) -> DataFrame:
    """Row per document: doc_id, size, source_size, target, taken, passes, finish.

    ``taken`` is the document's words times the passes in which the mix takes it (0 to 2). A document without words has size 0,
    and is taken freely or not at all: taken is 0. A null source is a source of its own, last in order. A null id shuffles like any
    other value; rows that repeat are documents of their own, ordered by hash, id and size, so reruns agree. Other columns are not read.
    """
    sized = keep(word_sizes(docs, id_col, text_col, source_col), "sizes")
    source = keep(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    rows = sized.count()
    ranges = max(1, rows // RANGE_ROWS)
    h = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(seed))
    spot = F.shiftrightunsigned(h, 1)  # 0 to 2**63 - 1, in order of the shuffle
    dealt = (sized.where("size > 0").withColumn("h", spot)
             .withColumn("range", F.floor(F.col("h") / F.lit(float(2**63)) * ranges)))
    sums = dealt.groupBy("source", "range").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(before, F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "range").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (dealt.join(keep(sums, "ranges").hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
              .withColumn("upto", F.col("before") + F.sum("size").over(inside)).select("doc_id", "source", "size", "h", "upto"))
    src = source.withColumnsRenamed({"source": "s"})
    entries = (placed.join(src, F.col("source").eqNullSafe(F.col("s"))).drop("s")
               .withColumn("passes", F.sequence(F.lit(0), F.lit(MOST_PASSES - 1)))
               .withColumn("pass", F.explode("passes"))
               .withColumn("finish", (F.col("upto") + F.col("pass") * F.col("source_size")) / F.col("target"))
               .select("doc_id", "source", "size", "h", "pass", "finish"))
    entries = keep(entries.where("finish <= 1.5"), "entries")  # later ones are past the budget: at 1 every target is met

    # the whole mix in order of finish time, truncated at the budget
    budget = F.floor(F.sum("target") + 0.5).cast("long")
    span = entries.withColumn("range", F.floor(F.col("finish") * ranges))
    sums = span.groupBy("range").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("range", F.coalesce(before, F.lit(0)).alias("before")).crossJoin(F.broadcast(source.agg(budget.alias("budget"))))
    order = Window.partitionBy("range").orderBy("finish", "source", "h", "doc_id", "pass", "size").rowsBetween(Window.unboundedPreceding, 0)
    edge = keep(sums.where("before <= budget"), "edges")
    taken = (span.join(edge.hint("merge"), "range").withColumn("total", F.col("before") + F.sum("size").over(order))
             .where("total <= budget")
             .groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("entries"), F.max("finish").alias("finish")))
    return _back(sized, source, taken)


def _back(sized: DataFrame, source: DataFrame, taken: DataFrame) -> DataFrame:
    """Each document's row; rows that repeat share what their group took, the first ones first."""
    t = taken.select(F.col("doc_id").alias("t_id"), F.col("source").alias("t_source"), F.col("size").alias("t_size"), "entries", "finish")
    n = Window.partitionBy("doc_id", "source", "size").orderBy(F.lit(1))
    same = F.row_number().over(n)
    copies = F.count("*").over(Window.partitionBy("doc_id", "source", "size"))
    src = source.withColumnsRenamed({"source": "s"})
    joined = sized.withColumn("nth", same).withColumn("copies", copies).join(
        t, F.col("doc_id").eqNullSafe(F.col("t_id")) & F.col("source").eqNullSafe(F.col("t_source")) & (F.col("size") == F.col("t_size")), "left")
    entries = F.coalesce(F.col("entries"), F.lit(0))
    passes = F.floor(entries / F.col("copies")) + (F.col("nth") <= entries % F.col("copies")).cast("long")
    return (joined.join(src, F.col("source").eqNullSafe(F.col("s")))
            .select("doc_id", "size", "source_size", "target", (passes * F.col("size")).alias("taken"), passes.alias("passes"), "finish",
                    F.col("s").alias("source")))
