"""Exact quantiles without a buffer that grows with the rows (FEA-5, FEA-7 at product grain).

A mergeable sketch (Spark's KLL aggregate) brackets each quantile; counting passes then know exactly how many values lie below and inside
the bracket, and sketch again what lies inside. A bracket holds a few per cent of the one before it, so three or four passes leave some
thousand values at any number of rows, and those few are sorted. Each pass is one aggregate with map-side partial results, for all
columns and quantiles at once; the driver sees its one row of counts and bracket ends. Where one value holds much of the column, the
pass that counts what is below and up to it settles the quantile, however many rows have it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values of a bracket that are sorted in the end.
FEW = 2000
#: The sketch's size, and its error in rank (3 times what one pass in a hundred exceeds; a bracket that misses is taken wider).
SKETCH_K, ERROR = 800, 0.012
#: More passes than any table should need: a bracket shrinks to a fortieth.
PASSES = 30


@dataclass
class _Bracket:
    """The values from ``low`` to ``high`` of a column, among which the ranks of one quantile are looked for."""

    column: str
    share: float
    low: float = -math.inf
    high: float = math.inf
    guess: float | None = None
    error: float = ERROR
    below: int = 0
    inside: int = 0
    before: tuple[float, float] = (-math.inf, math.inf)
    value: float | None = None
    done: bool = False

    def ranks(self, n: int) -> tuple[int, int, float]:
        at = self.share * (n - 1)
        return math.floor(at), math.ceil(at), at

    def within(self, x: Column) -> Column:
        return (x >= F.lit(self.low)) & (x <= F.lit(self.high))


def sketches(df: DataFrame, columns: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One sketch per column, or per column and group: a table that later rows can be merged into (``merged``)."""
    return df.groupBy(*by).agg(*(F.kll_sketch_agg_double(x.cast("double"), SKETCH_K).alias(name) for name, x in columns.items()))


def merged(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of sketches from many (of batches, of partitions)."""
    return stored.agg(*(F.kll_merge_agg_double(F.col(name)).alias(name) for name in columns))


def _count(df: DataFrame, brackets: list[_Bracket], x: Mapping[str, Column]) -> list[dict]:
    """Per bracket: n of the column, below, inside, under and up_to the guess, and from the sketch of what is inside the next ends."""
    aggs = [F.count(x[c]).alias(f"n_{c}") for c in x]
    for i, b in enumerate(brackets):
        v, inside = x[b.column], b.within(x[b.column])
        aggs += [F.count_if(v < F.lit(b.low)).alias(f"below_{i}"), F.count_if(inside).alias(f"inside_{i}"),
                 F.kll_sketch_agg_double(F.when(inside, v), SKETCH_K).alias(f"sketch_{i}")]
        if b.guess is not None:
            aggs += [F.count_if(v < F.lit(b.guess)).alias(f"under_{i}"), F.count_if(v <= F.lit(b.guess)).alias(f"up_to_{i}")]
    row = df.agg(*aggs).first().asDict()
    out, ends = [], []
    for i, b in enumerate(brackets):
        out.append({"n": row[f"n_{b.column}"], **{k: row[f"{k}_{i}"] for k in ("below", "inside", "under", "up_to") if f"{k}_{i}" in row}})
        if row[f"inside_{i}"]:
            rank = (b.share * (row[f"n_{b.column}"] - 1) - row[f"below_{i}"]) / row[f"inside_{i}"]
            error = max(b.error, 3 / row[f"inside_{i}"])
            sketch = F.lit(bytes(row[f"sketch_{i}"]))  # some ten thousand bytes, by its size parameter
            ends += [F.kll_sketch_get_quantile_double(sketch, F.lit(min(max(r, 0.0), 1.0))).alias(f"{name}_{i}")
                     for name, r in (("low", rank - error), ("high", rank + error), ("guess", rank))]
    if ends:
        for k, v in df.sparkSession.range(1).select(*ends).first().asDict().items():
            name, i = k.rsplit("_", 1)
            out[int(i)][name] = v
    return out


def exact_quantiles(df: DataFrame, columns: Mapping[str, Column], shares: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """{column: its values at the given shares}, interpolated as ``percentile`` does. NULL and NaN don't count; None without a value."""
    x = {c: F.when(~F.isnan(e.cast("double")), e.cast("double")) for c, e in columns.items()}
    brackets = [_Bracket(c, p) for c in columns for p in shares[c]]
    open_, n = list(brackets), {}
    for _ in range(PASSES):
        if not open_:
            break
        for b, r in zip(open_, _count(df, open_, x)):
            n[b.column] = r["n"]
            if not r["n"]:
                b.done = True
                continue
            lo, hi, _ = b.ranks(r["n"])
            if b.guess is not None and r["under"] <= lo and hi < r["up_to"]:
                b.value, b.done = b.guess, True
            elif lo < r["below"] or hi >= r["below"] + r["inside"]:  # the sketch missed: the bracket before it, with more room
                (b.low, b.high), b.guess, b.error = b.before, None, 4 * b.error
            elif r["inside"] <= FEW:
                b.below, b.inside, b.done = r["below"], r["inside"], True
            else:
                b.before, b.low, b.high, b.guess = (b.low, b.high), max(b.low, r["low"]), min(b.high, r["high"]), r["guess"]
        open_ = [b for b in open_ if not b.done]
    if open_:
        raise RuntimeError(f"quantiles not settled in {PASSES} passes: {open_}")
    few = [b for b in brackets if b.value is None and b.inside]
    if few:
        row = df.agg(*(F.sort_array(F.collect_list(F.when(b.within(x[b.column]), x[b.column]))).alias(str(i)) for i, b in enumerate(few))).first()
        for i, b in enumerate(few):
            lo, hi, at = b.ranks(n[b.column])
            a, z = (row[str(i)][k - b.below] for k in (lo, hi))
            b.value = a if a == z else (hi - at) * a + (at - lo) * z
    return {c: [b.value for b in brackets if b.column == c] for c in columns}
