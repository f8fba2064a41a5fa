"""Exact medians of columns of any width.

The built-in median keeps every distinct value of a column in one task. Here
the two middle ranks are searched for instead: a coarse sketch gives a range
that must hold them, counts per value range narrow it down, and only the last
few values are sorted.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from evenkeel.functions.columns import number

# Value ranges counted per pass and column, and in all where columns are many.
RANGES, ALL_RANGES = 4096, 1 << 18
# Most values one task sorts at the end of the search.
SORT_ROWS = 100_000
# Relative rank error of the sketch is at most 1 / SKETCH.
SKETCH = 100
# Columns of one pass: Spark compiles no larger expressions, and what it does
# not compile is many times slower.
TOGETHER = 12
_HUGE = sys.float_info.max


class _Search:
    """State of the search for the ranks k1 <= k2 of one column."""

    def __init__(self, n: int, low: float, high: float):
        self.k1, self.k2 = (n + 1) // 2, n // 2 + 1
        self.low, self.high = low, high
        self.below = 0
        self.inside = n
        self.stuck = False
        self.middle: tuple[float, float] | None = (low, low) if low == high else None

    @property
    def open(self) -> bool:
        return self.middle is None

    def narrow(self, ranges: Sequence[Row]) -> None:
        """Move to the counted value range that holds the ranks; ``ranges`` are
        the one or two that hold them."""
        first, second = min(ranges, key=lambda r: r["b"]), max(ranges, key=lambda r: r["b"])
        if first["n"] == self.inside and first["lo"] == self.low and first["hi"] == self.high and first["lo"] < first["hi"]:
            if self.stuck:
                raise RuntimeError(f"the values from {self.low} to {self.high} cannot be told apart")
            self.stuck = True
        if first["b"] != second["b"]:
            self.middle = (first["hi"], second["lo"])
        elif first["lo"] == first["hi"]:
            self.middle = (first["lo"], first["lo"])
        self.low, self.high = first["lo"], first["hi"]
        self.below, self.inside = first["before"], first["n"]


def exact_medians(
    df: DataFrame, columns: Sequence[str], extra: Sequence[Column] = (), rows: int | None = None
) -> tuple[dict[str, float | None], Row | dict]:
    """Medians of numeric columns, null and NaN left out; the mean of the two
    middle values for an even count; None for a column without values.

    ``extra`` aggregates are computed in the first pass and returned in its
    row, next to ``n_<i>``, the number of values of the i-th column. Where the
    number of ``rows`` is known and one task may sort all values, one pass does.

    Counts of ranges and the last values are tables keyed by column, each column
    looked through by one task; two ranges per column reach the driver. More than
    ``TOGETHER`` columns are worked on in several passes.
    """
    if len(columns) > TOGETHER:
        medians, seen = {}, {}
        for low in range(0, len(columns), TOGETHER):
            part = columns[low: low + TOGETHER]
            found, row = exact_medians(df, part, () if low else extra, rows)
            medians |= found
            seen |= {} if low else (row if isinstance(row, dict) else row.asDict())
            seen |= {f"n_{low + i}": row[f"n_{i}"] for i in range(len(part))}
        return medians, seen
    values = {i: F.expr(number(df, c)) for i, c in enumerate(columns)}
    if rows is not None and rows * len(columns) <= SORT_ROWS:
        first = df.agg(
            *[F.count(v).alias(f"n_{i}") for i, v in values.items()],
            *[_middle(v).alias(f"mid_{i}") for i, v in values.items()], *extra).first()
        return {c: math.fsum(first[f"mid_{i}"]) / 2 if first[f"n_{i}"] else None for i, c in enumerate(columns)}, first
    # twice the sketch's error to each side of the middle
    around = [0.5 - 2 / SKETCH, 0.5 + 2 / SKETCH]
    first = df.agg(
        *[F.count(v).alias(f"n_{i}") for i, v in values.items()],
        *[F.min(v).alias(f"lo_{i}") for i, v in values.items()],
        *[F.max(v).alias(f"hi_{i}") for i, v in values.items()],
        *[F.percentile_approx(v, around, SKETCH).alias(f"near_{i}") for i, v in values.items()],
        *extra,
    ).first()
    searches = {}
    near = {}
    for i in values:
        if first[f"n_{i}"]:
            searches[i] = _Search(first[f"n_{i}"], first[f"lo_{i}"], first[f"hi_{i}"])
            near[i] = first[f"near_{i}"]
    while True:
        wide = {i: s for i, s in searches.items() if s.open and s.inside > SORT_ROWS}
        if not wide:
            break
        bounds = {i: near.pop(i, None) or (s.low, s.high) for i, s in wide.items()}
        found = _hit_ranges(df, values, bounds, wide)
        for i, s in wide.items():
            s.narrow([r for r in found if r["i"] == i])
    _finish(df, values, {i: s for i, s in searches.items() if s.open})
    medians = {
        c: math.fsum(searches[i].middle) / 2 if i in searches else None
        for i, c in enumerate(columns)
    }
    return medians, first


def _middle(value: Column) -> Column:
    """The two middle values, sorted by one task."""
    ordered = F.sort_array(F.collect_list(value))
    n = F.size(ordered)
    return F.when(n > 0, F.array(
        F.try_element_at(ordered, F.floor((n + 1) / 2).cast("int")), F.try_element_at(ordered, F.floor(n / 2).cast("int") + 1)))


def _of_column(numbers: dict[int, float | int], kind: str) -> Column:
    """A number that goes with the column ``i`` of a row."""
    pairs = [F.lit(x).cast(t) for pair in numbers.items() for x, t in zip(pair, ("int", kind))]
    return F.element_at(F.create_map(*pairs), F.col("i"))


def _cells(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*structs))).filter(F.col("v").isNotNull())


def _hit_ranges(
    df: DataFrame, values: dict[int, Column], bounds: dict[int, Sequence[float]], searches: dict[int, _Search]
) -> list[Row]:
    """Count values per range, -1 below the bounds and the last above them;
    returns the ranges that hold the ranks, with the count before them."""
    ranges = max(2, min(RANGES, ALL_RANGES // len(bounds)))
    structs = []
    for i, (low, high) in bounds.items():
        low, high = max(low, -_HUGE), min(high, _HUGE)
        v = values[i]
        # halved where the difference would leave the range of doubles
        part = 1.0 if math.isfinite(high - low) else 0.5
        low_part, width = low * part, high * part - low * part
        step = F.floor((v * F.lit(part) - F.lit(low_part)) / F.lit(width) * F.lit(ranges)) if width > 0 else F.lit(0)
        b = F.when(v < low, -1).when(v > high, ranges).otherwise(F.least(step, F.lit(ranges - 1)))
        structs.append(F.struct(F.lit(i).alias("i"), b.cast("int").alias("b"), v.alias("v")))
    counts = _cells(df, structs).groupBy("i", "b").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    order = Window.partitionBy("i").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    ranks = [_of_column({i: getattr(s, k) for i, s in searches.items()}, "bigint") for k in ("k1", "k2")]
    first, second = [(F.col("before") < k) & (F.col("before") + F.col("n") >= k) for k in ranks]
    return before.filter(first | second).collect()


def _finish(df: DataFrame, values: dict[int, Column], searches: dict[int, _Search]) -> None:
    """Sort what is left of each column, at most SORT_ROWS values, a task each."""
    if not searches:
        return
    structs = [
        F.struct(F.lit(i).alias("i"), F.when(values[i].between(s.low, s.high), values[i]).alias("v"))
        for i, s in searches.items()]
    ordered = F.sort_array(F.collect_list("v"))
    first = _of_column({i: s.k1 - s.below for i, s in searches.items()}, "int")
    last = _of_column({i: s.k2 - s.below for i, s in searches.items()}, "int")
    rows = _cells(df, structs).groupBy("i").agg(ordered.alias("o")).select(
        "i", F.element_at("o", first).alias("a"), F.element_at("o", last).alias("z")).collect()
    for r in rows:
        searches[r["i"]].middle = (r["a"], r["z"])
