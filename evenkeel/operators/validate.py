"""Checks of a table's columns, nulls, values and encoding.

``require_*`` functions raise, everything else returns a small frame. All
row-level checks are single aggregates: one row per task is shuffled.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.columns import (
    all_present, col, double, exprs, number, present, quote, quotes, ratio, text,
)
from evenkeel.spec import NULL_THRESHOLD, DatasetSpec, EmptyInputError, ValidationError


def _per_column(
    df: DataFrame, columns: Sequence[str], name: str, aggregate: Callable[[str], str]
) -> DataFrame:
    """One row per column, with the row count and one aggregate called
    ``name``, from a single pass over the table."""
    counts = [f"{aggregate(c)} AS a{i}" for i, c in enumerate(columns)]
    structs = [
        f"struct({i + 1} AS position, {text(c)} AS `column`, a{i} AS {name})" for i, c in enumerate(columns)
    ]
    flat = df.agg(*exprs(["count(1) AS n_rows", *counts]))
    listed = f"CAST(array({', '.join(structs)}) AS array<struct<position: int, `column`: string, {name}: bigint>>)"
    return flat.selectExpr("n_rows", f"inline({listed})")


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValidationError(f"required columns {missing} are missing from {df.columns}")


def check_expected_columns(
    df: DataFrame, expected: Sequence[str], mandatory: Sequence[str] = ()
) -> DataFrame:
    """One row per listed column: is it there, and how bad is it if not.

    Warns about missing expected columns, never fails.
    """
    names = list(dict.fromkeys([*mandatory, *expected]))
    rows = []
    for name in names:
        found = name in df.columns
        bad = "error" if name in mandatory else "warning"
        rows.append((name, found, "ok" if found else bad))
    missing = [r[0] for r in rows if r[2] == "warning"]
    if missing:
        warnings.warn(f"missing expected columns: {missing}", stacklevel=2)
    fields = ("column", "found", "severity")
    structs = [F.struct(*[F.lit(v).alias(f) for f, v in zip(fields, r, strict=True)]) for r in rows]
    listed = F.array(*structs) if structs else F.expr("cast(array() as array<struct<column: string, found: boolean, severity: string>>)")
    return df.sparkSession.range(1).select(F.inline(listed))


def require_nonempty(df: DataFrame, what: str = "table") -> None:
    if not df.columns:
        raise EmptyInputError(f"the {what} has no columns")
    if df.isEmpty():
        raise EmptyInputError(f"the {what} has no rows")


def null_ratio(df: DataFrame, columns: Sequence[str], threshold: float = NULL_THRESHOLD) -> DataFrame:
    """Missing values per column; fails a column when ratio > threshold.

    The ratio of an empty table is 0.
    """
    require_columns(df, columns)
    rows = _per_column(df, columns, "n_null", lambda c: f"count_if(({present(df, c)}) IS NULL)")
    return rows.selectExpr(
        "n_rows", "`column`", "n_null", f"{ratio('n_null', 'n_rows', zero=0.0)} AS null_ratio",
        f"{double(threshold)} AS threshold",
    ).selectExpr("*", "null_ratio <= threshold AS passed")


def require_null_ratio(df: DataFrame, column: str, threshold: float = NULL_THRESHOLD) -> float:
    row = null_ratio(df, [column], threshold).first()
    return checked_ratio(column, row["n_null"], row["n_rows"], threshold)


def checked_ratio(column: str, n_null: int, n_rows: int, threshold: float = NULL_THRESHOLD) -> float:
    """The null ratio, 0 for an empty table; an error beyond the threshold."""
    ratio_ = n_null / n_rows if n_rows else 0.0
    if ratio_ > threshold:
        raise ValidationError(f"{column!r} is null in {ratio_:.2%} of its rows, more than {threshold:.2%}")
    return ratio_


def encoding_suspects(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per text column that hold U+FFFD, the mark of a wrong decoding."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    rows = _per_column(df, columns, "n_suspect", lambda c: f"count_if(contains({quote(c)}, '\ufffd'))")
    return rows.drop("position")


def profile(df: DataFrame) -> DataFrame:
    """Shape and columns: one row per column with its type and filled cells."""
    rows = _per_column(df, df.columns, "n_present", lambda c: f"count({present(df, c)})")
    kinds = ", ".join(f"{text(f.name)}, {text(f.dataType.simpleString())}" for f in df.schema.fields)
    return rows.selectExpr(
        "*", f"{len(df.columns)} AS n_columns", f"element_at(map({kinds}), `column`) AS type"
    )


def distinct_preview(df: DataFrame, columns: Sequence[str], limit: int = 10) -> DataFrame:
    """The first ``limit`` distinct values of each column, in text order.

    One pass for all columns. Each task keeps and sends its first ``limit``
    values per column only, so a column of unique values costs no more.
    """
    names = list(dict.fromkeys(columns))

    def first_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [pa.array([], pa.string()) for _ in names]
        for batch in batches:
            for i, column in enumerate(batch.columns):
                values = pa.concat_arrays([kept[i], column.cast(pa.string())]).drop_null().unique()
                kept[i] = values.take(pc.sort_indices(values)[:limit])
        owner = [name for name, values in zip(names, kept, strict=True) for _ in range(len(values))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner, pa.string()), pa.concat_arrays(kept)], names=["column", "value"]
        )

    texts = df.select(*[col(c).cast("string").alias(f"c{i}") for i, c in enumerate(names)])
    values = texts.mapInArrow(first_values, "column string, value string").distinct()
    order = Window.partitionBy("column").orderBy("value")
    return (
        values.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= limit)
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each non-null value."""
    counts = (
        df.filter(all_present(df, [column]))
        .groupBy(col(column).alias("value"))
        .agg(F.expr("count(1) AS n"))
    )
    everything = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("__all", everything).selectExpr(
        "value", "n", f"{ratio('n', '__all')} AS share"
    )


def not_binary(df: DataFrame, column: str) -> str:
    """SQL text: the value is not 0 or 1; null is neither."""
    return f"NOT coalesce(({number(df, column)}) IN (0D, 1D), false)"


def binary_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column whose value is not 0 or 1; null is a violation."""
    rows = _per_column(df, columns, "n_violations", lambda c: f"count_if({not_binary(df, c)})")
    return rows.drop("position")


def check_binary(df: DataFrame, columns: Sequence[str], on_violation: str = "warn") -> int:
    """Count values other than 0 and 1; warn or fail if there are any."""
    found = [r for r in binary_violations(df, columns).collect() if r["n_violations"]]
    text = "; ".join(f"{r['column']!r} holds {r['n_violations']} values other than 0 or 1" for r in found)
    if found and on_violation == "error":
        raise ValidationError(text)
    if found:
        warnings.warn(text, stacklevel=2)
    return sum(r["n_violations"] for r in found)


def group_cardinality(df: DataFrame, sensitive: Sequence[str]) -> DataFrame:
    """Number of groups with a one-word verdict: ``too_few`` (below two),
    ``ok`` (two) or ``many`` (more than two). Null keys are no group."""
    keyed = df.filter(all_present(df, sensitive)).selectExpr(*quotes(sensitive))
    return keyed.distinct().agg(F.expr("count(1) AS n_groups")).selectExpr(
        "n_groups",
        "CASE WHEN n_groups < 2 THEN 'too_few' WHEN n_groups = 2 THEN 'ok' ELSE 'many' END AS verdict",
    )


def target_is_constant(df: DataFrame, target: str) -> bool:
    value = present(df, target)
    row = df.agg(*exprs([f"min({value}) = max({value}) AS same", f"count({value}) AS n"])).first()
    return row["n"] == 0 or bool(row["same"])


def validate_columns(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The column report; reads no rows. A missing required column is an error."""
    if not df.columns:
        raise EmptyInputError("the table has no columns")
    require_columns(df, spec.required)
    return check_expected_columns(df, spec.expected, spec.required)


def validate(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """All checks of a raw table. Raises on a critical one, returns the
    column report otherwise."""
    report = validate_columns(df, spec)
    require_null_ratio(df, spec.target, spec.null_threshold)
    return report


__all__ = [
    "binary_violations", "check_binary", "check_expected_columns", "checked_ratio", "distinct_preview",
    "encoding_suspects", "group_cardinality", "not_binary", "null_ratio", "profile", "require_columns",
    "require_nonempty", "require_null_ratio", "target_is_constant", "validate", "validate_columns", "value_shares",
]
