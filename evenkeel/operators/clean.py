"""Projection, cleaning and labelling. Every operator here is a narrow
projection or filter: no shuffle."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.columns import (
    all_present, col, cols, double, dtype, exprs, group_label, is_fractional, is_integral, is_number,
    is_text, number, quote,
)
from evenkeel.operators.validate import require_columns
from evenkeel.spec import LABEL_THRESHOLD, ColumnRoles, ValidationError


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*cols(c for c in df.columns if c not in set(columns)))


def recode(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    """Replace values by a map; values without an entry become null.

    A key matches values of its own sort only: a text key no number, a number
    no text.
    """
    kind = dtype(df, column)
    chain = F.when(F.lit(False), F.lit(next(iter(mapping.values()), None)))
    for old, new in mapping.items():
        if _same_sort(kind, old):
            chain = chain.when(col(column) == F.lit(old), F.lit(new))
    return df.withColumn(column, chain)


def _same_sort(kind: T.DataType, value: object) -> bool:
    if is_text(kind):
        return isinstance(value, str)
    if isinstance(kind, T.BooleanType) or isinstance(value, bool):
        return isinstance(kind, T.BooleanType) and isinstance(value, bool)
    if is_number(kind):
        return isinstance(value, (int, float, Decimal))
    return not isinstance(value, (str, int, float))


def infer_roles(df: DataFrame, target: str, sensitive: Sequence[str]) -> ColumnRoles:
    """Numbers are numeric features, text is categorical, the rest neither."""
    require_columns(df, [target, *sensitive])
    taken = {target, *sensitive}
    features = [f for f in df.schema.fields if f.name not in taken]
    return ColumnRoles(
        target=target,
        sensitive=tuple(sensitive),
        numeric=tuple(
            f.name for f in features if is_integral(f.dataType) or is_fractional(f.dataType)
        ),
        categorical=tuple(f.name for f in features if isinstance(f.dataType, T.StringType)),
    )


def assign_roles(df: DataFrame, roles: ColumnRoles, remainder: str = "passthrough") -> DataFrame:
    """Order the table as features, sensitive columns, target.

    ``remainder="drop"`` keeps only listed features, ``"passthrough"`` all.
    """
    require_columns(df, roles.essential)
    listed = set(roles.numeric) | set(roles.categorical)
    taken = {roles.target, *roles.sensitive}
    features = [
        c for c in df.columns if c not in taken and (remainder == "passthrough" or c in listed)
    ]
    return df.select(*cols([*features, *roles.sensitive, roles.target]))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that have a value (neither null nor NaN) in all ``columns``."""
    require_columns(df, columns)
    return df.filter(all_present(df, columns))


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows ``drop_missing`` would keep and drop, as one row."""
    require_columns(df, columns)
    whole = all_present(df, columns)
    return df.agg(*exprs([
        "count(1) AS n_rows",
        f"count_if({whole}) AS n_kept",
        f"count_if(NOT ({whole})) AS n_dropped",
    ]))


def to_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as doubles; text that is no number becomes null."""
    return df.withColumns({c: F.expr(number(df, c)) for c in columns})


def label(df: DataFrame, column: str) -> tuple[str, str]:
    """The column cut to an integer, and the condition that it holds a
    number at all, as SQL texts. Whole numbers stay as they are."""
    if is_integral(dtype(df, column)):
        return f"CAST({quote(column)} AS bigint)", f"{quote(column)} IS NOT NULL"
    value = number(df, column)
    return f"try_cast({value} AS bigint)", f"({value}) IS NOT NULL"


def to_label(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as integers; fractions are cut off."""
    return df.withColumns({c: F.expr(label(df, c)[0]) for c in columns})


def group_key(df: DataFrame, columns: Sequence[str], out: str | None = None) -> DataFrame:
    """Add one label column for a group of columns, by default named by
    joining their names with ``_``."""
    name = out or "_".join(columns)
    return df if [name] == list(columns) else df.withColumn(name, F.expr(group_label(columns)))


def binarize(df: DataFrame, score: str, out: str, threshold: float = LABEL_THRESHOLD) -> DataFrame:
    """1 where the score is above the threshold, else 0 (also for null)."""
    above = f"coalesce({number(df, score)} > {double(threshold)}, false)"
    return df.withColumn(out, F.expr(f"CAST({above} AS int)"))


def numeric_features(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> list[str]:
    """Number, boolean and vector columns other than the target."""
    skip = {target, *exclude}
    names = [
        f.name for f in df.schema.fields
        if f.name not in skip
        and (is_number(f.dataType) or isinstance(f.dataType, (T.BooleanType, VectorUDT)))
    ]
    if not names:
        raise ValidationError("no numeric feature columns to train on")
    return names


def align_features(features: Sequence[str], test: DataFrame) -> list[str]:
    """The training features that the test table has, in training order."""
    kept = [f for f in features if f in test.columns]
    if not kept:
        raise ValidationError("the test table holds no column that the model was trained on")
    if len(kept) < len(features):
        gap = [f for f in features if f not in kept]
        warnings.warn(f"training features missing from the test table: {gap}", stacklevel=2)
    return kept
