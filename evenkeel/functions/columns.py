"""SQL texts for columns: quoting, missing values, numbers, labels, ratios.

Operators put expressions together as SQL text and hand each one to Spark in
a single call.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.spec import ValidationError

# Text that counts as a number. Java would also take "1d", "2f" and hex floats.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"


def quote(name: str) -> str:
    """A column name as it stands, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def quotes(names: Iterable[str]) -> list[str]:
    return [quote(n) for n in names]


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float) -> str:
    """A SQL double literal."""
    x = float(value)
    return f"{x!r}D" if math.isfinite(x) else f"CAST('{x!r}' AS double)"


def exprs(texts: Iterable[str]) -> list[Column]:
    return [F.expr(t) for t in texts]


def col(name: str) -> Column:
    return F.col(quote(name))


def cols(names: Iterable[str]) -> list[Column]:
    return [col(n) for n in names]


def dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_fractional(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def is_integral(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.CharType, T.VarcharType))


def present(df: DataFrame, name: str) -> str:
    """The column with NaN folded to null, so that both mean "missing"."""
    c = quote(name)
    return f"CASE WHEN NOT isnan({c}) THEN {c} END" if is_fractional(dtype(df, name)) else c


def category_text(df: DataFrame, name: str) -> str:
    """The value as text, null where it is missing."""
    return f"CAST({present(df, name)} AS string)"


def all_present(df: DataFrame, names: Sequence[str]) -> str:
    return " AND ".join(f"{present(df, n)} IS NOT NULL" for n in names) or "true"


def as_number(c: str, kind: T.DataType) -> str:
    """``c`` as double; text that is no number and NaN become null."""
    if is_text(kind):
        return f"CASE WHEN {c} RLIKE r'{NUMBER}' THEN try_cast(trim({c}) AS double) END"
    if isinstance(kind, T.BooleanType):
        return f"CAST(CAST({c} AS int) AS double)"
    if is_fractional(kind):
        return f"CASE WHEN NOT isnan({c}) THEN CAST({c} AS double) END"
    return f"try_cast({c} AS double)"


def number(df: DataFrame, name: str) -> str:
    return as_number(quote(name), dtype(df, name))


def equals_one(df: DataFrame, name: str) -> str:
    """Condition that the label equals 1, in a form that scans can filter by."""
    kind = dtype(df, name)
    if isinstance(kind, T.BooleanType):
        return quote(name)
    return f"{quote(name)} = 1" if is_number(kind) else f"{number(df, name)} = 1"


def is_one(df: DataFrame, name: str) -> str:
    """True where the label equals 1, false otherwise (also for null)."""
    return f"coalesce({equals_one(df, name)}, false)"


def ratio(part: str, whole: str, zero: float | None = None) -> str:
    """``part / whole`` as one double division; ``zero`` when whole is 0."""
    value = f"try_divide(CAST({part} AS double), CAST({whole} AS double))"
    return value if zero is None else f"coalesce({value}, {double(zero)})"


def total(name: str) -> str:
    """Sum of a count column, 0 over no rows."""
    return f"coalesce(sum({quote(name)}), 0L)"


def group_label(names: Sequence[str]) -> str:
    """One text label per group: the value itself, or a JSON list of values."""
    texts = [f"CAST({c} AS string)" for c in quotes(names)]
    return texts[0] if len(texts) == 1 else f"to_json(array({', '.join(texts)}))"


def names_array(names: Sequence[str]) -> str:
    return f"array({', '.join(text(n) for n in names)})"


def keep_free(names: Iterable[str], reserved: Iterable[str]) -> None:
    """Fail when a grouping column would collide with a result column."""
    clash = sorted({n.lower() for n in names} & {r.lower() for r in reserved})
    if clash:
        raise ValidationError(f"columns {clash} carry names of result columns; rename them first")
