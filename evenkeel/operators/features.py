"""Imputation, standardization and one-hot encoding: fit once, apply lazily."""

from __future__ import annotations

import json
import math
import warnings
from collections import Counter
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.columns import (
    category_text, double, dtype, exprs, is_number, number, quote, quotes, text,
)
from evenkeel.operators.categories import CategoryDictionary, category_dictionary, with_category_vectors
from evenkeel.operators.quantiles import exact_medians
from evenkeel.operators.validate import require_columns
from evenkeel.spec import ColumnRoles, ValidationError

# Categories become 0/1 columns, or one sparse vector column per feature.
CATEGORY_FORMS = ("columns", "vector")
# Most categories that become columns, in all; vectors have no such bound.
MAX_CATEGORIES = 1_000_000

# Rows whose categories one task may put together.
FEW_ROWS = 10_000

MISSING_NAME = "nan"


@dataclass(frozen=True)
class FittedPreprocessor:
    """Learned state. Plain values only, so it survives as JSON; categories of
    vectors are a table, of which the state has the path."""

    roles: ColumnRoles
    remainder: str = "passthrough"
    medians: dict[str, float | None] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    deviations: dict[str, float] = field(default_factory=dict)
    categories: dict[str, list[str | None]] = field(default_factory=dict)
    dropped: tuple[str, ...] = ()
    category_form: str = "columns"
    dictionary: CategoryDictionary | None = None

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False)

    @classmethod
    def from_json(cls, text: str) -> FittedPreprocessor:
        state = json.loads(text)
        state["roles"] = ColumnRoles(**state["roles"])
        state["dropped"] = tuple(state["dropped"])
        if state.get("dictionary"):
            state["dictionary"] = CategoryDictionary(**state["dictionary"])
        return cls(**state)

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Numeric block, one-hot block, remainder, sensitive, target.

        One projection, except for categories as vectors.
        ``keep`` names columns, such as a key, that count as remainder even
        where the remainder is dropped.
        """
        require_columns(df, self.roles.essential)
        vectors = {}
        if self.dictionary is not None:
            vectors = {c: f"{c}__vector" for c in self.roles.categorical}
            df = with_category_vectors(df, self.dictionary, self.roles.categorical, "__vector")
        out: list[tuple[str, str]] = []
        for c in self.roles.numeric:
            if c not in self.dropped:
                out.append((c, self._numeric(df, c)))
        for c in self.roles.categorical:
            if c in vectors:
                out.append((f"{c}_onehot", quote(vectors[c])))
            else:
                out += _dummies(df, c, self.categories[c])
        listed = {self.roles.target, *self.roles.sensitive, *self.roles.numeric, *self.roles.categorical}
        skip = listed | set(vectors.values())
        rest = df.columns if self.remainder == "passthrough" else keep
        out += [(c, quote(c)) for c in rest if c not in skip]
        out += [(c, quote(c)) for c in (*self.roles.sensitive, self.roles.target)]
        _check_names(df, [name for name, _ in out])
        return df.selectExpr(*[f"{value} AS {quote(name)}" for name, value in out])

    def _numeric(self, df: DataFrame, name: str) -> str:
        value = _imputed(df, name, self.medians.get(name))
        if name in self.means:
            value = f"({value} - {double(self.means[name])}) / {double(self.deviations[name])}"
        return value


def fit_preprocessor(
    df: DataFrame,
    roles: ColumnRoles,
    remainder: str = "passthrough",
    scale: bool = False,
    category_form: str = "columns",
    dictionary_path: str | None = None,
    rows: int | None = None,
) -> FittedPreprocessor:
    """Learn medians, scales and categories. Medians and scales reach the
    driver, and categories where they become columns. Those of vectors are
    written to ``dictionary_path``, or the shared folder without one. ``rows``
    may state the number of rows: a few are learned from in one pass.

    A numeric column without any value is dropped with a warning; over an
    empty table all numeric columns are kept. ``category_form="vector"`` makes
    one sparse vector per categorical column, however many categories there are;
    the number of categories never decides it.
    """
    if category_form not in CATEGORY_FORMS:
        raise ValidationError(f"category_form must be one of {CATEGORY_FORMS}, not {category_form!r}")
    if remainder not in ("passthrough", "drop"):
        raise ValidationError(f"remainder must be passthrough or drop, not {remainder!r}")
    require_columns(df, roles.essential)
    text = [c for c in roles.numeric if not is_number(dtype(df, c))]
    if text:
        raise ValidationError(f"columns {text} are not numeric")
    if not roles.numeric and not roles.categorical:
        return FittedPreprocessor(roles=roles, remainder=remainder)
    extra = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(roles.numeric):
        value = number(df, c)
        extra += exprs([f"avg({value}) AS avg_{i}", f"var_pop({value}) AS var_{i}"])
    listed = roles.categorical if category_form == "columns" else ()
    few = rows is not None and rows <= FEW_ROWS
    for i, c in enumerate(listed):
        value = category_text(df, c)
        extra.append(F.expr(f"collect_set({value}) AS set_{i}" if few else f"approx_count_distinct({value}) AS width_{i}"))
        extra.append(F.expr(f"count_if(({value}) IS NULL) AS gaps_{i}"))
    medians, stats = exact_medians(df, roles.numeric, extra, rows)
    dropped = tuple(c for c, m in medians.items() if m is None) if stats["rows"] else ()
    if dropped:
        warnings.warn(f"numeric columns without any value are dropped: {list(dropped)}", stacklevel=2)
    means, deviations = {}, {}
    if scale:
        for i, c in enumerate(roles.numeric):
            if medians[c] is not None:
                means[c], deviations[c] = _imputed_scale(
                    stats["rows"], stats[f"n_{i}"], stats[f"avg_{i}"], stats[f"var_{i}"], medians[c]
                )
    if few:
        sets = [[*stats[f"set_{i}"], *([None] if stats[f"gaps_{i}"] else [])] for i in range(len(listed))]
        categories = {c: _in_order(df, c, values) for c, values in zip(listed, sets, strict=True)}
    else:
        _check_widths({c: stats[f"width_{i}"] for i, c in enumerate(listed)})
        categories = _categories(df, listed)
    dictionary = None
    if category_form == "vector" and roles.categorical:
        dictionary = category_dictionary(df, roles.categorical, dictionary_path)
    return FittedPreprocessor(
        roles=roles,
        remainder=remainder,
        medians=medians,
        means=means,
        deviations=deviations,
        categories=categories,
        dropped=dropped,
        category_form=category_form,
        dictionary=dictionary,
    )


def _imputed_scale(rows: int, n: int, mean: float, var: float, fill: float) -> tuple[float, float]:
    """Mean and population deviation after ``rows - n`` gaps got ``fill``."""
    gaps = rows - n
    whole = (n * mean + gaps * fill) / rows
    spread = (n * (var + (mean - whole) ** 2) + gaps * (fill - whole) ** 2) / rows
    deviation = math.sqrt(spread)
    return whole, deviation if deviation > 0 else 1.0


def _check_widths(widths: dict[str, int]) -> None:
    """Fail before categories are fetched, if they are too many for columns."""
    if sum(widths.values()) > MAX_CATEGORIES:
        raise ValidationError(f"about {widths} categories are too many for columns; make them vectors")


def _imputed(df: DataFrame, name: str, median: float | None) -> str:
    value = number(df, name)
    return value if median is None else f"coalesce({value}, {double(median)})"


def _categories(df: DataFrame, names: Sequence[str]) -> dict[str, list[str | None]]:
    """Distinct values per column, in order, null last. One pass for all
    columns; each task sends its distinct values only."""
    if not names:
        return {}
    pairs = F.array(*[
        F.expr(f"struct({i} AS i, {category_text(df, c)} AS v)") for i, c in enumerate(names)
    ])
    # callers have bounded the number of rows that arrive here with a sketch
    rows = df.select(F.explode(pairs).alias("p")).select("p.*").distinct().collect()
    found: dict[str, list[str | None]] = {}
    for i, c in enumerate(names):
        found[c] = _in_order(df, c, [r["v"] for r in rows if r["i"] == i])
    return found


def _in_order(df: DataFrame, name: str, values: Sequence[str | None]) -> list[str | None]:
    as_value = float if is_number(dtype(df, name)) else str
    ordered = sorted((v for v in values if v is not None), key=as_value)
    return [*ordered, None] if None in values else ordered


def _dummies(df: DataFrame, name: str, values: Sequence[str | None]) -> list[tuple[str, str]]:
    """Names and SQL texts of the 0/1 columns of one categorical column."""
    value = category_text(df, name)
    out = []
    for v in values:
        hit = f"({value}) IS NULL" if v is None else f"{value} = {text(v)}"
        out.append((f"{name}_{MISSING_NAME if v is None else v}", f"CASE WHEN {hit} THEN 1D ELSE 0D END"))
    return out


def _check_names(df: DataFrame, names: Sequence[str]) -> None:
    strict = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    counts = Counter(n if strict else n.lower() for n in names)
    clash = sorted(n for n, k in counts.items() if k > 1)
    if clash:
        raise ValidationError(f"several output columns would be named {clash}")


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill missing values with the exact median of the column."""
    require_columns(df, columns)
    medians, _ = exact_medians(df, columns)
    return df.withColumns({c: F.expr(_imputed(df, c, m)) for c, m in medians.items()})


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Subtract the mean, divide by the population deviation (1 if it is 0)."""
    require_columns(df, columns)
    stats = df.agg(
        *exprs(f"avg({number(df, c)}) AS avg_{i}" for i, c in enumerate(columns)),
        *exprs(f"stddev_pop({number(df, c)}) AS dev_{i}" for i, c in enumerate(columns)),
    ).first()
    scaled = {
        c: f"({number(df, c)} - {double(stats[f'avg_{i}'])}) / {double(stats[f'dev_{i}'] or 1.0)}"
        for i, c in enumerate(columns)
        if stats[f"avg_{i}"] is not None
    }
    return df.withColumns({c: F.expr(value) for c, value in scaled.items()})


def one_hot(df: DataFrame, columns: Sequence[str], category_form: str = "columns") -> DataFrame:
    """Replace each column by one 0/1 column per category, or by one sparse
    vector ``<column>_onehot``, which may have any number of them."""
    require_columns(df, columns)
    rest = [c for c in df.columns if c not in set(columns)]
    if category_form == "vector":
        vectors = [f"{c}_onehot" for c in columns]
        _check_names(df, rest + vectors)
        return with_category_vectors(df, category_dictionary(df, columns), columns).selectExpr(*quotes([*rest, *vectors]))
    if category_form != "columns":
        raise ValidationError(f"category_form must be one of {CATEGORY_FORMS}, not {category_form!r}")
    widths = exprs(f"approx_count_distinct({category_text(df, c)}) AS w{i}" for i, c in enumerate(columns))
    _check_widths(dict(zip(columns, df.agg(*widths).first(), strict=True)))
    categories = _categories(df, columns)
    blocks = [pair for c in columns for pair in _dummies(df, c, categories[c])]
    _check_names(df, rest + [n for n, _ in blocks])
    return df.selectExpr(*quotes(rest), *[f"{value} AS {quote(name)}" for name, value in blocks])
