"""The three audits: parity, mitigation, odds.

Each reads its raw table once: rows are recoded and written to the shared
folder, and the checks that need rows are counted by that write. Medians and
categories are learned from the copy, the encoded table is written next to it,
and report, mitigation and splits read from there. What reaches the driver: the
counts, the fitted state, the report, and the split boundaries.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.columns import cols
from evenkeel.functions.hashing import key_text
from evenkeel.functions.status import ERROR, PASSED
from evenkeel.operators.clean import drop_if_present, infer_roles, recode
from evenkeel.operators.features import FittedPreprocessor, fit_preprocessor
from evenkeel.operators.mitigate import oversample
from evenkeel.operators.model import TrainedModel, predict, train_regressor
from evenkeel.operators.observed import quality_counts, warn_of
from evenkeel.operators.odds import equalized_odds_report
from evenkeel.operators.parity import demographic_parity_report
from evenkeel.operators.sampling import Splits, cap_rows, train_val_test_split, with_copy_numbers
from evenkeel.operators.validate import checked_ratio, validate_columns
from evenkeel.sources.files import Landing, csv_columns, land_csv
from evenkeel.sources.shared import materialize, remove_tables, written_tables
from evenkeel.spec import ColumnRoles, DatasetSpec, ValidationError

_ROW = "__row"
_DRAW = "draw_no"


class _Result:
    """What an audit returns, with the tables it left in the shared folder."""

    def cleanup(self) -> None:
        """Delete the tables that the audit wrote there. Its frames read them,
        so save what is wanted first; a second call does nothing."""
        remove_tables(self.checks.sparkSession, self.scratch)


@dataclass(frozen=True)
class ParityResult(_Result):
    checks: DataFrame
    processed: DataFrame
    report: DataFrame
    splits: Splits
    counts: Mapping[str, int] = field(default_factory=dict)
    scratch: tuple[str, ...] = ()


@dataclass(frozen=True)
class MitigationResult(_Result):
    checks: DataFrame
    processed: DataFrame
    report: DataFrame
    mitigated: bool
    balanced: DataFrame
    final_report: DataFrame
    splits: Splits
    counts: Mapping[str, int] = field(default_factory=dict)
    scratch: tuple[str, ...] = ()


@dataclass(frozen=True)
class OddsResult(_Result):
    checks: DataFrame
    splits: Splits
    model: TrainedModel
    predictions: DataFrame
    report: DataFrame
    counts: Mapping[str, int] = field(default_factory=dict)
    scratch: tuple[str, ...] = ()


def _listing_scratch(flow: Callable[..., _Result]) -> Callable[..., _Result]:
    """The flow, its result with the paths of the tables it wrote. A flow that
    fails deletes them."""

    @wraps(flow)
    def run(df: DataFrame | Landing, *args, **kwargs) -> _Result:
        rows = df.rows if isinstance(df, Landing) else df
        with written_tables() as paths:
            try:
                if rows is not df:
                    warn_of(df.counts, stacklevel=4)
                result = flow(rows, *args, **kwargs)
                counts = {**df.counts, **result.counts} if rows is not df else result.counts
                return replace(result, counts=counts, scratch=tuple(paths))
            except Exception:
                remove_tables(rows.sparkSession, paths)
                raise

    return run


def land(spark: SparkSession, path: str, spec: DatasetSpec, to: str | None = None) -> Landing:
    """The file of a known layout, parsed once: what the audits start from.

    Expected columns that the file lacks are left out here; the audits warn of
    them or fail.
    """
    schema = spec.schema
    if schema is not None:
        found = csv_columns(spark, path, spec.sep, spec.encoding)
        known = {f.name: f for f in schema.fields}
        schema = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in found])
    return land_csv(spark, path, to, spec.sep, spec.encoding, schema)


def _clean(df: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, ColumnRoles]:
    for column, mapping in spec.recodes.items():
        if column in df.columns:
            df = recode(df, column, mapping)
    df = drop_if_present(df, spec.drop)
    roles = spec.roles or infer_roles(drop_if_present(df, spec.key), spec.target, spec.sensitive)
    return df, roles


def prepare(
    df: DataFrame, spec: DatasetSpec, fitted: FittedPreprocessor | None = None
) -> tuple[DataFrame, FittedPreprocessor]:
    """Clean and encode a raw table; the key columns are carried along.

    A fitted preprocessor, say from training rows only, may be passed in.
    """
    df, roles = _clean(df, spec)
    if fitted is None:
        fitted = fit_preprocessor(df, roles, spec.remainder, spec.scale)
    return fitted.transform(df, keep=spec.key), fitted


def _identified(df: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, list[str], list[str]]:
    """The table, a key for its rows, and helper columns to drop at the end.

    Without a key, the raw row and its copy number are hashed into one short
    column, so that later steps need not look at whole rows again.
    """
    if spec.key:
        return df, list(spec.key), []
    numbered = with_copy_numbers(df, "__copy_no")
    row = F.md5(key_text(numbered.columns, prefixed=True))
    return numbered.select(*cols(df.columns), row.alias(_ROW)), [_ROW], [_ROW]


def _landed(df: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, DataFrame, ColumnRoles, dict[str, int]]:
    """Column report, the cleaned table written once, its roles, and what was
    counted meanwhile: rows, missing targets, labels other than 0 and 1, rows
    that lack a target or a group, wrongly decoded texts."""
    checks = validate_columns(df, spec)
    raw = quality_counts(df, present_in=[spec.target], texts=None)
    table, roles = _clean(raw.table, spec)
    clean = quality_counts(table, binary=[spec.target], essential=[spec.target, *spec.sensitive])
    table = materialize(clean.table, "landed")
    counts = {**clean.get(), **raw.get()}
    checked_ratio(spec.target, counts[f"null:{spec.target}"], counts["n_rows"], spec.null_threshold)
    warn_of({k: n for k, n in counts.items() if k.startswith("suspect:")}, stacklevel=5)
    return checks, table, roles, counts


def _prepared(
    df: DataFrame, spec: DatasetSpec
) -> tuple[DataFrame, DataFrame, list[str], list[str], dict[str, int]]:
    """Column report, prepared table, its key, helper columns, counts."""
    checks, table, roles, counts = _landed(df, spec)
    table, key, helpers = _identified(table, spec)
    fitted = fit_preprocessor(
        table, roles, spec.remainder, spec.scale, spec.category_form, rows=counts["n_rows"])
    return checks, materialize(fitted.transform(table, keep=key), "prepared"), key, helpers, counts


def _reported(report: DataFrame) -> tuple[DataFrame, str]:
    """The report and its status. An error stops the audit."""
    status = report.select("bias_check_status").first()[0]
    if status == ERROR:
        raise ValidationError("the parity check failed: no rows with a target and a group")
    return report, status


def _split(
    df: DataFrame, spec: DatasetSpec, key: list[str], helpers: list[str], max_train_rows: int | None, rows: int
) -> Splits:
    """Split, bound the training rows on request, and drop helper columns."""
    splits = train_val_test_split(df, key, spec.test_size, spec.val_size, spec.seed, rows)
    parts, sizes = dict(splits.items()), dict(splits.sizes)
    if max_train_rows is not None:
        parts["train"] = cap_rows(parts["train"], max_train_rows, key, spec.seed + 1)
        sizes["train"] = min(sizes["train"], max_train_rows)
    labelled = drop_if_present(splits.labelled, helpers) if max_train_rows is None else None
    return Splits(**{n: drop_if_present(f, helpers) for n, f in parts.items()}, sizes=sizes, labelled=labelled)


@_listing_scratch
def parity_flow(df: DataFrame | Landing, spec: DatasetSpec, max_train_rows: int | None = None) -> ParityResult:
    """Validate, prepare, check demographic parity, split. A warning does
    not stop the split, an error does. ``max_train_rows`` bounds the rows that
    a model is to be fitted on; the other splits are always whole."""
    checks, table, key, helpers, counts = _prepared(df, spec)
    report, _ = _reported(demographic_parity_report(table, spec.sensitive, spec.target, spec.dp_threshold))
    splits = _split(table, spec, key, helpers, max_train_rows, counts["n_rows"])
    return ParityResult(checks, drop_if_present(table, helpers), report, splits, counts)


@_listing_scratch
def mitigation_flow(
    df: DataFrame | Landing, spec: DatasetSpec, max_train_rows: int | None = None
) -> MitigationResult:
    """As ``parity_flow``; a table that does not pass is rebalanced and
    checked again before it is split."""
    checks, table, key, helpers, counts = _prepared(df, spec)
    processed = drop_if_present(table, helpers)
    report, status = _reported(demographic_parity_report(table, spec.sensitive, spec.target, spec.dp_threshold))
    if status == PASSED:
        splits = _split(table, spec, key, helpers, max_train_rows, counts["n_rows"])
        return MitigationResult(checks, processed, report, False, processed, report, splits, counts)
    drawn = oversample(table, spec.sensitive, spec.target, key, spec.seed, out=_DRAW)
    drawn = quality_counts(drawn)
    balanced = materialize(drawn.table, "balanced")
    final, _ = _reported(demographic_parity_report(balanced, spec.sensitive, spec.target, spec.dp_threshold))
    helpers = [*helpers, _DRAW]
    counts["n_balanced"] = drawn.get()["n_rows"]
    splits = _split(balanced, spec, [*key, _DRAW], helpers, max_train_rows, counts["n_balanced"])
    balanced = drop_if_present(balanced, helpers)
    return MitigationResult(checks, processed, report, True, balanced, final, splits, counts)


@_listing_scratch
def odds_flow(
    df: DataFrame | Landing,
    spec: DatasetSpec,
    prediction: str = "pred_col",
    trees: int = 100,
    max_depth: int = 8,
    exclude: tuple[str, ...] = (),
    max_train_rows: int | None = None,
    fit_on: str = "all",
) -> OddsResult:
    """Validate, prepare, split, train, predict the test rows, check
    equalized odds on them. The key is never a feature. Test rows with labels
    other than 0 and 1, or without an essential value, are warned of.

    ``fit_on="train"`` splits first and learns medians and categories from
    the training rows only, so that nothing leaks from the test rows.
    """
    if fit_on == "all":
        checks, table, key, helpers, counts = _prepared(df, spec)
        splits = _split(table, spec, key, helpers, max_train_rows, counts["n_rows"])
    elif fit_on == "train":
        checks, table, roles, counts = _landed(df, spec)
        table, key, helpers = _identified(table, spec)
        if helpers:
            table = materialize(table, "raw")
        raw = _split(table, spec, key, helpers, max_train_rows, counts["n_rows"])
        fitted = fit_preprocessor(raw.train, roles, spec.remainder, spec.scale, spec.category_form)
        parts = {n: fitted.transform(f, keep=spec.key) for n, f in raw.items()}
        splits = Splits(**parts, sizes=raw.sizes)
    else:
        raise ValidationError(f"fit_on must be all or train, not {fit_on!r}")
    model = train_regressor(
        splits.train, spec.target, trees, spec.seed, exclude, max_depth, key=spec.key)
    labels = [spec.target, prediction]
    scored = quality_counts(
        predict(model, splits.test, prediction), binary=labels, essential=[*labels, *spec.sensitive])
    predictions = materialize(scored.table, "scored")
    tested = scored.get()
    warn_of(tested, stacklevel=4)
    counts = {**counts, **{f"test_{k}": n for k, n in tested.items()}}
    report = equalized_odds_report(predictions, spec.sensitive, spec.target, prediction, spec.eo_threshold)
    return OddsResult(checks, splits, model, predictions, report, counts)
