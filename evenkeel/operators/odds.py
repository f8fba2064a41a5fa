"""Classification metrics per group and equalized odds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from evenkeel.functions.columns import (
    all_present, exprs, keep_free, names_array, quote, quotes, ratio, text, total,
)
from evenkeel.functions.status import eo_status
from evenkeel.operators.clean import label
from evenkeel.operators.contingency import contingency, inline_groups, recount, whole
from evenkeel.operators.validate import require_columns
from evenkeel.spec import EO_THRESHOLD

METRICS = ("count", "selection_rate", "true_positive_rate", "false_positive_rate")
_SPREADS = [f"{m}_difference" for m in METRICS]
_NO_ROWS = "every row lacks a group, a target or a prediction"
_BAD_LABELS = "Labels other than 0 and 1 (or -1 and 1)"


def _rates(zero_division: float | None) -> dict[str, str]:
    """The four metrics over a frame of confusion counts. A group without
    actual positives (negatives) has no TPR (FPR): ``zero_division``."""
    return {
        "count": "CAST(n AS double)",
        "selection_rate": ratio("selected", "n"),
        "true_positive_rate": ratio("tp", "(tp + fn)", zero_division),
        "false_positive_rate": ratio("fp", "(fp + tn)", zero_division),
    }


def _named(rates: dict[str, str]) -> list[str]:
    return [f"{value} AS {quote(name)}" for name, value in rates.items()]


def labelled(df: DataFrame, sensitive: Sequence[str], target: str, prediction: str) -> DataFrame:
    """Rows with a group, a numeric label and a numeric prediction, both cut
    to integers."""
    require_columns(df, [target, prediction, *sensitive])
    labels = {c: label(df, c) for c in (target, prediction)}
    kept = df.filter(" AND ".join([all_present(df, sensitive), *[known for _, known in labels.values()]]))
    return kept.withColumns(dict(zip(labels, exprs(v for v, _ in labels.values()), strict=True)))


def odds_counts(df: DataFrame, sensitive: Sequence[str], target: str, prediction: str) -> DataFrame:
    keep_free(sensitive, METRICS)
    rows = labelled(df, sensitive, target, prediction)
    y, p = quote(target), quote(prediction)
    extra = [
        f"count_if(NOT coalesce({y} IN (-1, 0, 1) AND {p} IN (-1, 0, 1), false)) AS unknown_labels",
        f"count_if({y} = 0 OR {p} = 0) AS zero_labels",
        f"count_if({y} = -1 OR {p} = -1) AS minus_labels",
    ]
    return contingency(rows, sensitive, target, prediction, extra)


def odds_rates(counts: DataFrame, sensitive: Sequence[str], zero_division: float | None = 0.0) -> DataFrame:
    """The four metrics per group, from the counts."""
    return counts.selectExpr(*quotes(sensitive), *_named(_rates(zero_division)))


def classification_by_group(
    df: DataFrame,
    sensitive: Sequence[str],
    target: str,
    prediction: str,
    zero_division: float | None = 0.0,
) -> DataFrame:
    """Count, selection rate of the predictions, TPR and FPR per group."""
    return odds_rates(odds_counts(df, sensitive, target, prediction), sensitive, zero_division)


def classification_overall(
    df: DataFrame,
    sensitive: Sequence[str],
    target: str,
    prediction: str,
    zero_division: float | None = 0.0,
) -> DataFrame:
    """The same four metrics over all rows, added up from the groups."""
    counts = recount(odds_counts(df, sensitive, target, prediction))
    return counts.selectExpr(*_named(_rates(zero_division)))


def between_group_difference(
    df: DataFrame,
    sensitive: Sequence[str],
    target: str,
    prediction: str,
    zero_division: float | None = 0.0,
) -> DataFrame:
    """Highest minus lowest group value of each metric, as one row."""
    groups = classification_by_group(df, sensitive, target, prediction, zero_division)
    return groups.agg(*exprs(f"max(`{m}`) - min(`{m}`) AS `{m}`" for m in METRICS))


def odds_summary(counts: DataFrame, threshold: float, zero_division: float | None = 0.0) -> DataFrame:
    """Overall metrics, spreads and status in one row, from the counts."""
    rates = _rates(zero_division)
    sums = ("n", "selected", "tp", "fp", "fn", "tn", "unknown_labels", "zero_labels", "minus_labels")
    # greatest() skips nulls, an undefined spread must not be skipped
    worst = """CASE WHEN true_positive_rate_difference IS NOT NULL AND false_positive_rate_difference IS NOT NULL
        THEN greatest(true_positive_rate_difference, false_positive_rate_difference) END"""
    return (
        counts.selectExpr("*", *_named(rates))
        .agg(*exprs([
            "count(1) AS n_groups",
            *[f"{total(c)} AS {c}" for c in sums],
            *[f"max(`{m}`) - min(`{m}`) AS {s}" for m, s in zip(METRICS, _SPREADS, strict=True)],
        ]))
        .selectExpr(
            "*",
            f"""CASE WHEN n = 0 THEN {text(_NO_ROWS)}
            WHEN unknown_labels > 0 OR (zero_labels > 0 AND minus_labels > 0) THEN {text(_BAD_LABELS)}
            END AS error_message""",
        )
        .selectExpr(
            "n_groups",
            "n AS n_rows",
            "error_message",
            *[f"CASE WHEN error_message IS NULL THEN {v} END AS `{m}`" for m, v in rates.items()],
            *[f"CASE WHEN error_message IS NULL THEN {s} END AS {s}" for s in _SPREADS],
            f"CASE WHEN error_message IS NULL THEN {worst} END AS equalized_odds_difference",
        )
        .selectExpr(
            "*",
            eo_status("equalized_odds_difference", "error_message IS NOT NULL", threshold)
            + " AS bias_check_status",
        )
    )


def equalized_odds(
    df: DataFrame,
    sensitive: Sequence[str],
    target: str,
    prediction: str,
    threshold: float = EO_THRESHOLD,
    zero_division: float | None = 0.0,
) -> DataFrame:
    """The worse of the TPR and FPR spreads, with all metrics and status."""
    return odds_summary(odds_counts(df, sensitive, target, prediction), threshold, zero_division)


def equalized_odds_report(
    df: DataFrame,
    sensitive: Sequence[str],
    target: str,
    prediction: str,
    threshold: float = EO_THRESHOLD,
    zero_division: float | None = 0.0,
    input_data: str | None = None,
) -> DataFrame:
    """The equalized odds check as one document row, group labels kept."""
    counts = odds_counts(df, sensitive, target, prediction)
    groups = odds_rates(counts, sensitive, zero_division)
    metrics = ", ".join(quotes(METRICS))
    listed = inline_groups(groups, sensitive, f"struct({', '.join(quotes(sensitive))}, {metrics})")
    spread = ", ".join(f"{s} AS `{m}`" for m, s in zip(METRICS, _SPREADS, strict=True))
    source = "CAST(NULL AS string)" if input_data is None else text(input_data)
    ok = "error_message IS NULL"
    return odds_summary(counts, threshold, zero_division).withColumn("__listed", listed).selectExpr(
        "'Classification Bias Check (Equalized Odds)' AS check_type",
        f"{source} AS input_data",
        f"{names_array(sensitive)} AS sensitive_features_used",
        f"{text(target)} AS target_column",
        f"{text(prediction)} AS prediction_column",
        f"CASE WHEN {ok} THEN {whole('__listed')} END AS metrics_by_group",
        f"struct(CASE WHEN {ok} THEN struct({spread}) END AS difference) AS disparity_metrics",
        "bias_check_status",
        "error_message",
        f"CASE WHEN {ok} THEN struct({metrics}, equalized_odds_difference) END AS overall_metrics",
        "n_groups",
    )
