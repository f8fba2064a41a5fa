"""Positive rates as means, and disparate impact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from evenkeel.functions.columns import (
    all_present, cols, double, dtype, exprs, is_integral, keep_free, names_array, number, quote,
    quotes, ratio, text,
)
from evenkeel.functions.status import di_ratio, di_status
from evenkeel.operators.contingency import inline_groups, whole
from evenkeel.operators.validate import require_columns
from evenkeel.spec import DI_THRESHOLD


def positive_rate_by_group(df: DataFrame, sensitive: Sequence[str], target: str) -> DataFrame:
    """Mean of the target read as a number, and how many rows have one, per
    group. Rows without a group are left out; a group without any number has
    a null rate."""
    require_columns(df, [target, *sensitive])
    keep_free(sensitive, ["positive_rate", "count"])
    # whole numbers are added up exactly, whatever the order of the rows
    whole = is_integral(dtype(df, target))
    value = f"CAST({quote(target)} AS bigint)" if whole else number(df, target)
    sums = exprs([f"sum({value}) AS __sum", f"count({value}) AS `count`"])
    return (
        df.filter(all_present(df, sensitive))
        .groupBy(*cols(sensitive))
        .agg(*sums)
        .selectExpr(*quotes(sensitive), f"{ratio('__sum', '`count`')} AS positive_rate", "`count`")
    )


def impact_summary(groups: DataFrame, threshold: float = DI_THRESHOLD) -> DataFrame:
    rates = ("n_valid", "min_positive_rate", "max_positive_rate")
    return groups.agg(*exprs([
        "count(1) AS n_groups",
        "count(positive_rate) AS n_valid",
        "min(positive_rate) AS min_positive_rate",
        "max(positive_rate) AS max_positive_rate",
    ])).selectExpr(
        "*",
        f"{di_ratio(*rates)} AS disparate_impact_min_max_ratio",
        f"{di_status(*rates, threshold)} AS bias_check_status",
        f"{double(threshold)} AS disparate_impact_threshold",
    )


def disparate_impact(
    df: DataFrame, sensitive: Sequence[str], target: str, threshold: float = DI_THRESHOLD
) -> DataFrame:
    """Lowest over highest positive rate, with status."""
    return impact_summary(positive_rate_by_group(df, sensitive, target), threshold)


def disparate_impact_report(
    df: DataFrame, sensitive: Sequence[str], target: str, threshold: float = DI_THRESHOLD
) -> DataFrame:
    """The disparate impact check as one document row."""
    groups = positive_rate_by_group(df, sensitive, target)
    record = f"struct({', '.join(quotes(sensitive))}, positive_rate, `count`)"
    listed = inline_groups(groups, sensitive, record)
    return impact_summary(groups, threshold).withColumn("__listed", listed).selectExpr(
        "'Data Distribution Bias Check (Disparate Impact Min/Max Ratio)' AS analysis_type",
        "'Ratio of Min/Max Positive Rate per Group' AS metric_calculated",
        f"{names_array(sensitive)} AS sensitive_features",
        f"{text(target)} AS target_column",
        f"{whole('__listed')} AS group_statistics",
        "min_positive_rate",
        "max_positive_rate",
        "disparate_impact_min_max_ratio",
        "bias_check_status",
        "disparate_impact_threshold",
        "n_groups",
    )
