"""Selection rates and demographic parity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from evenkeel.functions.columns import (
    cols, double, dtype, exprs, group_label, is_one, is_text, keep_free, names_array, number, present,
    quote, ratio, text, total,
)
from evenkeel.functions.status import dp_status
from evenkeel.operators.clean import drop_missing
from evenkeel.operators.contingency import contingency, groups_in_parts, inline_groups, recount, whole
from evenkeel.operators.impact import positive_rate_by_group
from evenkeel.sources.shared import materialize
from evenkeel.spec import DP_THRESHOLD

_RATE = ratio("positives", "n")


def selection_rate_by_group(df: DataFrame, sensitive: Sequence[str], target: str) -> DataFrame:
    """Share of rows whose target equals 1, per group. Rows with a missing
    target or group are left out."""
    counts = contingency(drop_missing(df, [target, *sensitive]), sensitive, target)
    return counts.selectExpr("*", f"{_RATE} AS selection_rate")


def overall_selection_rate(df: DataFrame, sensitive: Sequence[str], target: str) -> DataFrame:
    """The same share over all rows, added up from the groups."""
    counts = contingency(drop_missing(df, [target, *sensitive]), sensitive, target)
    return recount(counts).selectExpr("*", f"{_RATE} AS overall_selection_rate")


def selection_rate_rollup(df: DataFrame, sensitive: Sequence[str], target: str) -> DataFrame:
    """Rates per group, per leading part of the group key, and overall; keys
    that are summed over are null."""
    kept = drop_missing(df, [target, *sensitive])
    keep_free(sensitive, ["n", "positives", "selection_rate"])
    counts = exprs(["count(1) AS n", f"count_if({is_one(kept, target)}) AS positives"])
    return kept.rollup(*cols(sensitive)).agg(*counts).selectExpr("*", f"{_RATE} AS selection_rate")


def parity_groups(df: DataFrame, sensitive: Sequence[str], target: str) -> DataFrame:
    # text is compared by its hash: least and greatest text would sort the table
    value = f"xxhash64({quote(target)})" if is_text(dtype(df, target)) else present(df, target)
    extra = [
        f"min({value}) AS lowest", f"max({value}) AS highest", f"max({number(df, target)}) AS only_value",
    ]
    counts = contingency(drop_missing(df, [target, *sensitive]), sensitive, target, extra=extra)
    return counts.selectExpr("*", f"{_RATE} AS selection_rate")


def parity_summary(groups: DataFrame, threshold: float) -> DataFrame:
    """One row from the table per group. A target with a single value has no
    measurable gap: difference 0, and its mean as the overall rate."""
    return (
        groups.agg(*exprs([
            f"{total('n')} AS n_rows",
            "count(1) AS n_groups",
            f"{total('positives')} AS positives",
            "coalesce(max(selection_rate) - min(selection_rate), 0D) AS gap",
            "coalesce(min(lowest) = max(highest), true) AS target_is_constant",
            "max(only_value) AS only_value",
        ]))
        .selectExpr(
            "n_rows",
            "n_groups",
            "target_is_constant",
            f"CASE WHEN target_is_constant THEN only_value ELSE {ratio('positives', 'n_rows')} END"
            " AS overall_selection_rate",
            "CASE WHEN target_is_constant THEN 0D ELSE gap END AS demographic_parity_difference",
            f"{double(threshold)} AS bias_threshold_used",
        )
        .selectExpr(
            "*", f"{dp_status('demographic_parity_difference', 'n_rows', threshold)} AS bias_check_status"
        )
    )


def demographic_parity(
    df: DataFrame, sensitive: Sequence[str], target: str, threshold: float = DP_THRESHOLD
) -> DataFrame:
    """Difference between the highest and lowest selection rate, with status."""
    return parity_summary(parity_groups(df, sensitive, target), threshold)


def demographic_parity_report(
    df: DataFrame,
    sensitive: Sequence[str],
    target: str,
    threshold: float = DP_THRESHOLD,
    groups_per_row: int | None = None,
) -> DataFrame:
    """The parity check as one document row, rates by group included.

    With ``groups_per_row`` any number of groups fits: the document comes as
    rows that share all columns but the rates, of which each row holds those of
    about so many groups. Groups are counted once and written to the shared folder.
    """
    groups = parity_groups(df, sensitive, target)
    entry = f"struct({group_label(sensitive)} AS key, selection_rate AS value)"
    rates = "map_from_entries(__listed)"
    if groups_per_row is None:
        listed = inline_groups(groups, sensitive, entry)
        documents, rates = parity_summary(groups, threshold).withColumn("__listed", listed), whole(rates)
    else:
        groups = materialize(groups, "report-groups")
        documents = groups_in_parts(groups, parity_summary(groups, threshold), sensitive, entry, groups_per_row)
    return documents.selectExpr(
        f"CASE WHEN target_is_constant THEN CAST(map() AS map<string, double>)"
        f" ELSE {rates} END AS selection_rate_by_group",
        "overall_selection_rate",
        "demographic_parity_difference",
        "bias_threshold_used",
        "bias_check_status",
        f"{names_array(sensitive)} AS sensitive_features",
        f"{text(target)} AS target_column",
        "'Demographic Parity' AS check_type",
        "n_rows",
        "n_groups",
    )


def rate_gap(groups: DataFrame, threshold: float) -> DataFrame:
    return groups.agg(*exprs([
        f"{total('count')} AS n_rows",
        "count(1) AS n_groups",
        "coalesce(max(positive_rate) - min(positive_rate), 0D) AS positive_rate_difference",
    ])).selectExpr(
        "*", f"{dp_status('positive_rate_difference', 'n_rows', threshold)} AS bias_check_status"
    )


def positive_rate_difference(
    df: DataFrame, sensitive: Sequence[str], target: str, threshold: float = DP_THRESHOLD
) -> DataFrame:
    """The gap between group means of the target (the older parity report)."""
    return rate_gap(positive_rate_by_group(df, sensitive, target), threshold)


def positive_rate_report(
    df: DataFrame, sensitive: Sequence[str], target: str, threshold: float = DP_THRESHOLD
) -> DataFrame:
    """The older report shape: rate and count by group, gap, status."""
    groups = positive_rate_by_group(df, sensitive, target)
    entry = f"struct({group_label(sensitive)} AS key, struct(positive_rate, `count`) AS value)"
    listed = inline_groups(groups, sensitive, entry)
    return rate_gap(groups, threshold).withColumn("__listed", listed).selectExpr(
        f"{whole('map_from_entries(__listed)')} AS group_statistics",
        f"{names_array(sensitive)} AS sensitive_features",
        f"{text(target)} AS target_column",
        "positive_rate_difference",
        "bias_check_status",
    )


__all__ = [
    "demographic_parity", "demographic_parity_report", "overall_selection_rate", "parity_summary",
    "positive_rate_difference", "positive_rate_report", "selection_rate_by_group",
    "selection_rate_rollup",
]
