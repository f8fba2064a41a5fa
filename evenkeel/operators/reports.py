"""Reports on any number of groups: a summary row and a table of groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from evenkeel.functions.columns import names_array, text
from evenkeel.operators.impact import impact_summary, positive_rate_by_group
from evenkeel.operators.odds import METRICS, odds_counts, odds_rates, odds_summary
from evenkeel.operators.parity import parity_groups, parity_summary, rate_gap
from evenkeel.sources.files import GroupReport
from evenkeel.sources.shared import materialize
from evenkeel.spec import DI_THRESHOLD, DP_THRESHOLD, EO_THRESHOLD, ValidationError

KINDS = ("parity", "rates", "impact", "odds")


def group_report(
    df: DataFrame,
    kind: str,
    sensitive: Sequence[str],
    target: str,
    prediction: str | None = None,
    threshold: float | None = None,
) -> GroupReport:
    """Demographic parity (``parity``), positive rates (``rates``), disparate
    impact (``impact``) or equalized odds (``odds``), without the bound that a
    single document has.

    Groups are counted once and written to the shared folder; the summary, as of
    the check of that name, is worked out from there.
    """
    if kind not in KINDS:
        raise ValidationError(f"a report is one of {KINDS}, not {kind!r}")
    if (kind == "odds") != (prediction is not None):
        raise ValidationError("equalized odds, and no other report, needs a prediction column")
    keys = tuple(sensitive)
    if kind == "parity":
        counts = materialize(parity_groups(df, keys, target), "report-groups")
        summary = parity_summary(counts, DP_THRESHOLD if threshold is None else threshold)
        groups = counts.select(*keys, "n", "positives", "selection_rate")
    elif kind == "odds":
        counts = materialize(odds_counts(df, keys, target, prediction), "report-groups")
        summary = odds_summary(counts, EO_THRESHOLD if threshold is None else threshold)
        groups = odds_rates(counts, keys).select(*keys, *METRICS)
    else:
        groups = materialize(positive_rate_by_group(df, keys, target), "report-groups")
        if kind == "impact":
            summary = impact_summary(groups, DI_THRESHOLD if threshold is None else threshold)
        else:
            summary = rate_gap(groups, DP_THRESHOLD if threshold is None else threshold)
    named = summary.selectExpr(
        "*", f"{text(kind)} AS report", f"{names_array(keys)} AS sensitive_features", f"{text(target)} AS target_column")
    return GroupReport(named, groups, keys)


__all__ = ["group_report"]
