"""Status ladders of the three checks, as SQL texts."""

from __future__ import annotations

from evenkeel.functions.columns import double, text

# Status texts as they appear in reports.
PASSED = "Passed"
WARNING = "Warning"
ERROR = "Error"
DI_WARNING = "Warning: Potential Adverse Impact Detected"
DI_ZERO = "Passed (All rates zero)"
DI_BAD_MAX = "Error (Max rate zero, Min rate non-zero)"
DI_ONE_GROUP = "Skipped (Only one group)"
DI_NO_RATES = "Skipped (No valid rates)"
EO_PASSED = "Passed (Equalized Odds disparity within threshold)"
EO_INCONCLUSIVE = "Inconclusive (Could not calculate Equalized Odds difference)"
EO_ERROR = "Calculation Error"


def dp_status(gap: str, n_rows: str, threshold: float) -> str:
    """Demographic parity: no rows is an error, an unmeasurable gap passes."""
    return f"""CASE WHEN {n_rows} = 0 THEN {text(ERROR)}
        WHEN abs(coalesce({gap}, 0D)) > {double(threshold)} THEN {text(WARNING)}
        ELSE {text(PASSED)} END"""


def di_ratio(n_valid: str, low: str, high: str) -> str:
    """Lowest rate over highest rate, with the agreed values where undefined."""
    return f"""CASE WHEN {n_valid} = 1 THEN 1D
        WHEN {n_valid} >= 2 AND {high} > 0 THEN {low} / {high}
        WHEN {n_valid} >= 2 AND {low} = 0 THEN 1D END"""


def di_status(n_valid: str, low: str, high: str, threshold: float) -> str:
    return f"""CASE WHEN {n_valid} = 0 THEN {text(DI_NO_RATES)}
        WHEN {n_valid} = 1 THEN {text(DI_ONE_GROUP)}
        WHEN {high} > 0 AND {low} / {high} < {double(threshold)} THEN {text(DI_WARNING)}
        WHEN {high} > 0 THEN {text(PASSED)}
        WHEN {low} = 0 THEN {text(DI_ZERO)}
        ELSE {text(DI_BAD_MAX)} END"""


def eo_status(gap: str, failed: str, threshold: float) -> str:
    limit = text(f") > threshold ({float(threshold)})")
    return f"""CASE WHEN {failed} THEN {text(EO_ERROR)}
        WHEN {gap} IS NULL THEN {text(EO_INCONCLUSIVE)}
        WHEN abs({gap}) > {double(threshold)}
        THEN concat('Warning: Equalized Odds Difference (', format_string('%.4f', {gap}), {limit})
        ELSE {text(EO_PASSED)} END"""
