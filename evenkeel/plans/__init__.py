"""Whole audits composed of the operators."""

from evenkeel.plans.flows import (
    MitigationResult, OddsResult, ParityResult, land, mitigation_flow, odds_flow, parity_flow, prepare,
)

__all__ = [
    "MitigationResult", "OddsResult", "ParityResult", "land", "mitigation_flow", "odds_flow",
    "parity_flow", "prepare",
]
