"""Oversampling of disadvantaged groups."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.columns import col, cols, double, equals_one, exprs, number, quotes, ratio
from evenkeel.functions.hashing import hash60, key_text
from evenkeel.operators.clean import drop_missing
from evenkeel.operators.contingency import contingency
from evenkeel.operators.sampling import (
    KEY_HASH, expand_draws, fetch_rows, ranked_keys, spread_copies, with_copy_numbers,
)
from evenkeel.operators.validate import not_binary, require_columns
from evenkeel.sources.shared import materialize
from evenkeel.spec import SEED, ValidationError

# Tolerance for equal rates, and for a target rate of 1.
EQUAL_RATES = 1e-6
FULL_RATE = 1e-9

# Most groups whose plan is broadcast to filter the positives before they
# are shuffled; with more groups the join itself does the filtering.
BROADCAST_GROUPS = 10_000


def group_rates(df: DataFrame, sensitive: Sequence[str], target: str) -> DataFrame:
    """Size, positives and selection rate per group, null groups left out.

    Rows without a target count for the size, not for the rate.
    """
    known = f"count({number(df, target)}) AS __known"
    return _rates(contingency(drop_missing(df, sensitive), sensitive, target, extra=[known]), "__known").drop("__known")


def _rates(counts: DataFrame, whole: str = "n") -> DataFrame:
    return counts.selectExpr("*", f"{ratio('positives', whole, zero=0.0)} AS rate")


def oversample_plan(df: DataFrame, sensitive: Sequence[str], target: str) -> DataFrame:
    """How many positives each group needs to reach the highest rate.

    N solves (p + N) / (n + N) = r, rounded half to even. Groups within
    1e-6 of the highest rate r get none, nor does any group when r is 1. A
    target other than 0 or 1, or none, is an error.
    """
    wrong = df.agg(F.expr(f"count_if({not_binary(df, target)})")).first()[0]
    if wrong:
        raise ValidationError(f"{target!r} holds {wrong} values other than 0 or 1")
    return _plan(group_rates(df, sensitive, target))


def _plan(rates: DataFrame) -> DataFrame:
    best = rates.agg(F.max("rate")).scalar()
    behind = "(target_rate * n - positives)"
    return (
        rates.withColumn("target_rate", best)
        .selectExpr("*", f"target_rate - rate >= {double(EQUAL_RATES)} AS disadvantaged")
        .selectExpr(
            "*",
            f"""CASE WHEN disadvantaged AND 1D - target_rate >= {double(FULL_RATE)} AND {behind} > 0
            THEN CAST(rint({behind} / (1D - target_rate)) AS bigint) ELSE 0L END AS n_to_add""",
        )
    )


def oversample(
    df: DataFrame,
    sensitive: Sequence[str],
    target: str,
    key: Sequence[str] | None = None,
    seed: int = SEED,
    out: str = "draw_no",
) -> DataFrame:
    """The table with drawn positives of disadvantaged groups appended.

    Original rows carry 0 in ``out``; a positive drawn m times is appended m
    times, numbered 1..m, so ``key`` and ``out`` together identify rows.
    Without a key, rows are told apart by content and copy number, and the
    column ``copy_no`` is added as well.

    A table with fewer than two groups, or with nothing to add, comes back
    unchanged apart from ``out``. Groups that need positives but have none to
    copy are an error, as is a target other than 0 or 1.
    """
    require_columns(df, [target, *sensitive])
    if not key:
        df = with_copy_numbers(df)
        key = df.columns
    # one pass over the table: counts per group, and values that are no label
    violations = f"count_if({not_binary(df, target)}) AS violations"
    counts = materialize(contingency(df, sensitive, target, extra=[violations]), "group-counts")
    plan = _plan(_rates(drop_missing(counts, sensitive)))
    found = plan.withColumn("wrong", counts.agg(F.sum("violations")).scalar()).agg(*exprs([
        "count(1) AS groups",
        "count_if(n_to_add > 0) AS short",
        "count_if(n_to_add > 0 AND positives = 0) AS empty",
        "sum(n_to_add) AS total",
        "max(try_divide(n_to_add, positives)) AS copies",
        "max(wrong) AS wrong",
    ])).first()
    wrong = found["wrong"] if found["groups"] else counts.agg(F.sum("violations")).first()[0]
    if wrong:
        raise ValidationError(f"{target!r} holds {wrong} values other than 0 or 1")
    if found["empty"]:
        raise ValidationError(f"{found['empty']} groups need positives but have none to copy")
    original = df.withColumn(out, F.lit(0).cast("bigint"))
    if found["groups"] < 2 or not found["short"]:
        return original

    needed = plan.filter("n_to_add > 0").selectExpr(
        *[f"{c} AS __g{i}" for i, c in enumerate(quotes(sensitive))],
        "positives AS __pool",
        "n_to_add AS __add",
    )
    groups = [f"__g{i}" for i in range(len(sensitive))]
    draws = spread_copies(needed, "__add", "__i", found["total"])
    text = F.concat(F.lit(f"{int(seed)}:"), key_text(groups), F.lit(":"), F.col("__i").cast("string"))
    drawn = draws.groupBy(*groups, (F.pmod(hash60(text), F.col("__pool")) + 1).alias("__drawn")).agg(
        F.count(F.lit(1)).alias("__m")
    )

    pool = df.filter(equals_one(df, target))
    if found["short"] <= BROADCAST_GROUPS:
        member = [col(s) == F.col(g) for s, g in zip(sensitive, groups, strict=True)]
        pool = pool.join(F.broadcast(needed.select(*groups)), member, "left_semi")
    # only groups and hashes of keys are ranked and meet the draws; whole rows are fetched at the end
    ranked = ranked_keys(drop_missing(pool, sensitive), key, seed, "__rank", by=sensitive)
    match = [col(s) == F.col(g) for s, g in zip(sensitive, groups, strict=True)]
    hits = ranked.join(drawn, [*match, F.col("__rank") == F.col("__drawn")]).select(KEY_HASH, "__m")
    rows = fetch_rows(drop_missing(pool, sensitive), materialize(hits, "hits"), key, seed)
    rows = rows.select(*cols(df.columns), "__m")
    added = expand_draws(rows, "__m", out, math.ceil(found["copies"]), 1, found["total"])
    return original.unionByName(added)


__all__ = ["group_rates", "oversample", "oversample_plan"]
