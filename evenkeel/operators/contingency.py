"""The one aggregation behind every metric.

``contingency`` reads the table once and reduces it to a row per group; each
task sends at most one row per group to the shuffle, so a group that holds a
third of the table costs no more than a small one. Counts add up, so they may
be taken before a join and merged after it with ``recount``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.functions.columns import cols, exprs, group_label, is_one, keep_free, quote, quotes, total

BASE = ("n", "positives")
CONFUSION = ("selected", "tp", "fp", "fn", "tn")

# Largest number of groups written inside a report document. A document on
# more is an error, never an incomplete one; the table per group has no bound.
DOCUMENT_GROUPS = 1_000_000


def contingency(
    df: DataFrame,
    sensitive: Sequence[str],
    target: str,
    prediction: str | None = None,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Rows, positives and, given predictions, the confusion counts per group.

    ``extra`` are further aggregates, as SQL texts.
    """
    keep_free(sensitive, [*BASE, *CONFUSION])
    y = is_one(df, target)
    counts = ["count(1) AS n", f"count_if({y}) AS positives"]
    if prediction is not None:
        p = is_one(df, prediction)
        counts += [
            f"count_if({p}) AS selected",
            f"count_if({y} AND {p}) AS tp",
            f"count_if(NOT {y} AND {p}) AS fp",
            f"count_if({y} AND NOT {p}) AS fn",
            f"count_if(NOT {y} AND NOT {p}) AS tn",
        ]
    return df.groupBy(*cols(sensitive)).agg(*exprs([*counts, *extra]))


def recount(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add counts up to coarser groups, or to one row for the whole table."""
    names = [c for c in (*BASE, *CONFUSION) if c in counts.columns]
    return counts.groupBy(*cols(by)).agg(*exprs(f"{total(c)} AS {quote(c)}" for c in names))


def inline_groups(by_group: DataFrame, keys: Sequence[str], entry: str) -> Column:
    """``entry`` of all groups, in order of the key, as one array.

    Beyond ``DOCUMENT_GROUPS`` groups the array is bounded, not whole;
    ``whole`` turns that into an error.
    """
    names = ", ".join(quotes(keys))
    first = by_group.limit(DOCUMENT_GROUPS)
    ordered = f"sort_array(collect_list(struct({names}, {entry} AS __entry)))"
    return first.agg(F.expr(f"transform({ordered}, g -> g.__entry)")).scalar()


def groups_in_parts(
    by_group: DataFrame, summary: DataFrame, keys: Sequence[str], entry: str, size: int
) -> DataFrame:
    """``summary`` (one row with ``n_groups``) once per part of about ``size``
    groups, with ``entry`` of its groups, in order of the key, as ``__listed``.

    Groups are dealt to parts by the hash of their label, so no task holds more
    than a few parts. Without groups there is one part, an empty one.
    """
    names = ", ".join(quotes(keys))
    parts = summary.selectExpr(f"greatest(1L, CAST(ceil(n_groups / {int(size)}) AS long))").scalar()
    part = F.pmod(F.expr(f"xxhash64({group_label(keys)})"), parts)
    ordered = f"sort_array(collect_list(struct({names}, {entry} AS __entry)))"
    listed = by_group.groupBy(part.alias("__part")).agg(
        F.expr(f"transform({ordered}, g -> g.__entry)").alias("__listed")).drop("__part")
    none = F.array().cast(listed.schema["__listed"].dataType).alias("__listed")
    return listed.crossJoin(F.broadcast(summary)).unionByName(
        summary.where("n_groups = 0").select("*", none))


def whole(value: str) -> str:
    """``value``, or an error where ``n_groups`` are too many for a document."""
    return (f"CASE WHEN n_groups <= {DOCUMENT_GROUPS} THEN {value} ELSE raise_error("
            f"'over {DOCUMENT_GROUPS} groups do not fit a document; use the table per group') END")
