"""Checks that come with a copy: counts gathered while a table is written.

Spark adds the counts up in the tasks that write, so a check costs no pass of
its own, and a task that is run again counts once.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import types as T

from evenkeel.functions.columns import all_present, exprs, present, quote
from evenkeel.operators.validate import not_binary, require_columns
from evenkeel.sources.shared import materialize


class Counts:
    """Named counts over a table, filled when the table is written."""

    def __init__(self, df: DataFrame, aggregates: Mapping[str, str]):
        self._seen = Observation()
        self._names = list(aggregates)
        texts = [f"{value} AS c{i}" for i, value in enumerate(aggregates.values())]
        self.table = df.observe(self._seen, *exprs(["count(1) AS n_rows", *texts]))

    def get(self) -> dict[str, int]:
        """Waits for the write."""
        found = self._seen.get
        return {"n_rows": found["n_rows"], **{name: found[f"c{i}"] for i, name in enumerate(self._names)}}


def quality_counts(
    df: DataFrame,
    present_in: Sequence[str] = (),
    binary: Sequence[str] = (),
    essential: Sequence[str] = (),
    texts: Sequence[str] | None = (),
) -> Counts:
    """The counts ``null:<column>``, ``not_binary:<column>`` (missing counts),
    ``dropped`` (rows that lack an essential value) and ``suspect:<column>``
    (rows with the mark of a wrong decoding; ``None`` for all text columns)."""
    if texts is None:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    require_columns(df, [*present_in, *binary, *essential, *texts])
    aggregates = {f"null:{c}": f"count_if(({present(df, c)}) IS NULL)" for c in present_in}
    aggregates |= {f"not_binary:{c}": f"count_if({not_binary(df, c)})" for c in binary}
    aggregates |= {f"suspect:{c}": f"count_if(contains({quote(c)}, '�'))" for c in texts}
    if essential:
        aggregates["dropped"] = f"count_if(NOT ({all_present(df, essential)}))"
    return Counts(df, aggregates)


def observed_copy(df: DataFrame, name: str = "landed", **checks) -> tuple[DataFrame, dict[str, int]]:
    """The table written once to the shared folder, and its quality counts."""
    counts = quality_counts(df, **checks)
    return materialize(counts.table, name), counts.get()


def warn_of(counts: Mapping[str, int], stacklevel: int = 3) -> None:
    """One warning for each count that tells of trouble."""
    texts = {
        "not_binary": "{0!r} holds {1} values other than 0 or 1",
        "suspect": "{0!r} holds wrongly decoded text in {1} rows; check the encoding",
        "bad": "{1} lines of the file are {0}",
    }
    for key, n in counts.items():
        kind, _, column = key.partition(":")
        if n and kind == "dropped":
            warnings.warn(f"{n} rows lack an essential value and do not count", stacklevel=stacklevel)
        elif n and kind in texts:
            warnings.warn(texts[kind].format(column, n), stacklevel=stacklevel)


__all__ = ["Counts", "observed_copy", "quality_counts", "warn_of"]
