"""Seeded hashes: the source of all randomness.

``md5(seed:key)`` depends only on the row's key, so that draws, splits and
shuffles do not change with partitioning, retries or lost executors, and can
be recomputed by any other SQL engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenkeel.functions.columns import cols


def key_text(names: Sequence[str], prefixed: bool = False) -> Column:
    """The key as text. Several columns are length-prefixed, so that
    ``("ab", "c")`` and ``("a", "bc")`` stay different; null is ``~``."""
    texts = [c.cast("string") for c in cols(names)]
    if len(texts) == 1 and not prefixed:
        return F.coalesce(texts[0], F.lit("~"))
    return _joined(texts)


def _joined(texts: Sequence[Column]) -> Column:
    return F.concat(
        *[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts]
    )


def row_hash(names: Sequence[str], seed: int) -> Column:
    """32 hex digits, uniform over the keys."""
    return F.md5(F.concat(F.lit(f"{int(seed)}:"), key_text(names)))


def hash60(text: Column) -> Column:
    """A 60-bit integer from the first 15 hex digits of the md5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
