"""Exact, repeatable sampling without a global sort.

Rows are put in a random order by ``md5(seed:key)``. Two ways use it:

* ``hash_cuts`` finds the hash value below which exactly k rows lie, by
  counting rows per hash prefix and looking closer only into the prefix that
  holds the boundary. Splitting or capping a table is then a plain filter:
  no row is shuffled, whatever the size of the table.
* ``exact_rank`` numbers rows 1..n in that order: rows are numbered inside
  hash-prefix buckets, bucket offsets come from the bucket counts.

The key must tell rows apart. ``with_copy_numbers`` makes such a key from the
whole row for tables that have none.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.columns import col, cols, is_fractional, keep_free
from evenkeel.functions.hashing import hash60, key_text, row_hash
from evenkeel.operators.validate import require_columns
from evenkeel.sources.shared import materialize
from evenkeel.spec import SEED, ValidationError

# Hex digits looked at per counting pass: at most 16**3 counts per cut reach
# the driver, whatever the size of the table.
PREFIX_STEP = 3
# Most hash values one task sorts to find the exact boundary.
BOUNDARY_ROWS = 100_000
# Hex digits of a rank bucket: 65,536 buckets.
BUCKET_DIGITS = 4
# Copies of one row that are made in one go: at least this many, and more
# where the total would otherwise give more than MOST_CHUNKS pieces.
COPY_CHUNK = 1_000
MOST_CHUNKS = 1_000_000
# Copies that a task should make when they are spread over the cluster.
TASK_COPIES = 5_000_000
# Rows with no more copies than this are expanded where they lie.
RARE_COPIES = 16
# Most hashes of repeated rows that are broadcast, 8 bytes each.
BROADCAST_DIGESTS = 1_000_000

# Most drawn rows whose hashes are broadcast, some 30 bytes each.
BROADCAST_HITS = 500_000

KEY_HASH = "__key_hash"
_HASH = "__hash"
_DIGEST = "__digest"
_BUCKET = "__bucket"
_GROUP = "__group"
_ABOVE_ALL = "g"  # greater than any hex text
_BELOW_ALL = ""  # smaller than any hex text


def hash_cuts(
    df: DataFrame, key: Sequence[str], seed: int, ranks: Callable[[int], Sequence[int]], rows: int | None = None
) -> tuple[int, list[str]]:
    """Row count n and, for each k in ``ranks(n)``, the text h so that exactly
    k rows have a hash <= h.

    Reads only the key columns: one pass for tables up to some 100 million
    rows, one more for each further factor of 4,096, and one to finish. Where
    the number of ``rows`` is known and one task may sort them, one pass does.
    """
    require_columns(df, key)
    hashes = df.select(row_hash(key, seed).alias(_HASH))
    if rows is not None and 0 < rows <= BOUNDARY_ROWS:
        wanted = [min(max(int(k), 0), rows) for k in ranks(rows)]
        places = {i: ("", k, rows) for i, k in enumerate(wanted) if 0 < k < rows}
        found = _exact_cuts(hashes, places, key) if places else {}
        return rows, [found.get(i, _BELOW_ALL if k == 0 else _ABOVE_ALL) for i, k in enumerate(wanted)]
    counts = _prefix_counts(hashes, PREFIX_STEP)
    n = sum(counts.values())
    wanted = [min(max(int(k), 0), n) for k in ranks(n)]
    cuts: list[str | None] = [
        _BELOW_ALL if k == 0 else _ABOVE_ALL if k == n else None for k in wanted
    ]
    # open cuts: index -> (prefix that holds the boundary, rank inside it, rows inside it)
    places = {i: _locate(counts, k) for i, k in enumerate(wanted) if cuts[i] is None}
    while any(rows > BOUNDARY_ROWS for _, _, rows in places.values()):
        digits = len(next(iter(places.values()))[0])
        if digits >= 32:
            raise ValidationError(f"key {list(key)} does not tell rows apart")
        inside = hashes.filter(F.substring(_HASH, 1, digits).isin(*{p for p, _, _ in places.values()}))
        counts = _prefix_counts(inside, digits + PREFIX_STEP)
        places = {
            i: _locate({p: c for p, c in counts.items() if p.startswith(prefix)}, rank)
            for i, (prefix, rank, _) in places.items()
        }
    if places:
        for i, cut in _exact_cuts(hashes, places, key).items():
            cuts[i] = cut
    return n, cuts


def _prefix_counts(hashes: DataFrame, digits: int) -> dict[str, int]:
    rows = hashes.groupBy(F.substring(_HASH, 1, digits).alias("p")).count().collect()
    return {r["p"]: r["count"] for r in rows}


def _locate(counts: Mapping[str, int], rank: int) -> tuple[str, int, int]:
    for prefix in sorted(counts):
        if rank <= counts[prefix]:
            return prefix, rank, counts[prefix]
        rank -= counts[prefix]
    raise AssertionError("rank beyond the counted rows")


def _exact_cuts(
    hashes: DataFrame, places: Mapping[int, tuple[str, int, int]], key: Sequence[str]
) -> dict[int, str]:
    digits = len(next(iter(places.values()))[0])
    prefix = F.substring(_HASH, 1, digits)
    aggs = []
    for i, (p, rank, _) in places.items():
        ordered = F.sort_array(F.collect_list(F.when(prefix == p, F.col(_HASH))))
        # the hash at the boundary and the one after it
        aggs.append(F.slice(ordered, rank, 2).alias(f"c{i}"))
    row = hashes.filter(prefix.isin(*{p for p, _, _ in places.values()})).agg(*aggs).first()
    found = {}
    for i in places:
        here = row[f"c{i}"]
        if len(here) == 2 and here[0] == here[1]:
            raise ValidationError(f"key {list(key)} does not tell rows apart")
        found[i] = here[0]
    return found


def expand_copies(df: DataFrame, count: str, out: str) -> DataFrame:
    """Repeat each row ``count`` times, numbered 1..count in ``out``, where
    it lies; the count column is dropped. For small counts."""
    keep = cols(c for c in df.columns if c != count)
    numbers = F.sequence(F.lit(1).cast("bigint"), col(count).cast("bigint"))
    return df.filter(col(count) > 0).select(*keep, F.explode(numbers).alias(out))


def spread_copies(df: DataFrame, count: str, out: str, total: int) -> DataFrame:
    """As ``expand_copies`` for counts of any size, ``total`` in sum.

    Rows are cut into chunks of copies, the chunks are dealt out to enough
    tasks for the total, and only then expanded: the copies of one row are
    made by many tasks, and no task makes many more than its share.
    """
    keep = cols(c for c in df.columns if c != count)
    n = col(count).cast("bigint")
    chunk = max(COPY_CHUNK, total // MOST_CHUNKS)
    start = F.explode(F.sequence(F.lit(1).cast("bigint"), n, F.lit(chunk).cast("bigint")))
    chunks = df.filter(n > 0).select(*keep, n.alias("__count"), start.alias("__start"))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(total / TASK_COPIES))
    dealt = chunks.repartition(tasks, F.xxhash64("__start", *keep))
    stop = F.least(F.col("__start") + F.lit(chunk - 1), F.col("__count"))
    return dealt.select(*keep, F.explode(F.sequence(F.col("__start"), stop)).alias(out))


def _row_keys(df: DataFrame) -> tuple[list[Column], list[Column], list[Column]]:
    """What tells rows apart: group keys, named k0, k1, ...; the columns again
    from these; and what to hash. Grouping takes -0.0 for 0.0 and hashing skips
    nulls, so signs of zeros and nulls are keys of their own."""
    keys, back, flags = [], [], []
    for i, f in enumerate(df.schema.fields):
        c = col(f.name)
        keys.append(c.alias(f"k{i}"))
        flags.append(c.isNull())
        value = F.col(f"k{i}")
        if is_fractional(f.dataType):
            negative = F.when(c == 0, c.cast("string").startswith("-")).otherwise(False)
            keys.append(negative.alias(f"z{i}"))
            flags.append(negative)
            value = F.when(F.col(f"z{i}"), F.lit(-0.0).cast(f.dataType)).otherwise(value)
        back.append(value.alias(f.name))
    return keys, back, [*cols(df.columns), *flags]


def with_copy_numbers(df: DataFrame, out: str = "copy_no") -> DataFrame:
    """Number the copies of each distinct row 1..c, so that all columns
    together with ``out`` are a key.

    Only 8-byte hashes of the rows are shuffled to find candidates for rows that
    repeat; each task sends a hash once. Rows whose hash stands alone stay where
    they lie, as copy 1. Candidates are counted by all their columns, so that
    equal hashes of different rows do no harm, and before their shuffle: a row
    that fills a third of the table is one row on the wire. The counts are
    written to the shared folder and expanded when read, rare rows in place,
    common ones spread over the cluster; the files' statistics tell the two apart.

    With more than ``BROADCAST_DIGESTS`` different hashes that repeat, all rows
    are counted that way; the result is the same.
    """
    keep_free(df.columns, [out])
    odd = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.AtomicType)]
    if odd:
        raise ValidationError(f"rows with the nested columns {odd} need an explicit key")
    keys, back, hashed = _row_keys(df)
    marked = df.withColumn(_DIGEST, F.xxhash64(*hashed))
    number = F.count(F.lit(1)).alias("__copies")
    repeated = marked.groupBy(_DIGEST).agg(number).filter("__copies > 1").select(_DIGEST)
    repeated = materialize(repeated, "repeated")
    digests = repeated.count()
    single, again = None, marked
    if digests <= BROADCAST_DIGESTS:
        single = marked.join(F.broadcast(repeated), _DIGEST, "left_anti") if digests else marked
        single = single.select(*cols(df.columns), F.lit(1).cast("bigint").alias(out))
        if not digests:
            return single
        again = marked.join(F.broadcast(repeated), _DIGEST, "left_semi")
    counted = again.groupBy(*keys).agg(number).select(*back, "__copies")
    counted = materialize(counted, "counted")
    n = F.col("__copies")
    rare = expand_copies(counted.filter(n <= RARE_COPIES), "__copies", out)
    if single is not None:
        rare = single.unionByName(rare)
    common = counted.filter(n > RARE_COPIES)
    total = common.agg(F.sum("__copies")).first()[0]
    if not total:
        return rare
    return rare.unionByName(spread_copies(common, "__copies", out, total))


def keyed(df: DataFrame, key: Sequence[str] | None) -> tuple[DataFrame, list[str], list[str]]:
    """The table, its key, and helper columns to drop again. Without a key
    the whole row with its copy number becomes one."""
    if key:
        return df, list(key), []
    helper = "__copy_no"
    numbered = with_copy_numbers(df, helper)
    return numbered, numbered.columns, [helper]


def exact_rank(
    df: DataFrame,
    key: Sequence[str],
    seed: int = SEED,
    out: str = "rank",
    by: Sequence[str] = (),
) -> DataFrame:
    """Number rows 1..n in random order; with ``by``, within each group.

    Buckets are hash prefixes, so they are even however the key looks, and a
    group that holds most rows is spread over all of them. The offsets join
    on the bucket the window already partitioned by.
    """
    hashed = df.withColumn(_HASH, row_hash(key, seed))
    return _ranked(hashed, key, out, by).select(*cols(df.columns), col(out))


def _ranked(hashed: DataFrame, ties: Sequence[str], out: str, by: Sequence[str]) -> DataFrame:
    bucketed = hashed.withColumn(_BUCKET, F.substring(_HASH, 1, BUCKET_DIGITS))
    if by:
        # as text, which is never null, so that plain equality joins all rows
        bucketed = bucketed.withColumn(_GROUP, key_text(by, prefixed=True))
    place = [_GROUP, _BUCKET] if by else [_BUCKET]
    counts = bucketed.groupBy(*place).agg(F.count(F.lit(1)).alias("__n"))
    # at most 65,536 rows per group pass through this window
    before = Window.partitionBy(_GROUP).orderBy(_BUCKET) if by else Window.orderBy(_BUCKET)
    offset = F.coalesce(F.sum("__n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(*place, offset.alias("__offset"))
    inside = Window.partitionBy(*place).orderBy(_HASH, *cols(ties))
    ranked = bucketed.withColumn("__pos", F.row_number().over(inside)).join(offsets, place)
    return ranked.select(*cols(hashed.columns), (F.col("__offset") + F.col("__pos")).cast("bigint").alias(out))


def ranked_keys(df: DataFrame, key: Sequence[str], seed: int, out: str, by: Sequence[str] = ()) -> DataFrame:
    """The ranks of ``exact_rank`` with nothing but the group and the key as its
    hash (``KEY_HASH``): what a draw needs of a wide table."""
    return _ranked(df.select(*cols(by), row_hash(key, seed).alias(_HASH)), (), out, by).select(
        *cols(by), F.unhex(_HASH).alias(KEY_HASH), col(out))


def fetch_rows(df: DataFrame, hits: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    """The rows of ``df`` whose key hash is in ``hits`` (``KEY_HASH`` and more
    columns, one row per hash), with those columns.

    Few hits are broadcast, so that no row of the table moves; otherwise the
    join shuffles the table once. ``hits`` should be a written table.
    """
    marked = df.withColumn(KEY_HASH, F.unhex(row_hash(key, seed)))
    if hits.count() <= BROADCAST_HITS:
        hits = F.broadcast(hits)
    return marked.join(hits, KEY_HASH).drop(KEY_HASH)


def shuffle(df: DataFrame, key: Sequence[str] | None = None, seed: int = SEED) -> DataFrame:
    """The table in random order, for output."""
    table, names, helpers = keyed(df, key)
    return table.orderBy(row_hash(names, seed), *cols(names)).select(*cols(df.columns))


def split_sizes(n: int, test_size: float, val_size: float) -> tuple[int, int, int]:
    """Exact sizes of train, val and test. The held-out part is rounded up,
    then its test share is; a single held-out row goes to val."""
    held_share = test_size + val_size
    held = min(math.ceil(n * held_share), n)
    if n == 0 or held >= n:
        raise ValidationError(f"{n} rows leave nothing to train on")
    if held <= 1:
        return n - held, held, 0
    test = min(math.ceil(held * (test_size / held_share)), held)
    return n - held, held - test, test


@dataclass(frozen=True)
class Splits:
    train: DataFrame
    val: DataFrame
    test: DataFrame
    sizes: Mapping[str, int]
    # the whole table with the column ``split``, for writers
    labelled: DataFrame | None = None

    def items(self) -> Iterator[tuple[str, DataFrame]]:
        return iter({"train": self.train, "val": self.val, "test": self.test}.items())


def _cut_split(
    table: DataFrame, names: Sequence[str], test_size: float, val_size: float, seed: int, rows: int | None = None
) -> tuple[str, str, dict[str, int]]:
    """The hash values at the end of train and of val, and the exact sizes."""
    sizes: dict[str, int] = {}

    def ranks(n: int) -> list[int]:
        sizes.update(zip(("train", "val", "test"), split_sizes(n, test_size, val_size), strict=True))
        return [sizes["train"], sizes["train"] + sizes["val"]]

    _, (train_end, val_end) = hash_cuts(table, names, seed, ranks, rows)
    return train_end, val_end, sizes


def split_labels(
    df: DataFrame,
    key: Sequence[str] | None = None,
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed: int = SEED,
    out: str = "split",
) -> DataFrame:
    """The table with a column that says which split each row belongs to."""
    table, names, _ = keyed(df, key)
    train_end, val_end, _ = _cut_split(table, names, test_size, val_size, seed)
    return _labelled(table, names, seed, train_end, val_end, out).select(*cols(df.columns), col(out))


def _labelled(table: DataFrame, names: Sequence[str], seed: int, train_end: str, val_end: str, out: str) -> DataFrame:
    h = F.col(_HASH)
    label = F.when(h <= train_end, "train").when(h <= val_end, "val").otherwise("test")
    return table.withColumn(_HASH, row_hash(names, seed)).select(*cols(table.columns), label.alias(out))


def train_val_test_split(
    df: DataFrame,
    key: Sequence[str] | None = None,
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed: int = SEED,
    rows: int | None = None,
) -> Splits:
    """Exact, unstratified split. Each part is a filter over the table.

    ``rows`` may state the number of rows where it is known."""
    table, names, helpers = keyed(df, key)
    train_end, val_end, sizes = _cut_split(table, names, test_size, val_size, seed, rows)
    h = row_hash(names, seed)
    return Splits(
        train=table.filter(h <= train_end).drop(*helpers),
        val=table.filter((h > train_end) & (h <= val_end)).drop(*helpers),
        test=table.filter(h > val_end).drop(*helpers),
        sizes=sizes,
        labelled=None if "split" in df.columns else _labelled(
            table, names, seed, train_end, val_end, "split").drop(*helpers),
    )


def cap_rows(
    df: DataFrame, n: int, key: Sequence[str] | None = None, seed: int = SEED
) -> DataFrame:
    """At most ``n`` rows, drawn without replacement."""
    table, names, helpers = keyed(df, key)
    _, (cut,) = hash_cuts(table, names, seed, lambda _: [n])
    return table.filter(row_hash(names, seed) <= cut).drop(*helpers)


def draw_with_replacement(
    df: DataFrame, n: int, key: Sequence[str], seed: int = SEED, out: str = "draw_no"
) -> DataFrame:
    """Exactly ``n`` draws from the table. A row drawn m times appears m
    times, numbered 1..m in ``out``."""
    size = df.count()
    if n and not size:
        raise ValidationError("there are no rows to draw from")
    require_columns(df, key)
    ranked = ranked_keys(df, key, seed, "__rank")
    i = F.col("id").cast("string")
    rank = F.pmod(hash60(F.concat(F.lit(f"{int(seed)}:"), i)), F.lit(max(size, 1)).cast("bigint")) + 1
    draws = df.sparkSession.range(1, n + 1).groupBy(rank.alias("__drawn")).agg(F.count(F.lit(1)).alias("__m"))
    hits = ranked.join(draws, F.col("__rank") == F.col("__drawn")).drop("__rank", "__drawn")
    return expand_draws(fetch_rows(df, materialize(hits, "hits"), key, seed), "__m", out, n, size)


def expand_draws(
    hits: DataFrame, count: str, out: str, n: int, size: int, total: int | None = None
) -> DataFrame:
    """Make the copies of rows hit by ``n`` even draws from ``size`` rows, of
    ``total`` draws in all (``n`` by default)."""
    if n <= size * RARE_COPIES:
        return expand_copies(hits, count, out)
    return spread_copies(hits, count, out, n if total is None else total)
