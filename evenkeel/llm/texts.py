"""Helpers that the operators on texts share.

Texts reach Python tasks as Arrow batches. They are worked on in blocks of
about a million bytes, so memory does not follow the size of a batch; only a
single longer text makes a larger block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BLOCK_BYTES = 1 << 20
#: Of blocks that words are read from, which take some 60 bytes for one of text.
WORD_BLOCK = 1 << 18
#: Bytes of the batches that Python tasks get, in place of Spark's 64 MB.
BATCH_BYTES = 2 << 20
#: Bits of a table of marks, 8 MB.
MARKS = 1 << 26
#: Multipliers and salts of the hashes; any odd numbers would do.
_P = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SALTS = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]
#: A second hash is taken modulo a prime, 2^31 - 1, where powers do not vanish.
_BITS = np.uint64(31)
_PRIME = np.uint64((1 << 31) - 1)
_BASE = 1_292_530_417
_PRIME_SALTS = np.random.Generator(np.random.PCG64(31)).integers(1, int(_PRIME), 256, dtype=np.uint64)[_LOWER]

#: Bytes of a word: all but white space / letters, digits and all non-ASCII.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, also where other columns differ only in case or
    repeat a name (the first one of exactly that name counts)."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"c{df.columns.index(n)}").alias(n) for n in names])


def fold(key: str, parts: int) -> Column:
    """The fold of a row, from the CRC of its id as text; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after another, and where each begins."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][: len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = offsets[0] if len(offsets) else 0
    return flat[first: offsets[-1] if len(offsets) else 0], offsets - first


def blocks(
    batches: Iterable[pa.RecordBatch], text: str = "text", size: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut into blocks of some ``size`` bytes of text, with their
    bytes and the n + 1 offsets of their texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, at = as_bytes(batch.column(batch.schema.get_field_index(text)))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(at, at[low] + size, "right")) - 1)
            yield batch.slice(low, high - low), data[at[low]: at[high]], at[low: high + 1] - at[low]
            low = high


def checked(carry: Sequence[str], own: set[str]) -> None:
    """Columns that are carried along may not be named like results."""
    if clash := set(carry) & own:
        raise ValueError(f"cannot carry columns named like results: {sorted(clash)}")


def carrying(df: DataFrame, carry: Sequence[str], results: str) -> T.StructType:
    """The schema of carried columns and results."""
    return T.StructType([df.schema[c] for c in carry] + T.StructType.fromDDL(results).fields)


def map_batches(df: DataFrame, fn: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` of a function from batches to dicts of columns.

    A batch lies in memory several times, in the JVM and in Python, so sessions
    that keep Spark's own bound on its bytes get a smaller one.
    """
    conf, bound = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(bound).rstrip("b") == str(64 << 20):
        conf.set(bound, f"{BATCH_BYTES}b")
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = {f.name: f.type for f in to_arrow_schema(schema)}

    def column(values, kind: pa.DataType) -> pa.Array:
        values = values if isinstance(values, pa.Array) else pa.array(values)
        return values if values.type == kind or pa.types.is_timestamp(kind) else values.cast(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays([column(columns[n], k) for n, k in kinds.items()], list(kinds))

    return df.mapInArrow(run, schema)


def ragged(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """A list column from its values one after another and the lengths."""
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(32))) * _M
    h = (h ^ (h >> np.uint64(29))) * _P
    return h ^ (h >> np.uint64(32))


class _Kept(dict):
    """Tables that a process makes for itself; they are never sent along with
    the functions that use them."""

    def __reduce__(self):
        return _Kept, ()


_kept = _Kept()


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse."""
    if len(_kept.get("powers", ((),))[0]) < max(n, 1):
        size = max(1 << max(n - 1, 0).bit_length(), WORD_BLOCK)
        steps = np.full(size, _P), np.full(size, np.uint64(pow(int(_P), -1, 2**64)))
        for s in steps:
            s[0] = 1
        _kept["powers"] = tuple(np.cumprod(s, dtype=np.uint64) for s in steps)
    return _kept["powers"]


def _prime_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a number and of its inverse modulo the prime."""
    if len(_kept.get("primes", ((),))[0]) < max(n, 1):
        out = []
        for base in (_BASE, pow(_BASE, -1, int(_PRIME))):
            powers = np.ones(1, np.uint64)
            while len(powers) < max(n, WORD_BLOCK):
                powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), int(_PRIME))) % _PRIME])
            out.append(powers)
        _kept["primes"] = tuple(out)
    return _kept["primes"]


def _partly(x: np.ndarray) -> np.ndarray:
    """A number that is equal modulo the prime and below 2^34, if ``x`` is below 2^64.
    It takes the place of ``x``."""
    high = x >> _BITS
    x &= _PRIME
    x += high
    return x


def words(
    data: np.ndarray, offsets: np.ndarray, member: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts: a 64-bit hash of each with A-Z lower-cased, the
    number of the first word of each text (n + 1), and where words begin.

    A word is a longest run of ``member`` bytes. Equal words have equal hashes
    wherever they stand: the hash is the sum of salted bytes times powers of an
    odd number, divided by the power of the position. Alone, such a sum modulo 2^64
    is equal for words that can be written down whatever the number (Thue and
    Morse's and its complement), so a second sum, modulo a prime, is mixed in.
    """
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = member[data]
    head = np.zeros(n + 1, bool)
    head[offsets] = True
    begins = np.flatnonzero(inside[1:-1] & (~inside[:-2] | head[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | head[1:])) + 1
    power, inverse = _tables(n)
    total, terms = np.zeros(n + 1, np.uint64), _SALTS[data]
    terms *= power[:n]
    np.cumsum(terms, out=total[1:])
    hashes = (total[ends] - total[begins]) * inverse[begins]
    power, inverse = _prime_tables(n)
    np.take(_PRIME_SALTS, data, out=terms, mode="clip")  # bytes are in range; other modes copy
    terms *= power[:n]
    np.cumsum(_partly(terms), out=total[1:])  # 2^30 bytes of text fit
    second = _partly(_partly(total[ends] - total[begins])) % _PRIME * inverse[begins] % _PRIME
    return mixed(hashes ^ mixed(second)), np.searchsorted(begins, offsets), begins


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a text, and the numbers of
    the words that they begin with."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = hashes[:n].copy()
    for j in range(1, size):
        h *= _M
        h += hashes[j: n + j]
    fits = np.ones(n, bool)
    for j in range(1, size):  # a run that holds the first word of a later text
        cut = first[1:-1] - j
        fits[cut[(cut >= 0) & (cut < n)]] = False
    at = np.flatnonzero(fits)
    return mixed(h[at] + np.uint64(size)), at


def spans(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... (count[0] of them), begin[1], ..."""
    ends = np.cumsum(count)
    out = np.arange(ends[-1] if len(ends) else 0)
    return out + np.repeat(begin - (ends - count), count)


def texts_of(values: Sequence) -> list[str]:
    return ["" if v is None else v for v in values]


class Shared:
    """A broadcast of any object; executors load it once per worker process.

    A worker keeps the one it used last: before it loads another, it lets go of
    the objects of all others, which can be loaded again. The bytes go once the
    object is made. Callers state why the size is bounded.
    """

    def __init__(self, spark: SparkSession, value):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if not hasattr(self.sent, "loaded"):
            # by name: a registry that came along with this class would be an empty copy
            from pyspark.core.broadcast import _broadcastRegistry

            for other in list(_broadcastRegistry.values()):
                other.__dict__.pop("loaded", None)
            self.sent.loaded = cloudpickle.loads(self.sent.value)
            for other in list(_broadcastRegistry.values()):
                if getattr(other, "_path", None) is not None:  # in a worker, where values lie in files
                    other.__dict__.pop("_value", None)
        return self.sent.loaded


class Marks:
    """Marks of 64-bit hashes in a bitmap that is sent to all tasks, of 64 bits
    a hash and MARKS bits at most.

    Every hash of ``column`` hits its mark; others do by chance, so hits are
    checked by a join.
    """

    def __init__(self, hashes: DataFrame, column: str):
        self.size = min(MARKS, 1 << max(16, (64 * hashes.count()).bit_length()))
        spot = F.pmod(F.col(column), F.lit(self.size)) + 1  # positions are numbered from 1
        bits = hashes.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
        table = np.zeros(self.size // 8, np.uint8)
        for r in bits.collect():
            part = np.frombuffer(bytes(r["bits"]), np.uint8)
            table[(r["bucket"] - 1) * len(part):][: len(part)] = part
        self.sent = Shared(hashes.sparkSession, table)

    def hit(self, hashes: np.ndarray) -> np.ndarray:
        at = np.mod(hashes, self.size)
        return (self.sent.value[at >> 3] >> (at & 7) & 1).astype(bool)

    def hits(self, column: str) -> Column:
        """Whether a column of hashes hits a mark."""
        marks = self

        @F.pandas_udf("boolean")
        def hit(hashes: pd.Series) -> pd.Series:
            return pd.Series(marks.hit(hashes.to_numpy()))

        return hit(column)


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters of texts as numbers, and where each text begins."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), total[offsets]


def _folded() -> np.ndarray:
    """The lower-case letter of each character, a space for all others. There
    are no letters beyond the third plane."""
    if "folded" not in _kept:
        table = np.full(0x110000, 32, np.uint32)
        for c in [c for c in range(0x40000) if chr(c).isalpha()]:
            table[c] = ord(chr(c).lower()[0])
        _kept["folded"] = table
    return _kept["folded"]


def letters(data: np.ndarray, offsets: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts as lower-case letters with one space for each run of anything
    else, after ``pad`` spaces and before one; and where each text begins."""
    points, at = code_points(data, offsets)
    chars = _folded()[points]
    n = len(at) - 1
    blank = chars == 32
    keep = np.ones(len(chars), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    head = at[:-1][at[:-1] < at[1:]]
    keep[head] = ~blank[head]  # a text starts after its padding
    last = at[1:][at[:-1] < at[1:]] - 1
    keep[last] &= ~blank[last]
    kept = np.zeros(len(chars) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    size = kept[at[1:]] - kept[at[:-1]]
    begin = np.zeros(n + 1, np.int64)
    np.cumsum(size + pad + 1, out=begin[1:])
    out = np.full(begin[-1], 32, np.uint32)
    out[spans(begin[:-1] + pad, size)] = chars[keep]
    return out, begin


def grams(chars: np.ndarray, order: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the ``order`` characters from each place on that has so many,
    or from the places ``at`` on."""
    n = len(chars) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n if at is None else len(at), order, np.uint64)
    for j in range(order):
        h *= _M
        h += chars[j: n + j] if at is None else chars[at + j]
    return mixed(h)
