"""Byte-level BPE encoding and decoding by a two-tier lookup.

A pre-token that is a vocabulary entry as a whole is resolved by a minimal
perfect hash: one hash, one displacement, one comparison. All others start as
linked bytes; a heap hands out the adjacent pair of the lowest rank, the leftmost
of equals, until no pair has a rank. Results are kept per worker for ``MEMO``
pre-tokens; when they are full they grow old, and what is not asked for again
until the next ones are full is forgotten.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from evenkeel.llm.texts import Shared, blocks, carrying, checked, map_batches, pick, texts_of

MEMO = 500_000
_PART = 1 << 20
#: Formats of few ids as little-endian 32-bit numbers.
_FORMATS = [f"<{n}I" for n in range(24)]


def read_ranks(path: str) -> dict[bytes, int]:
    """The entries of a rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """A minimal perfect hash of byte strings to numbers.

    Keys fall into buckets; from the largest on, each bucket gets the first
    displacement that puts its keys on free slots. A bucket of one key names
    its slot outright, as a negative displacement.
    """

    def __init__(self, entries: dict[bytes, int]):
        n = self.n = len(entries)
        self.buckets = max(1, n // 3)
        grouped: dict[int, list[tuple[int, bytes]]] = {}
        for key in entries:
            h = xxhash.xxh3_64_intdigest(key)
            grouped.setdefault(h % self.buckets, []).append((h, key))
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * n
        self.values = [0] * n
        ordered = sorted(grouped.items(), key=lambda g: (-len(g[1]), g[0]))
        free = None
        for bucket, held in ordered:
            if len(held) == 1:
                free = free or iter([i for i, k in enumerate(self.keys) if k is None])
                slots, d = [next(free)], None
                self.shift[bucket] = -1 - slots[0]
            else:
                d, slots = 0, []
                while len(set(slots)) < len(held) or any(self.keys[s] is not None for s in slots):
                    d += 1
                    slots = [self._slot(h, d) for h, _ in held]
                self.shift[bucket] = d
            for slot, (_, key) in zip(slots, held):
                self.keys[slot], self.values[slot] = key, entries[key]

    def _slot(self, h: int, d: int) -> int:
        return ((h ^ d * 0x9E3779B97F4A7C15) * 0xD6E8FEB86659FD93 >> 32 & 0xFFFFFFFF) % self.n

    def get(self, key: bytes) -> int | None:
        if not self.n:
            return None
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        slot = -1 - d if d < 0 else self._slot(h, d)
        return self.values[slot] if self.keys[slot] == key else None


class Encoder(dict):
    """Pre-token -> its ids as little-endian 32-bit numbers; fills itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, known: PerfectHash | None = None):
        super().__init__()
        self.hash = known or PerfectHash(ranks)
        self.ranks, self.tokens = ranks, {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.single = [ranks.get(bytes([b])) for b in range(256)]
        # for each entry, what it makes with the entry that follows
        none: dict[int, int] = {}
        follows = [none] * (max(ranks.values(), default=0) + 1)
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                first, second = ranks.get(token[:i]), ranks.get(token[i:])
                if first is not None and second is not None:
                    if follows[first] is none:
                        follows[first] = {}
                    follows[first][second] = rank
        self.made = [f.get for f in follows]
        self.old: dict[str, bytes] = {}

    def __reduce__(self):
        return Encoder, (self.ranks, self.pattern.pattern, self.hash)

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            data = piece.encode()
            whole = self.hash.get(data)
            ids = [whole] if whole is not None else self.merge(data)
            out = struct.pack(_FORMATS[len(ids)], *ids) if len(ids) < len(_FORMATS) else np.array(ids, "<u4").tobytes()
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[piece] = out
        return out

    def merge(self, data: bytes) -> list[int]:
        """A heap over linked bytes. Its entries are ranks with the place of the
        pair below; one is out of date if the place has another rank by now."""
        made, n = self.made, len(data)
        ids = [self.single[b] for b in data]
        if n == 2:
            return ids  # the pair is no entry, or it had been found
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        now = [made[a](b) for a, b in zip(ids, ids[1:])]
        now.append(None)
        heap = [rank << 32 | i for i, rank in enumerate(now) if rank is not None]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i, whole = entry & 0xFFFFFFFF, entry >> 32
            if now[i] != whole:
                continue
            j = after[i]
            ids[i], ids[j], now[j] = whole, None, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                now[i] = rank = made[whole](ids[k])
                if rank is not None:
                    heappush(heap, rank << 32 | i)
            else:
                now[i] = None
            k = before[i]
            if k >= 0:
                now[k] = rank = made[ids[k]](whole)
                if rank is not None:
                    heappush(heap, rank << 32 | k)
        return [x for x in ids if x is not None]

    def encode(self, text: str) -> bytes:
        """Ids of a text; long texts are split piece by piece, not all at once."""
        if len(text) <= _PART:
            return b"".join(map(self.__getitem__, self.pattern.findall(text)))
        return b"".join(self[m.group()] for m in self.pattern.finditer(text))

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, carry: Sequence[str] = ("doc_id",), digests: bool = False
) -> DataFrame:
    """Encode ``docs`` (text); returns the ``carry`` columns, n_tokens and ids.

    With ``digests`` the ids are decoded again, and instead of ids come
    ids_sha256 (of the ids as little-endian unsigned 32-bit integers) and
    decoded_sha256 (of the decoded bytes).

    Each match of ``pattern`` is encoded on its own, without special tokens;
    what it does not match is left out. Null and empty texts have no tokens.
    The vocabulary is broadcast; its size is that of a file.
    """
    checked(carry, {"n_tokens", "ids", "ids_sha256", "decoded_sha256"})
    docs = pick(docs, *dict.fromkeys([*carry, "text"]))
    shared = Shared(docs.sparkSession, Encoder(ranks, pattern))
    results = "n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        coder = shared.value
        for batch, _, _ in blocks(batches):
            coded = [coder.encode(t) for t in texts_of(batch.column("text").to_pylist())]
            out = {c: batch.column(c) for c in carry} | {"n_tokens": np.array([len(c) // 4 for c in coded], np.int64)}
            ids = [np.frombuffer(c, "<u4") for c in coded]
            if digests:
                out["ids_sha256"] = [hashlib.sha256(c).hexdigest() for c in coded]
                out["decoded_sha256"] = [hashlib.sha256(coder.decode(i.tolist())).hexdigest() for i in ids]
            else:
                out["ids"] = pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))
            yield out

    return map_batches(docs, run, carrying(docs, carry, results))


def decode(rows: DataFrame, ranks: dict[bytes, int], carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Decode ``rows`` (ids) to bytes: the ``carry`` columns and ``decoded``.

    Null and empty id lists give no bytes; an unknown id is an error.
    """
    checked(carry, {"decoded"})
    rows = pick(rows, *dict.fromkeys([*carry, "ids"]))
    tokens = Shared(rows.sparkSession, {rank: token for token, rank in ranks.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {c: batch.column(c) for c in carry} | {"decoded": pa.array(
                [b"".join(map(tokens.value.__getitem__, i or ())) for i in batch.column("ids").to_pylist()], pa.binary())}

    return map_batches(rows, run, carrying(rows, carry, "decoded binary"))
