"""Benchmark decontamination by a prefix-filtered set join.

Every window of an item (13 consecutive words, or all words of a shorter item)
is a set of word shingles at fixed offsets. Shingles are ordered by how often
they occur in all documents. A text can hold a window only if it holds the
window's rarest shingle, so that one is the whole prefix: windows are indexed by
it. Documents look up their shingles in the index; a match fetches its windows
with their offsets, those that would start before or end after the text are
dropped, and what is left is compared word by word.

The index is made from items, not from documents. It is cut into blocks of a
stated size, each is broadcast on its own, so a benchmark of any size runs in
bounded memory, with one pass over the documents per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.texts import (
    ALNUM, WORD_BLOCK, Shared, blocks, carrying, checked, map_batches, pick, shingles, spans, words,
)

WINDOW, SHINGLE = 13, 3
#: Characters of items in one broadcast index.
ITEM_CHARS = 16_000_000
HIT_SHARE = 20


class _Windows:
    """The distinct windows of a block of items, and the items that hold each."""

    def __init__(self, ids: Sequence, hashes: np.ndarray, first: np.ndarray, window: int, shingle: int):
        runs, owners = [], []
        n_words = np.diff(first)
        for item, (a, n) in enumerate(zip(first, n_words)):
            k = min(window, n)
            if k:
                at = np.arange(a, a + n - k + 1)
                block = np.zeros((len(at), window), np.uint64)
                block[:, :k] = hashes[at[:, None] + np.arange(k)]
                runs.append(block)
                owners.append(np.stack([np.full(len(at), item), np.full(len(at), k)], 1))
        self.ids = np.array(ids, dtype=object)
        if not runs:
            self.lengths = np.zeros(0, np.int64)
            self.parts: dict[int, np.ndarray] = {}
            return
        table, owner = np.concatenate(runs), np.concatenate(owners)
        full = np.concatenate([table, owner[:, 1:].astype(np.uint64)], 1)
        kept, of = np.unique(full, axis=0, return_inverse=True)
        self.table, self.lengths = kept[:, :-1], kept[:, -1].astype(np.int64)
        pairs = np.unique(np.stack([of.ravel(), owner[:, 0]], 1), axis=0)
        self.items = pairs[:, 1]
        self.item_at = np.searchsorted(pairs[:, 0], np.arange(len(kept) + 1))
        #: per shingle length: (shingle, window, offset) rows, shingles sorted
        self.parts = {}
        for k in range(1, shingle + 1):
            mine = np.flatnonzero(self.lengths == k if k < shingle else self.lengths >= k)
            if not len(mine):
                continue
            n = self.lengths[mine]
            flat = self.table[np.repeat(mine, n), spans(np.zeros(len(n), np.int64), n)]
            starts = np.concatenate([[0], np.cumsum(n)])
            found, at = shingles(flat, starts, k)
            row = np.searchsorted(starts, at, "right") - 1
            self.parts[k] = np.rec.fromarrays(
                [found, mine[row], at - starts[row]], names="shingle,window,offset")

    def shingles_of(self) -> dict[int, np.ndarray]:
        return {k: np.unique(p.shingle) for k, p in self.parts.items()}


class _Index:
    """Windows by their rarest shingle."""

    def __init__(self, windows: _Windows, counts: dict[int, np.ndarray]):
        self.windows, self.lists = windows, {}
        for k, part in windows.parts.items():
            names = np.unique(part.shingle)
            often = counts[k][np.searchsorted(names, part.shingle)]
            order = np.lexsort((part.offset, part.shingle, often, part.window))
            _, rarest = np.unique(part.window[order], return_index=True)
            chosen = part[order[rarest]]
            chosen = chosen[np.argsort(chosen.shingle, kind="stable")]
            keys = np.unique(chosen.shingle)
            at = np.searchsorted(chosen.shingle, keys)
            self.lists[k] = (_Finder(keys), at, np.append(at[1:], len(chosen)) - at,
                             np.asarray(chosen.window), np.asarray(chosen.offset))

    def hits(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words of all occurrences of windows, and which windows."""
        starts, which = [], []
        for k, (finder, at, n, window, offset) in self.lists.items():
            found, place = shingles(hashes, first, k)
            hit, key = finder(found)
            place = place[hit]
            rows = spans(at[key], n[key])
            place = np.repeat(place, n[key])
            w = window[rows]
            begin = place - offset[rows]
            text = np.searchsorted(first, place, "right") - 1
            end = begin + self.windows.lengths[w]
            fits = (begin >= first[text]) & (end <= first[text + 1])  # position and length
            begin, w = begin[fits], w[fits]
            for j in range(self.windows.table.shape[1]):  # word by word
                if not len(w):
                    break
                inside = j < self.windows.lengths[w]
                place_j = np.minimum(begin + j, len(hashes) - 1)
                same = ~inside | (hashes[place_j] == self.windows.table[w, j])
                begin, w = begin[same], w[same]
            starts.append(begin)
            which.append(w)
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(which)


class _Finder:
    """Looks numbers up in a sorted array, most misses by a table of leading bits."""

    def __init__(self, keys: np.ndarray, bits: int = 20):
        self.keys, self.shift = keys, np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[keys >> self.shift] = True

    def __call__(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.seen[values >> self.shift])
        key = np.searchsorted(self.keys, values[at])
        same = self.keys[np.minimum(key, len(self.keys) - 1)] == values[at]
        return at[same], key[same]


def _counts(docs: DataFrame, named: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """How often each shingle of the items occurs in all documents."""
    shared = Shared(docs.sparkSession, {k: _Finder(v) for k, v in named.items()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums = {k: np.zeros(len(f.keys), np.int64) for k, f in shared.value.items()}
        for _, data, offsets in blocks(batches, size=WORD_BLOCK):
            hashes, first, _ = words(data, offsets, ALNUM)
            for k, finder in shared.value.items():
                key = finder(shingles(hashes, first, k)[0])[1]
                sums[k] += np.bincount(key, minlength=len(finder.keys))
        for k, total in sums.items():
            at = np.flatnonzero(total)
            yield {"size": np.full(len(at), k, np.int32), "shingle": at, "n": total[at]}

    rows = map_batches(docs, count, "size int, shingle long, n long")
    out = {k: np.zeros(len(v), np.int64) for k, v in named.items()}
    for r in rows.groupBy("size", "shingle").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["size"]][r["shingle"]] = r["n"]
    return out


def _digest(ids: Sequence) -> str:
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


def _hashed(items: DataFrame) -> DataFrame:
    """Items (item_id, text) with the hashes of their words in place of their
    text, one after another as bytes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, data, offsets in blocks(batches, size=WORD_BLOCK):
            hashes, first, _ = words(data, offsets, ALNUM)
            yield {"item_id": batch.column("item_id"),
                   "words": [hashes[a:b].tobytes() for a, b in zip(first, first[1:])]}

    return map_batches(items, read, carrying(items, ["item_id"], "words binary"))


def _pass(docs: DataFrame, carry: Sequence[str], items: list, window: int, shingle: int) -> DataFrame:
    """One block of items: per document its words, hit ranges and items."""
    hashes = np.frombuffer(b"".join(r["words"] for r in items), np.uint64)
    first = np.concatenate([[0], np.cumsum([len(r["words"]) // 8 for r in items], dtype=np.int64)]).astype(np.int64)
    found = _Windows([r["item_id"] for r in items], hashes, first, window, shingle)
    counts = _counts(docs.select("text"), found.shingles_of()) if found.parts else {}
    index = Shared(docs.sparkSession, _Index(found, counts))
    schema = carrying(docs, carry, "n_words long, hit_from array<long>, hit_to array<long>, items array<string>")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, data, offsets in blocks(batches, size=WORD_BLOCK):
            hashes, first, _ = words(data, offsets, ALNUM)
            begin, w = index.value.hits(hashes, first)
            n = len(offsets) - 1
            ranges: list[list] = [[[], []] for _ in range(n)]
            names: list[list] = [[] for _ in range(n)]
            if len(w):
                windows = index.value.windows
                text = np.searchsorted(first, begin, "right") - 1
                cover = np.zeros(len(hashes) + 1, np.int32)
                np.add.at(cover, begin, 1)
                np.add.at(cover, begin + windows.lengths[w], -1)
                hit = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
                own = np.zeros(len(hit), bool)  # ranges do not run on into the next text
                own[first] = True
                lows = np.flatnonzero(hit[1:-1] & (~hit[:-2] | own[:-2]))
                highs = np.flatnonzero(hit[1:-1] & (~hit[2:] | own[1:-1])) + 1
                for t, a, b in zip(np.searchsorted(first, lows, "right") - 1, lows, highs):
                    ranges[t][0].append(a - first[t])
                    ranges[t][1].append(b - first[t])
                pairs = np.unique(np.stack([text, w], 1), axis=0)
                size = windows.item_at[pairs[:, 1] + 1] - windows.item_at[pairs[:, 1]]
                owned = np.unique(np.stack([np.repeat(pairs[:, 0], size), windows.items[
                    spans(windows.item_at[pairs[:, 1]], size)]], 1), axis=0)
                for t, item in owned:
                    names[t].append(str(windows.ids[item]))
            yield {c: batch.column(c) for c in carry} | {
                "n_words": np.diff(first),
                "hit_from": pa.array([r[0] for r in ranges], pa.list_(pa.int64())),
                "hit_to": pa.array([r[1] for r in ranges], pa.list_(pa.int64())),
                "items": pa.array([sorted(set(x)) for x in names], pa.list_(pa.string())),
            }

    return map_batches(docs, scan, schema)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, carry: Sequence[str] = ("doc_id",), window: int = WINDOW,
    shingle: int = SHINGLE, hit_share: int = HIT_SHARE, item_chars: int = ITEM_CHARS,
) -> DataFrame:
    """Find passages of ``benchmark`` (item_id, text) in ``docs`` (text).

    Words are runs of letters, digits and non-ASCII characters with A-Z
    lower-cased. Returns one row per document: the ``carry`` columns, n_words,
    n_hit (words inside any window), n_items, items_sha256 (of the item ids,
    sorted as strings, comma-joined) and contaminated
    (``n_hit > 0 and hit_share * n_hit >= n_words``).

    Null or empty texts have no words and are clean; items without words match
    nothing; a null item id counts as the text 'None'; items that repeat an id
    are one item; repeated documents each get a row; an empty benchmark leaves
    all clean; other columns of either table are ignored.
    """
    checked(carry, {"n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_from", "hit_to", "items"})
    docs = pick(docs, *dict.fromkeys([*carry, "text"])).withColumn("__text", F.xxhash64("text"))
    items = pick(benchmark, "item_id", "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-chars // item_chars) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    passes = [
        _pass(docs, [*carry, "__text"], _hashed(items.where(block == b)).collect(), window, shingle) for b in range(parts)
    ]
    if parts == 1:
        rows = passes[0].withColumn("hits", F.arrays_zip("hit_from", "hit_to"))
    else:  # the same documents in each pass; equal rows get equal results
        whole = passes[0]
        for one in passes[1:]:
            whole = whole.unionByName(one)
        keys = [*carry, "__text", "n_words"]
        rows = whole.groupBy(*keys).agg(
            F.flatten(F.collect_set(F.arrays_zip("hit_from", "hit_to"))).alias("hits"),
            F.flatten(F.collect_set("items")).alias("items"), F.count("*").alias("__n"))
        rows = rows.withColumn("__n", F.explode(F.sequence(F.lit(1), (F.col("__n") / parts).cast("int"))))
    # union of ranges: walk them by start, add what reaches beyond the end so far
    ordered = F.array_sort("hits")
    covered = F.aggregate(
        ordered, F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, r: F.struct(
            F.greatest(s["end"], r["hit_to"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0).cast("long"), r["hit_to"] - F.greatest(s["end"], r["hit_from"]))).alias("n")),
        lambda s: s["n"])
    rows = rows.withColumn("n_hit", covered).withColumn("items", F.array_sort(F.array_distinct("items")))
    return rows.select(
        *carry, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (hit_share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
