"""Merkle manifest of a table, its leaves placed by bitmap ranks.

A leaf is the digest of a row. Within its group (a language) leaves ascend by
id, yet nothing is sorted: every task makes compressed bitmaps of the ids that it
holds, as the non-empty 64-bit words of chunks of ``1 << CHUNK`` ids. Bitmaps of
a chunk are merged, and the number of rows in each chunk gives a directory of
offsets, added up level by level, so that no window holds more than ``1 << FAN``
of them. The place of a leaf is then a rank query: the offset of its chunk, the
popcounts of the words before its own, and those of the bits below.

Ids that several rows share are found by the popcounts falling short of the
rows; such rows are placed by their digest among those of the id.

Places are the keys that levels are reduced by: ``1 << LEVELS`` consecutive
nodes are put in the slots of one array each and make one node of the next
round, so that a table of n rows takes log(n) / ``LEVELS`` rounds. Paths go down
the same way, from the root to the blocks of leaves.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evenkeel.llm.texts import map_batches, pick, ragged
from evenkeel.operators.sampling import spread_copies
from evenkeel.sources.shared import materialize

CHUNK, FAN, LEVELS = 12, 18, 10
#: Rows that one Python task group should get; groups are dealt by hash.
CELL_ROWS = 1 << 15
#: Rows that a task keeps before it sends their bitmaps on.
HELD = 1 << 20
#: The chunk of rows without an id: before all others.
NO_ID = -(1 << 52)
_SLOTS = 1 << LEVELS


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _part(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """tree, chunk, low, doc_id, leaf and, where ``tampered``, the other leaf."""
    docs = pick(docs, "doc_id", "source", "lang", "n_chars", "text").withColumn("doc_id", F.col("doc_id").cast("long"))

    def leaf(n_chars: Column) -> Column:
        columns = [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
        return F.sha2(F.concat(*[_part(c) for c in columns]).cast("binary"), 256)

    more = F.col("n_chars").cast("decimal(38,0)") + 1
    changed = F.coalesce(tampered, F.lit(False)) & F.col("n_chars").isNotNull()
    return docs.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
        F.coalesce(F.shiftright("doc_id", CHUNK), F.lit(NO_ID)).alias("chunk"),
        F.coalesce(F.col("doc_id").bitwiseAND((1 << CHUNK) - 1), F.lit(0)).cast("int").alias("low"),
        "doc_id", leaf(F.col("n_chars")).alias("leaf"), F.when(changed, leaf(more)).alias("other"))


def _cell(cells: int, *keys: Column | str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(cells)).cast("int")


def _codes(*columns: pa.Array) -> np.ndarray:
    """A number for each different row of some columns."""
    code = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        values = pc.dictionary_encode(column)
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        size = max(len(values.dictionary), 1)
        code = np.unique(code * size + values.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    return code


def _merged(code: np.ndarray, words: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of each code, equal ones united: codes, words, bits."""
    key, at = np.unique(code * 64 + words, return_inverse=True)
    out = np.zeros(len(key), np.uint64)
    np.bitwise_or.at(out, at, bits)
    return key >> 6, key & 63, out


def _bitmaps(leaves: DataFrame, cells: int) -> DataFrame:
    """tree, chunk, words, bits, n (rows), ids: a compressed bitmap per chunk."""

    def of_task(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        held, size = [], 0

        def made() -> dict:
            table = pa.Table.from_batches(held)
            code = _codes(table.column("tree"), table.column("chunk"))
            first = np.unique(code, return_index=True)[1]
            low = table.column("low").to_numpy().astype(np.int64)
            which, words, bits = _merged(code, low >> 6, np.uint64(1) << (low & 63).astype(np.uint64))
            sizes = np.bincount(which, minlength=len(first))
            return {
                "tree": table.column("tree").combine_chunks().take(pa.array(first)),
                "chunk": table.column("chunk").to_numpy()[first],
                "words": ragged(words.astype(np.int8), sizes), "bits": ragged(bits.view(np.int64), sizes),
                "n": np.bincount(code, minlength=len(first)),
            }

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= HELD:
                yield made()
                held, size = [], 0
        if size:
            yield made()

    def merge(table: pa.Table) -> pa.Table:
        code = _codes(table.column("tree"), table.column("chunk"))
        first = np.unique(code, return_index=True)[1]
        words = table.column("words").combine_chunks()
        flat = words.flatten().to_numpy().astype(np.int64)
        bits = table.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64)
        which, words, bits = _merged(np.repeat(code, np.diff(words.offsets.to_numpy())), flat, bits)
        sizes = np.bincount(which, minlength=len(first))
        return pa.table({
            "tree": table.column("tree").take(pa.array(first)), "chunk": table.column("chunk").take(pa.array(first)),
            "words": ragged(words.astype(np.int8), sizes), "bits": ragged(bits.view(np.int64), sizes),
            "n": np.bincount(code, weights=table.column("n").to_numpy(), minlength=len(first)).astype(np.int64),
            "ids": np.bincount(which, weights=np.bitwise_count(bits), minlength=len(first)).astype(np.int64),
        })

    kind = "tree string, chunk long, words array<tinyint>, bits array<long>, n long"
    parts = map_batches(leaves.select("tree", "chunk", "low"), of_task, kind)
    return parts.groupBy(_cell(cells, "tree", "chunk").alias("cell")).applyInArrow(merge, f"{kind}, ids long")


def _offsets(sizes: DataFrame, levels: int = 3) -> DataFrame:
    """(tree, key, before): how many rows lie under smaller keys of the tree.

    ``sizes``: tree, key, n. Keys share parents of ``1 << FAN`` keys; what lies
    under smaller parents is found the same way. After three levels of the 53
    bits of a chunk only a sign is left.
    """
    if not levels:
        inside = W.partitionBy("tree").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
        return sizes.select("tree", "key", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("before"))
    inside = W.partitionBy("tree", "up").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    rows = sizes.withColumn("up", F.shiftright("key", FAN))
    inner = rows.select("tree", "up", "key", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("inner"))
    parents = rows.groupBy("tree", F.col("up").alias("key")).agg(F.sum("n").alias("n"))
    outer = _offsets(parents, levels - 1).select("tree", F.col("key").alias("up"), "before")
    return inner.join(outer, ["tree", "up"]).select("tree", "key", (F.col("inner") + F.col("before")).alias("before"))


def _ranked(rows: DataFrame, bitmaps: DataFrame, cells: int) -> DataFrame:
    """Rank queries: ``rows`` (tree, chunk, low, doc_id, leaf, other) with their
    place ``pos`` in the tree and the ``total`` of its rows.

    ``bitmaps`` carry the offset of the chunk, and ids in it with ``more`` rows
    than one, which later ids come after.
    """

    def query(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        same = {c: left.column(c) for c in ("tree", "doc_id", "leaf", "other", "low", "chunk")}
        if not n:
            return pa.table({**same, "pos": same["chunk"], "total": same["chunk"]})
        code = _codes(*[pa.chunked_array([*left.column(c).chunks, *right.column(c).chunks]) for c in ("tree", "chunk")])
        own = np.zeros(code.max() + 1, np.int64)
        own[code[n:]] = np.arange(right.num_rows)
        own = own[code[:n]]  # the bitmap of each row
        words = right.column("words").combine_chunks()
        sizes = np.diff(words.offsets.to_numpy())
        flat = words.flatten().to_numpy().astype(np.int64)
        bits = right.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64)
        # the popcount directory: set bits before each word of a bitmap
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
        begin = np.cumsum(sizes) - sizes
        low = left.column("low").to_numpy().astype(np.int64)
        at = np.searchsorted(np.repeat(np.arange(len(sizes)), sizes) * 64 + flat, own * 64 + (low >> 6))
        below = (np.uint64(1) << (low & 63).astype(np.uint64)) - np.uint64(1)
        rank = ones[at] - ones[begin[own]] + np.bitwise_count(bits[at] & below)
        again = right.column("again").combine_chunks()
        if len(again.flatten()):
            counts = np.diff(again.offsets.to_numpy())
            key = np.repeat(np.arange(len(counts)), counts) << CHUNK | again.flatten().to_numpy()
            added = np.concatenate([[0], np.cumsum(right.column("more").combine_chunks().flatten().to_numpy())])
            first = np.cumsum(counts) - counts
            rank = rank + added[np.searchsorted(key, own << CHUNK | low)] - added[first[own]]
        return pa.table({
            **same, "pos": rank + right.column("before").to_numpy()[own], "total": right.column("total").to_numpy()[own]})

    cell = _cell(cells, "tree", "chunk").alias("cell")
    return rows.groupBy(cell).cogroup(bitmaps.groupBy(cell)).applyInArrow(
        query, "tree string, doc_id long, leaf string, other string, low int, chunk long, pos long, total long")


def _placed(leaves: DataFrame, n: int) -> DataFrame:
    """tree, pos, total, doc_id, leaf, other: leaves with their places."""
    cells = max(1, math.ceil(n / CELL_ROWS))
    bitmaps = materialize(_bitmaps(leaves, cells), "bitmaps")
    totals = bitmaps.groupBy("tree").agg(F.sum("n").alias("total"))
    offsets = _offsets(bitmaps.select("tree", F.col("chunk").alias("key"), "n")).withColumnRenamed("key", "chunk")
    spot = ["tree", "chunk", "low"]
    crowded = bitmaps.where("n > ids").select("tree", "chunk")
    shared = None
    again = bitmaps.select("tree", "chunk", F.array().cast("array<int>").alias("again"), F.array().cast("array<long>").alias("more"))
    if not crowded.isEmpty():
        shared = leaves.join(crowded, ["tree", "chunk"], "left_semi").groupBy(*spot).agg(F.count("*").alias("n")).where("n > 1")
        shared = materialize(shared, "shared-ids")
        lists = shared.groupBy("tree", "chunk").agg(F.sort_array(F.collect_list(F.struct("low", "n"))).alias("s"))
        again = bitmaps.select("tree", "chunk").join(lists, ["tree", "chunk"], "left").select(
            "tree", "chunk", F.coalesce(F.col("s.low"), F.array().cast("array<int>")).alias("again"),
            F.transform(F.coalesce(F.col("s.n"), F.array().cast("array<long>")), lambda x: x - 1).alias("more"))
    found = bitmaps.select("tree", "chunk", "words", "bits").join(offsets, ["tree", "chunk"]).join(
        again, ["tree", "chunk"]).join(totals, "tree")
    if shared is None:
        return _ranked(leaves, found, cells).drop("low", "chunk")
    # one row stands for each shared id; its rows follow by their digests
    none = F.lit(None).cast("string")
    asked = leaves.join(shared, spot, "left_anti").unionByName(shared.select(
        *spot, F.lit(None).cast("long").alias("doc_id"), none.alias("leaf"), none.alias("other")))
    ranked = materialize(_ranked(asked, found, cells), "ranked")
    base = ranked.where("leaf IS NULL").select(*spot, "pos", "total")
    rows = leaves.join(shared.select(*spot), spot, "left_semi").groupBy(*spot, "doc_id", "leaf", "other").agg(
        F.count("*").alias("n")).withColumn("bucket", F.substring("leaf", 1, 4))
    before = W.unboundedPreceding, -1
    buckets = rows.groupBy(*spot, "bucket").agg(F.sum("n").alias("n")).withColumn(
        "outer", F.coalesce(F.sum("n").over(W.partitionBy(*spot).orderBy("bucket").rowsBetween(*before)), F.lit(0)))
    buckets = buckets.join(base, spot).select(*spot, "bucket", (F.col("outer") + F.col("pos")).alias("outer"), "total")
    inner = F.coalesce(F.sum("n").over(W.partitionBy(*spot, "bucket").orderBy("leaf").rowsBetween(*before)), F.lit(0))
    rows = materialize(rows.withColumn("inner", inner).join(buckets, [*spot, "bucket"]).select(
        "tree", (F.col("outer") + F.col("inner")).alias("first"), "total", "doc_id", "leaf", "other", "n"), "sharing")
    copies = spread_copies(rows, "n", "copy", rows.agg(F.sum("n")).first()[0])
    copies = copies.withColumn("pos", F.col("first") + F.col("copy") - 1).drop("first", "copy")
    return ranked.where("leaf IS NOT NULL").drop("low", "chunk").unionByName(copies)


def _levels(total: int) -> int:
    """Levels from the leaves of a block to its node."""
    return LEVELS if total > _SLOTS else (total - 1).bit_length()


def _nodes(slots: list[str], levels: int) -> list[list[str]]:
    """The nodes of all levels; a last node without a partner is hashed alone."""
    out = [slots]
    for _ in range(levels):
        last = out[-1]
        out.append([digest(*last[i: i + 2]) for i in range(0, len(last), 2)])
    return out


def _blocks(nodes: DataFrame, n: int) -> DataFrame:
    """tree, block, total, slots, node: consecutive nodes in arrays, with the
    node that they make. ``nodes``: tree, pos, total, leaf and further columns,
    which go in arrays too."""
    cells = max(1, math.ceil(n / CELL_ROWS))
    rest = [f for f in nodes.schema.fields if f.name not in ("tree", "pos", "total")]

    def fill(table: pa.Table) -> pa.Table:
        pos, total = (table.column(c).to_numpy() for c in ("pos", "total"))
        block = pos >> LEVELS
        code = _codes(table.column("tree"), pa.chunked_array([pa.array(block)]))
        first = np.unique(code, return_index=True)[1]
        sizes = np.minimum(total[first] - (block[first] << LEVELS), _SLOTS)
        begin = np.cumsum(sizes) - sizes
        at = np.zeros(len(pos), np.int64)
        at[begin[code] + (pos & _SLOTS - 1)] = np.arange(len(pos))  # each row to its slot
        columns = {f.name: table.column(f.name).combine_chunks().take(pa.array(at)) for f in rest}
        leaf = columns["leaf"].to_pylist()
        made = [_nodes(leaf[b: b + s], _levels(t))[-1][0] for b, s, t in zip(begin.tolist(), sizes.tolist(), total[first].tolist())]
        ends = pa.array(np.append(begin, len(pos)).astype(np.int32))
        return pa.table({
            "tree": table.column("tree").take(pa.array(first)), "block": block[first], "total": total[first],
            **{name: pa.ListArray.from_arrays(ends, values) for name, values in columns.items()}, "node": pa.array(made)})

    lists = ", ".join(f"{f.name} array<{f.dataType.simpleString()}>" for f in rest)
    return nodes.groupBy(_cell(cells, "tree", F.shiftright("pos", LEVELS)).alias("cell")).applyInArrow(
        fill, f"tree string, block long, total long, {lists}, node string")


def _grown(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Rounds of blocks, until every tree has one."""
    rounds = []
    while True:
        n = nodes.count()
        rounds.append(materialize(_blocks(nodes, n), name))
        last = rounds[-1]
        if last.agg(F.max("total")).first()[0] <= _SLOTS:
            return rounds
        whole = F.ceil(F.col("total") / _SLOTS)
        # trees that have their root wait as lone nodes, which stay as they are
        nodes = last.select("tree", F.col("block").alias("pos"), whole.alias("total"), F.col("node").alias("leaf"))


def _steps(levels: list[list[str]], i: int) -> list[str]:
    """The way up from slot i: siblings with their side, or N without one."""
    out = []
    for nodes in levels[:-1]:
        other = i ^ 1
        out.append("N" if other >= len(nodes) else ("L" if other < i else "R") + nodes[other])
        i >>= 1
    return out


def _fold(leaf: str, steps: list[str]) -> str:
    for step in steps:
        leaf = digest(leaf) if step == "N" else digest(step[1:], leaf) if step[0] == "L" else digest(leaf, step[1:])
    return leaf


def _each(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """One block at a time as Python values."""
    for batch in batches:
        for r in range(batch.num_rows):
            yield batch.slice(r, 1).to_pylist()[0]


def _paths_down(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """(tree, block, steps) of the nodes in the slots, from those of the blocks."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for r in _each(batches):
            levels = _nodes(r["leaf"], _levels(r["total"]))
            n = len(r["leaf"])
            yield {"tree": [r["tree"]] * n, "block": np.arange(n) + (r["block"] << LEVELS),
                   "steps": [_steps(levels, i) + r["steps"] for i in range(n)]}

    rows = blocks.join(paths, ["tree", "block"]).select("tree", "block", "total", "leaf", "steps")
    return map_batches(rows, walk, "tree string, block long, steps array<string>")


def _numbered(roots: DataFrame) -> DataFrame:
    """Trees (tree, leaf) with their place in byte order, from 0: sorted over
    partitions, whose rows are counted; no task holds all."""
    rows = materialize(roots.orderBy("tree").withColumn("spot", F.monotonically_increasing_id()), "trees")
    part = F.shiftright("spot", 33)
    sizes = rows.groupBy(part.alias("key")).agg(F.count("*").alias("n")).withColumn("tree", F.lit(""))
    offsets = _offsets(sizes, 2).select(F.col("key").alias("part"), "before")
    joined = rows.withColumn("part", part).join(offsets, "part")
    return joined.select("tree", "leaf", (F.col("before") + F.col("spot").bitwiseAND((1 << 33) - 1)).alias("pos"))


def merkle_manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """A leaf per row of ``docs`` (doc_id, source, lang, n_chars, text), the
    roots above it and the proof of its place.

    A leaf is the SHA-256 of the five values, each '-' if null, else its length
    in bytes, ':', and the value as text. In each language leaves ascend by
    doc_id (null first, rows of one id by their digests); pairs of consecutive
    nodes are hashed, a last one alone, until one is left, the subroot. Subroots
    in byte order of their languages (null first) make the root alike.

    Returns doc_id, leaf, subroot, root, proof_sha256 (of the siblings on the way
    to the root, one after another), folded_root and verified. Rows for which
    ``tampered`` holds are folded with 1 added to n_chars (null stays), all
    others as they are; ``verified`` tells whether that gives the root.

    Repeated rows are leaves each. An empty table has no rows and no root. Other
    columns are ignored.
    """
    leaves = materialize(_leaves(docs, F.lit(False) if tampered is None else tampered), "leaves")
    n = leaves.count()
    if not n:
        return docs.sparkSession.createDataFrame([], (
            "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"))
    rounds = _grown(_placed(leaves, n), "blocks")
    roots = rounds[-1].where("block = 0").select("tree", F.col("node").alias("leaf"))
    trees = _numbered(roots)
    trees = materialize(trees.select("tree", "leaf", "pos", F.lit(roots.count()).cast("long").alias("total")), "numbered")
    tops = _grown(trees.select(F.lit("").alias("tree"), "pos", "total", "leaf"), "tops")
    root = tops[-1].first()["node"]

    none = F.array().cast("array<string>").alias("steps")
    paths = tops[-1].select("tree", "block", none)
    for level in reversed(tops):
        paths = _paths_down(level, paths)
    paths = trees.join(paths.select(F.col("block").alias("pos"), "steps"), "pos").select(
        "tree", F.lit(0).cast("long").alias("block"), "steps")
    for level in reversed(rounds[1:]):
        paths = _paths_down(level, paths)
    paths = materialize(paths, "paths")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for r in _each(batches):
            levels = _nodes(r["leaf"], _levels(r["total"]))
            whole = _fold(levels[-1][0], r["steps"])  # untouched leaves share it
            proofs, folded = [], []
            for i, other in enumerate(r["other"]):
                steps = _steps(levels, i) + r["steps"]
                proofs.append(digest(*[s[1:] for s in steps]))
                folded.append(whole if other is None else _fold(other, steps))
            yield {"doc_id": pa.array(r["doc_id"], pa.int64()), "leaf": r["leaf"], "subroot": [r["subroot"]] * len(proofs),
                   "proof_sha256": proofs, "folded_root": folded}

    rows = rounds[0].join(paths, ["tree", "block"]).join(roots.withColumnRenamed("leaf", "subroot"), "tree").select(
        "total", "doc_id", "leaf", "other", "steps", "subroot")
    proved = map_batches(rows, prove, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string")
    return proved.select(
        "doc_id", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"))
