"""Similarity join on word shingles with adaptive multi-match prefixes.

Documents with equal shingle sets are one class, and classes are compared. The
shingles of a class are put in one global order, frequent ones last. Two
classes of n and m shingles with a Jaccard similarity of t or more share at
least ``l`` shingles among the first ``n - ceil(t n) + l`` and
``m - ceil(t m) + l`` of them, for any l. Each class chooses its own l: a longer
prefix meets more lists, but l matches are asked for before a pair is verified.
The choice weighs the rows of the lists against the pairs they can yield at
most, from exact list lengths. A pair uses the smaller l of the two.

Large groups of near copies would still make all pairs. So each class first
proposes one hub, the class with the most and longest lists for its size among
those that it shares enough prefix shingles with, and classes that proposals connect form a block.
Within blocks, pairs are verified by matrix tiles that return one row per class:
its number of links, and the class that leads its part of the tile. Prefix lists
then only make pairs between different blocks. No link is lost: each pair lies
either inside a block or between two.

The order needs no exact frequencies, any order finds the same links. Shingles
count as frequent if more than ``frequent`` documents hold them among their
first ones; at most ``order_size`` of them, the most frequent, are broadcast (9
bytes each).

Shingles are 64-bit hashes, and equal hashes count as equal shingles or sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.components import components
from evenkeel.llm.texts import (
    NOT_BLANK, WORD_BLOCK, Marks, Shared, blocks, map_batches, mixed, pick, ragged, shingles, words,
)
from evenkeel.sources.shared import materialize

SIZE, SIMILAR = 4, 85
FREQUENT, ORDER_SIZE = 8, 1 << 20
MOST_MATCHES = 4
#: Cost of verifying a pair, in rows of a list.
VERIFY_COST = 20
#: Classes and shingles of each side of a tile, about.
TILE, TILE_TOKENS = 512, 1 << 20


def _sets(batches, size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """The sorted distinct shingles of each text."""
    for batch, data, offsets in blocks(batches, size=WORD_BLOCK):
        hashes, first, _ = words(data, offsets, NOT_BLANK)
        found, at = shingles(hashes, first, size)
        cut = np.searchsorted(at, first)
        out = []
        for t in range(len(first) - 1):
            a, b = first[t], first[t + 1]
            if b - a >= size:
                out.append(np.unique(found[cut[t]: cut[t + 1]]))
            elif b > a:  # fewer words: all of them as one
                out.append(shingles(hashes[a:b], np.array([0, b - a]), int(b - a))[0])
            else:
                out.append(np.zeros(0, np.uint64))
        yield batch, out


def _name(tokens: np.ndarray) -> np.int64:
    """A fingerprint of a set."""
    total = mixed(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return mixed(np.array([total]))[0].astype(np.int64)


def _least_overlap(n: int, similar: int) -> int:
    return -(-similar * n // 100)


class _Order:
    """The global order: frequent shingles by the bits of their counts, after
    all others; within a level by hash."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        by = np.argsort(tokens)
        self.tokens, self.levels = tokens[by], np.log2(counts[by]).astype(np.uint8)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.tokens >> np.uint64(44)] = True

    def levels_of(self, s: np.ndarray) -> np.ndarray | None:
        """The level of each shingle, 0 for those that are not frequent."""
        maybe = np.flatnonzero(self.seen[s >> np.uint64(44)])
        if not len(maybe):
            return None
        at = np.minimum(np.searchsorted(self.tokens, s[maybe]), len(self.tokens) - 1)
        same = self.tokens[at] == s[maybe]
        if not same.any():
            return None
        out = np.zeros(len(s), np.uint8)
        out[maybe[same]] = self.levels[at[same]]
        return out


def _longest_prefix(n: int, similar: int) -> int:
    return n - _least_overlap(n, similar) + MOST_MATCHES


def _frequent(docs: DataFrame, size: int, similar: int, frequent: int, most: int) -> _Order:
    """Shingles that many documents hold among the first ones.

    The first pass counts what would be prefixes in hash order. Where frequent
    shingles stand in one, rarer ones will take their place: a second pass
    counts as many further shingles of those documents as will move up, judged
    by the share of frequent ones so far.
    """

    def counted(shared: Shared | None) -> Iterator:
        def first_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for _, sets in _sets(batches, size):
                parts = [np.zeros(0, np.uint64)]
                for s in sets:
                    w = _longest_prefix(len(s), similar)
                    if shared is None:
                        parts.append(s[:w])
                    elif (level := shared.value.levels_of(s[:w])) is not None:
                        rare = np.mean(level == 0)
                        end = len(s) if rare < 0.2 else int(1.3 * w / rare) + 8
                        parts.append(s[w:end])
                token, n = np.unique(np.concatenate(parts), return_counts=True)
                yield {"token": token.view(np.int64), "n": n.astype(np.int32)}

        rows = map_batches(docs.select("text"), first_ones, "token long, n int")
        return materialize(rows.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > frequent), "often")

    def order(often: DataFrame) -> _Order:
        bound = frequent
        while (kept := often.where(F.col("n") > bound)).count() > most:
            bound *= 2
        rows = kept.groupBy("token").agg(F.max("n").alias("n")).toPandas()
        return _Order(rows["token"].to_numpy(np.int64, copy=True).view(np.uint64), rows["n"].to_numpy(np.int64))

    often = counted(None)
    first = order(often)
    if not len(first.tokens):
        return first
    return order(often.unionByName(counted(Shared(docs.sparkSession, first))))


def _prefixes(docs: DataFrame, size: int, similar: int, order: _Order) -> DataFrame:
    """Per document its set's name and size and the longest prefix it may use."""
    shared = Shared(docs.sparkSession, order)

    def first_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, sets in _sets(batches, size):
            out, names = [], []
            for s in sets:
                names.append(_name(s))
                level = shared.value.levels_of(s)
                if level is not None:
                    s = s[np.argsort(level, kind="stable")]
                out.append(s[: _longest_prefix(len(s), similar)])
            yield {
                "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                "class": np.array(names, np.int64), "n": np.array([len(s) for s in sets], np.int64),
                "tokens": ragged(np.concatenate(out).view(np.int64), np.array([len(t) for t in out])),
            }

    return map_batches(
        docs, first_ones, "doc_id long, text_hash long, class long, n long, tokens array<long>")


def _sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The whole sets of classes (class, doc_id, text_hash).

    Marks of the rows wanted drop most other texts before they are read; what
    they let through by chance goes in the join. Sets are dealt out once, by class.
    """
    row = F.xxhash64("doc_id", "text_hash")
    marks = Marks(wanted.select(row.alias("row")), "row")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        def some() -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(marks.hit(b.column("row").to_numpy(zero_copy_only=False))))

        for batch, sets in _sets(some(), size):
            yield {
                "class": np.array([_name(s) for s in sets], np.int64),
                "tokens": ragged(np.concatenate(sets).view(np.int64), np.array([len(s) for s in sets])),
            }

    # a row that stands in the table more than once gives its set once
    found = map_batches(docs.withColumn("row", row), read, "class long, tokens array<long>").dropDuplicates(["class"])
    return found.join(wanted.select("class"), "class", "left_semi")


def _enough(shared: Column, a: Column, b: Column, similar: int) -> Column:
    return 100 * shared >= similar * (a + b - shared)


def _verified(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs (a, b, na, nb) that are similar."""
    left = sets.select(F.col("class").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("class").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("ta", "tb"))
    return both.where(_enough(common, F.col("na"), F.col("nb"), similar)).drop("ta", "tb")


def _filtered(matches: DataFrame, similar: int, dense: bool = False) -> DataFrame:
    """Pairs (a, b) with enough shared prefix shingles, from one row per match.

    With ``dense`` also pairs that share an eighth of the shorter prefix: where
    they stand in a crowd, a tile settles them at less cost than lists do.
    """
    need = F.least("la", "lb")
    grouped = matches.where(
        (100 * F.least("na", "nb") >= similar * F.greatest("na", "nb"))
        & (F.greatest("va", "vb") <= need)
    ).groupBy("a", "b", "na", "nb", need.alias("need")).agg(
        F.count("*").alias("shared"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    # all shared shingles up to the last match are counted; after it no more fit than are left
    most = F.col("shared") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1
    fits = (F.col("shared") >= F.col("need")) & _enough(most, F.col("na"), F.col("nb"), similar)
    if dense:
        fewer = F.least("na", "nb")
        fits |= 8 * F.col("shared") >= fewer - F.ceil(similar * fewer / F.lit(100)) + F.col("need")
    kept = grouped.where(fits)
    return kept.select("a", "b", "na", "nb", "shared")


def _inner_links(members: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Links within blocks: (class, links, leader), a row per class and tile.

    ``members``: (block, class, n, copies). The pairs of a block are cut into
    tiles of some TILE x TILE classes, fewer if their sets are long, so that a
    tile's memory is bounded; a class goes to as many tiles as the block has
    parts. ``links`` counts linked documents, ``leader`` is the smallest class
    that links of the tile reach.
    """
    sizes = members.groupBy("block").agg(F.count("*").alias("g"), F.sum("n").alias("tokens")).where("g > 1")
    parts = F.least(F.col("g"), F.greatest(F.ceil(F.col("g") / TILE), F.ceil(F.col("tokens") / TILE_TOKENS))).cast("int")
    placed = members.join(sizes, "block").withColumn("parts", parts).withColumn(
        "own", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "class", "copies")
    rows = dealt.join(sets, "class")

    def count(table: pa.Table) -> pa.Table:
        own = table.column("own").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        name, copies = table.column("class").to_numpy(), table.column("copies").to_numpy()
        tokens = table.column("tokens")
        n = np.concatenate([np.diff(c.offsets.to_numpy()) for c in tokens.chunks])
        flat = np.concatenate([c.flatten().to_numpy() for c in tokens.chunks])
        order = np.argsort(flat)
        flat = flat[order]
        ids = np.zeros(len(flat), np.int32)
        np.cumsum(flat[1:] != flat[:-1], out=ids[1:])
        row = np.repeat(np.arange(len(n), dtype=np.int32), n)[order]
        del tokens, flat, order
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        place = np.zeros(len(n), np.int64)
        place[a] = np.arange(len(a))
        place[b] = np.arange(len(b))
        common = np.zeros((len(a), len(b)), np.float32)
        width = 4096
        for low in range(0, int(ids[-1]) + 1, width):
            cut = slice(*np.searchsorted(ids, [low, low + width]))
            r, c = row[cut], ids[cut] - low
            left, right = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
            m = own[r] == i
            left[place[r[m]], c[m]] = 1
            m = own[r] == j
            right[place[r[m]], c[m]] = 1
            common += left @ right.T
        near = 100 * common.astype(np.int64) >= similar * (n[a][:, None] + n[b][None, :] - common.astype(np.int64))
        near &= name[a][:, None] != name[b][None, :]
        links = np.zeros(len(n), np.int64)
        links[a] += near @ copies[b]
        if i != j:
            links[b] += copies[a] @ near
        leader, before = name.copy(), None
        far = np.iinfo(np.int64).max
        while before is None or (leader != before).any():
            before = leader.copy()
            leader[a] = np.minimum(leader[a], np.where(near, leader[b][None, :], far).min(1, initial=far))
            leader[b] = np.minimum(leader[b], np.where(near, leader[a][:, None], far).min(0, initial=far))
        return pa.table({"class": name, "links": links, "leader": leader})

    return rows.groupBy("block", "i", "j").applyInArrow(count, "class long, links long, leader long")


def jaccard_join(
    docs: DataFrame, size: int = SIZE, similar: int = SIMILAR, frequent: int = FREQUENT, order_size: int = ORDER_SIZE
) -> DataFrame:
    """Link documents (doc_id, text) whose sets of ``size``-word shingles have
    a Jaccard similarity of ``similar`` percent or more.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Returns
    one row per document: doc_id, n_shingles, component_id (the smallest doc_id
    that links reach, its own included), class_id (equal for equal sets) and
    n_links (documents linked with it, copies included).

    A text of fewer words is one shingle; null texts and texts without words
    have none, link with nothing and are their own component. Repeated rows are
    documents of one class. A null doc_id is never the smallest one; where all
    are null, so is the component. Other columns are ignored.
    """
    docs = pick(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    order = _frequent(docs, size, similar, frequent, order_size)
    found = materialize(_prefixes(docs, size, similar, order), "prefixes")
    classes = found.where("n > 0").groupBy("class", "n").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one"),
        F.count("*").alias("copies"))
    # one copy of each class gives the prefix, so that copies are not counted in the lists
    classes = materialize(classes.select("class", "n", "copies", "one.doc_id", "one.text_hash"), "classes")
    prefix = found.where("n > 0").groupBy("class", "n").agg(F.any_value("tokens").alias("tokens"))
    tokens = prefix.select("class", "n", F.posexplode("tokens").alias("p", "token"))
    lists = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    tokens = materialize(tokens.join(lists, "token"), "lists")

    # each class chooses its number of matches
    slack = F.col("n") - F.ceil(similar * F.col("n") / F.lit(100)).cast("long")
    level = F.greatest(F.lit(1).cast("long"), F.col("p") - slack + 1)
    tokens = tokens.withColumn("v", level)
    rows = [F.sum(F.when(F.col("v") <= k, F.col("df") - 1).otherwise(0)) for k in range(1, MOST_MATCHES + 1)]
    costs = F.array_sort(F.array(*[
        F.struct((r * (1 + VERIFY_COST / k)).alias("cost"), F.lit(k).cast("long").alias("k"))
        for k, r in enumerate(rows, 1)]))
    chosen = tokens.groupBy("class").agg(costs[0]["k"].alias("l"), (F.sum("df") / F.any_value("n")).alias("rank"))
    overlap = F.col("n") - slack
    tokens = tokens.join(chosen, "class").withColumn("l", F.least("l", overlap)).where("v <= l")
    tokens = materialize(tokens, "lists")

    # blocks: each class proposes the class of the longest lists, per list
    side = ["class", "n", "p", "v", "l"]
    best = tokens.groupBy("token").agg(F.max(F.struct("rank", *side)).alias("hub"))

    def named(end: str, prefix: str = "") -> list[Column]:
        return [F.col(prefix + c).alias(end if c == "class" else c + end) for c in side]

    proposed = tokens.join(best, "token").where(F.col("class") != F.col("hub.class")).select(
        *named("a"), *named("b", "hub."))
    chosen = _filtered(proposed, similar, dense=True).groupBy("a").agg(
        F.max_by("b", F.struct("shared", "b")).alias("b"))
    hubs = materialize(chosen, "hubs")
    blocks_of = materialize(components(hubs).withColumnRenamed("component", "block"), "blocks")
    rep = classes.select("class", "doc_id", "text_hash")

    def sets_for(ids: DataFrame) -> DataFrame:
        return _sets_of(docs, materialize(rep.join(ids.distinct(), "class"), "wanted"), size)

    members = blocks_of.withColumnRenamed("node", "class").join(classes.select("class", "n", "copies"), "class")
    inner = materialize(_inner_links(
        members.select("block", "class", "n", "copies"), sets_for(members.select("class")), similar), "inner")

    # lists make pairs between blocks only; a class outside is a block of its own
    placed = tokens.join(blocks_of, tokens["class"] == blocks_of["node"], "left").withColumn(
        "block", F.coalesce("block", "class"))
    placed = materialize(placed.select("token", "block", *side), "placed")
    groups = placed.select("token", "block").distinct()
    meets = groups.join(groups.select("token", F.col("block").alias("other")), "token").where("block < other")
    a = placed.select("token", "block", *named("a"))
    b = placed.select("token", F.col("block").alias("other"), *named("b"))
    between = a.join(meets, ["token", "block"]).join(b, ["token", "other"])
    between = materialize(_filtered(between, similar), "between")
    ends = between.select(F.col("a").alias("class")).union(between.select("b"))
    ends = materialize(sets_for(ends), "sets")
    outer = materialize(_verified(between, ends, similar).select("a", "b"), "outer")

    # components of classes, then of documents
    led = inner.where("leader <> class").select(F.col("class").alias("a"), F.col("leader").alias("b"))
    joined = components(outer.unionByName(led))
    weight = classes.select(F.col("class").alias("b"), F.col("copies").alias("links"))
    far = outer.unionByName(outer.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(weight, "b")
    links = far.select(F.col("a").alias("class"), "links").unionByName(inner.select("class", "links"))
    links = links.groupBy("class").agg(F.sum("links").alias("links"))
    whole = classes.join(joined, classes["class"] == joined["node"], "left").withColumn(
        "part", F.coalesce("component", "class")).join(links, "class", "left")
    smallest = whole.groupBy("part").agg(F.min("doc_id").alias("least"))
    facts = whole.join(smallest, "part").select(
        "class", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    filled = found.select("doc_id", "class", "n").where("n > 0").join(facts, "class").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"),
        F.col("class").alias("class_id"), F.col("links").cast("long").alias("n_links"))
    empty = found.where("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.col("class").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return filled.unionByName(empty)
