"""Near copies among embeddings by an inverted multi-index.

Unit vectors are cut into halves, each with a codebook of its own (k-means on a
bounded sample); the two nearest codewords of a vector name its home cell in the
product grid. Each vector then visits the cells nearest to it, in the order of
the multi-sequence algorithm: by the sum of the distances of its halves to the
codewords. How many cells are visited is learned from the sample, so that a
share of ``recall`` of links is found, those at exactly the least similarity
included, the hardest to find. Links found are verified in double precision.

Equal vectors are one class, and one of them stands for all. The members and
the visitors of a cell are cut into parts of some ``TILE`` vectors; a task gets
one part of each and returns a row per vector, its number of links and the least
class it reaches, never the pairs. Where two vectors visit each other's home,
the link counts on one side only.

The sample is at most ``SAMPLE`` vectors of ``SAMPLE_NUMBERS`` numbers in all;
every vector is indexed. The grid has one cell per some ``LOAD`` vectors, and at
most ``MOST_WORDS`` squared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.components import components
from evenkeel.llm.neighbours import cosines
from evenkeel.llm.texts import Shared, carrying, map_batches, pick, ragged
from evenkeel.sources.shared import materialize

SIMILAR, RECALL = 0.9, 0.99
SAMPLE, SAMPLE_NUMBERS = 16_384, 1 << 22
LOAD, MOST_WORDS = 128, 256
TILE = 1024
#: Most cells whose sizes are broadcast, 16 bytes each; else they are joined.
BROADCAST_CELLS = 1 << 18
#: Rounds of k-means; sample vectors that are compared pair by pair.
ROUNDS, PROBES = 8, 2048
#: Cosines of products this close to the bar are worked out once more.
CLOSE = 1e-9


@dataclass
class Index:
    """Codebooks of one vector length, and how many cells a vector visits."""

    words: tuple[np.ndarray, np.ndarray]
    visits: int

    @property
    def k(self) -> tuple[int, int]:
        return len(self.words[0]), len(self.words[1])

    def distances(self, unit: np.ndarray) -> list[np.ndarray]:
        """Squared distances of both halves to their codewords."""
        half = unit.shape[1] // 2
        return [((x * x).sum(1)[:, None] - 2 * x @ w.T + (w * w).sum(1)[None, :])
                for x, w in zip((unit[:, :half], unit[:, half:]), self.words)]

    def nearest(self, unit: np.ndarray) -> np.ndarray:
        """The cells that each vector visits, nearest first; the home comes first.

        A cell of the a-th and b-th nearest codewords (from 1) comes after a * b
        - 1 others at least, so only those of a * b <= visits can be reached.
        """
        first, second = self.distances(unit)
        visits = min(self.visits, self.k[0] * self.k[1])
        orders = [np.argsort(d, axis=1, kind="stable")[:, :visits] for d in (first, second)]
        a, b = np.indices([o.shape[1] for o in orders]).reshape(2, -1)
        reach = (a + 1) * (b + 1) <= visits
        a, b = a[reach], b[reach]
        near = [np.take_along_axis(d, o, 1) for d, o in zip((first, second), orders)]
        cost = near[0][:, a] + near[1][:, b]
        cost[:, 0] = -np.inf
        best = np.argsort(cost, axis=1, kind="stable")[:, :visits]
        left, right = np.take_along_axis(orders[0], a[best], 1), np.take_along_axis(orders[1], b[best], 1)
        return left * self.k[1] + right


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, without overflow on the way."""
    near = vectors / np.abs(vectors).max(1, keepdims=True)
    return near / np.sqrt((near * near).sum(1, keepdims=True))


def _codewords(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    words = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        home = ((words * words).sum(1)[None, :] - 2 * x @ words.T).argmin(1)
        sizes = np.bincount(home, minlength=k)
        sums = np.zeros_like(words)
        np.add.at(sums, home, x)
        words = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], words)
    return words


def _found_after(index: Index, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many cells have to be visited until one of two vectors meets the other."""
    out = []
    (x1, x2), (y1, y2) = index.distances(x), index.distances(y)
    for (a, b), (c, d) in (((x1, x2), (y1, y2)), ((y1, y2), (x1, x2))):
        cells = a[:, :, None] + b[:, None, :]
        rows = np.arange(len(a))
        home = cells[rows, c.argmin(1), d.argmin(1)]
        out.append((cells < home[:, None, None]).sum((1, 2)) + 1)
    return np.minimum(*out)


def fit_index(sample: np.ndarray, n: int, similar: float, recall: float, load: int = LOAD) -> Index:
    """Codebooks for some ``n`` vectors, from unit vectors of a sample."""
    rng = np.random.default_rng(13)
    half = sample.shape[1] // 2
    k = int(np.clip(round((n / load) ** 0.5), 1, min(MOST_WORDS, len(sample))))
    index = Index((_codewords(sample[:, :half], k, rng), _codewords(sample[:, half:], k, rng)), 1)
    if k == 1:
        return index
    x = sample[rng.choice(len(sample), min(PROBES, len(sample)), replace=False)]
    off = rng.normal(size=x.shape)
    off -= (off * x).sum(1, keepdims=True) * x
    off /= np.maximum(np.sqrt((off * off).sum(1, keepdims=True)), 1e-300)
    hard = similar * x + np.sqrt(1 - similar * similar) * off
    pairs = [(x, hard)]
    i, j = np.nonzero(np.triu(x @ x.T >= similar, 1))
    if len(i):  # links of the sample itself, so far as there are any
        pick_ = rng.choice(len(i), min(PROBES, len(i)), replace=False)
        pairs.append((x[i[pick_]], x[j[pick_]]))
    for one, two in pairs:
        step = max(1, (1 << 22) // (k * k))
        after = np.concatenate([_found_after(index, one[c: c + step], two[c: c + step]) for c in range(0, len(one), step)])
        index.visits = max(index.visits, int(np.quantile(after, recall, method="higher")))
    return index


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal lengths as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _indexes(classes: DataFrame, similar: float, recall: float) -> dict[int, Index]:
    """One index per vector length of the sample. Lengths that it does not hold
    have a single cell."""
    stats = classes.groupBy("dim").agg(F.count("*").alias("n"))
    longest = stats.agg(F.max("dim"), F.sum("n")).first()
    if longest[0] is None:
        return {}
    wanted = max(1, min(SAMPLE, SAMPLE_NUMBERS // longest[0]))
    rows = classes.orderBy(F.xxhash64("class")).limit(wanted).select("dim", "embedding").toPandas()
    out = {}
    for dim, part in rows.groupby("dim"):
        share = round(len(part) / len(rows) * longest[1])
        out[int(dim)] = fit_index(units(np.stack(part["embedding"]).astype(np.float64)), share, similar, recall)
    return out


def _links(visits: DataFrame, members: DataFrame, similar: float) -> DataFrame:
    """(class, links, leader), a row per vector and tile with links."""
    sizes = [t.groupBy("dim", "cell").agg(F.ceil(F.count("*") / TILE).cast("int").alias(n))
             for t, n in ((members, "m"), (visits, "v"))]
    sizes = materialize(sizes[0].join(sizes[1], ["dim", "cell"]), "cells")
    if sizes.count() <= BROADCAST_CELLS:
        sizes = F.broadcast(sizes)

    def dealt(rows: DataFrame, own: str, other: str, side: int) -> DataFrame:
        spot = F.pmod(F.xxhash64("class"), F.col(own)).cast("int")
        both = rows.join(sizes, ["dim", "cell"]).withColumn(own, spot).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return both.select(
            "dim", "cell", "m", "v", F.lit(side).alias("side"), "class", "copies", "embedding",
            "home" if side else F.lit(0).alias("home"),
            F.array().cast("array<int>").alias("visited") if side else "visited")

    def count(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        rows = table.column("embedding").combine_chunks()
        vectors = _matrix(rows).astype(np.float64)
        name, copies = table.column("class").to_numpy(), table.column("copies").to_numpy()
        a, b = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        if not len(a) or not len(b):
            return pa.table({"class": name[:0], "links": name[:0], "leader": name[:0]})
        unit = units(vectors)
        cos = unit[a] @ unit[b].T
        near = cos >= similar
        i, j = np.nonzero(np.abs(cos - similar) <= CLOSE)
        for low in range(0, len(i), 65_536):
            x, y = i[low: low + 65_536], j[low: low + 65_536]
            near[x, y] = cosines(vectors[a[x]], vectors[b[y]]) >= similar
        near &= name[a][:, None] != name[b][None, :]
        # a pair that is found from both homes counts where the smaller class visits
        home, visited = table.column("home").to_numpy()[a], _matrix(table.column("visited").combine_chunks().take(pa.array(b)))
        back = np.zeros_like(near)
        for place in np.unique(home[near.any(1)]):
            back[home == place] = (visited == place).any(1)[None, :]
        once = near & ~(back & (name[a][:, None] > name[b][None, :]))
        links = np.zeros(len(name), np.int64)
        links[a] += once @ copies[b]
        links[b] += copies[a] @ once
        leader, before, far = name.copy(), None, np.iinfo(np.int64).max
        while before is None or (leader != before).any():
            before = leader.copy()
            leader[a] = np.minimum(leader[a], np.where(near, leader[b][None, :], far).min(1, initial=far))
            leader[b] = np.minimum(leader[b], np.where(near, leader[a][:, None], far).min(0, initial=far))
        told = np.flatnonzero((links > 0) | (leader < name))
        return pa.table({"class": name[told], "links": links[told], "leader": leader[told]})

    tiles = dealt(members, "m", "v", 0).unionByName(dealt(visits, "v", "m", 1))
    return tiles.groupBy("dim", "cell", "m", "v").applyInArrow(count, "class long, links long, leader long")


def near_vectors(vectors: DataFrame, similar: float = SIMILAR, recall: float = RECALL) -> DataFrame:
    """Link rows (vec_id, embedding) whose cosine is ``similar`` or more.

    Returns one row per row: vec_id, n_links (other rows linked with it),
    component_id (the smallest vec_id that links reach, its own included), kept
    (vec_id is component_id). Links are those that the index finds, a share of
    ``recall`` or more of all; every link returned holds in double precision.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing and are their own component. Vectors of different lengths are not
    compared. Repeated rows and equal vectors link with one another. A null
    vec_id is never the smallest; where all are null, so is the component. An
    empty table gives no rows. Other columns are ignored.
    """
    rows = pick(vectors, "vec_id", "embedding").withColumn("vec_id", F.col("vec_id").cast("long"))
    if rows.schema["embedding"].dataType.simpleString() != "array<float>":
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    values = F.col("embedding")
    usable = values.isNotNull() & (F.size(values) > 0) & ~F.exists(
        values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(values, lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    good, odd = rows.where("usable").drop("usable"), rows.where("NOT usable")
    same = good.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = materialize(same.select(
        F.monotonically_increasing_id().alias("class"), F.size("embedding").alias("dim"), "embedding", "least", "copies"),
        "classes")
    indexes = Shared(vectors.sparkSession, _indexes(classes, similar, recall))
    along = ("class", "dim", "copies", "embedding")

    def visiting(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                index = indexes.value.get(int(dim))
                if index is None:
                    cells = np.zeros((part.num_rows, 1), np.int32)
                else:
                    cells = index.nearest(units(_matrix(part.column("embedding")).astype(np.float64))).astype(np.int32)
                yield {**{c: part.column(c) for c in along}, "home": cells[:, 0], "visited": ragged(
                    cells.ravel(), np.full(part.num_rows, cells.shape[1]))}

    seen = classes.select(*along)
    placed = materialize(map_batches(seen, visiting, carrying(seen, along, "home int, visited array<int>")), "placed")
    members = placed.withColumn("cell", F.col("home"))
    visits = placed.select("class", "dim", "copies", "embedding", "home", F.explode("visited").alias("cell"))
    inner = materialize(_links(visits, members, similar), "links")

    joined = components(inner.where("leader <> class").select(F.col("class").alias("a"), F.col("leader").alias("b")))
    links = inner.groupBy("class").agg(F.sum("links").alias("links"))
    whole = classes.drop("dim").join(joined.withColumnRenamed("node", "class"), "class", "left").join(
        links, "class", "left").withColumn("part", F.coalesce("component", "class"))
    smallest = whole.groupBy("part").agg(F.min("least").alias("smallest"))
    facts = whole.join(smallest, "part").select(
        "embedding", "smallest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    found = good.join(facts, "embedding").select("vec_id", "n_links", F.col("smallest").alias("component_id"))
    alone = odd.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
