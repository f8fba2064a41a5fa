"""Divergence audit: how far do the term rates of sources lie apart?

Texts are read once; every task counts terms per group of (lang, source) and
sends one row per group and term. Each language keeps the terms of at least
``LEAST_DOCS`` of its documents. Kept terms get a slice (by hash) and a number
within it, so that a group is one sorted array (term number, count) per slice.

Pairs of groups are priced by tasks. A task gets the arrays of two blocks of
sources in one slice and goes through their unordered pairs: the shorter array
gallops through the longer one for the terms of both; terms of one side alone
meet the rate of an absent term on the other, and terms absent on both sides
are counted, not visited. The price is symmetric, so it is worked out once and
listed both ways. Prices of the slices add up.

No array is longer than some ``SLICE`` terms and no task holds more than
2 x ``BLOCK`` of them, whatever the size of a language or a source.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evenkeel.llm.texts import as_bytes, blocks, map_batches, pick
from evenkeel.sources.shared import materialize

LEAST_DOCS = 10
TOP_TERMS = 10
SLICE, BLOCK = 1 << 14, 32
#: Entries that a task counts before it sends them on.
HELD = 400_000
#: A long text is split into words piece by piece.
PIECE = 1 << 20
#: Fixed value: rates are whole parts of a thousand to the third.
PARTS = 1_000_000_000

#: A-Z lower-cased, all other ASCII but letters a blank.
_LETTERS = bytes(
    c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    low = 0
    while low < len(text):
        high = text.find(b" ", low + PIECE)
        high = len(text) if high < 0 else high
        yield text[low:high].split()
        low = high


def _strings(values: list[bytes]) -> pa.Array:
    """Parts of texts as strings again; they are cut at blanks only."""
    return pa.array(values, pa.binary()).view(pa.string())


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term per group, and
    documents with it. The empty term marks groups, also those without terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}

        def rows() -> dict:
            names, terms, n, found = list(held), [], [], []
            sizes = []
            for times, documents in held.values():
                sizes.append(len(times) + 1)
                terms += [b"", *times]
                n += [0, *times.values()]
                found += [0, *[documents[t] for t in times]]
            group = np.repeat(np.arange(len(names)), sizes)
            return {
                "lang": _strings([a for a, _ in names]).take(pa.array(group)),
                "source": _strings([b for _, b in names]).take(pa.array(group)),
                "term": _strings(terms), "n": pa.array(n, pa.int64()), "docs": pa.array(found, pa.int64()),
            }

        size = 0
        for batch, data, at in blocks(batches):
            clean = data.tobytes().translate(_LETTERS)
            sides = []
            for name in ("lang", "source"):
                flat, ends = as_bytes(batch.column(name))
                flat = flat.tobytes()
                sides.append([flat[a:b] for a, b in zip(ends[:-1], ends[1:])])
            for lang, source, low, high in zip(*sides, at[:-1].tolist(), at[1:].tolist()):
                own = held.get((lang, source))
                if own is None:
                    own = held[lang, source] = (Counter(), Counter())
                    size += 1
                times, documents = own
                before, seen = len(times), set()
                for words in _pieces(clean[low:high]):
                    times.update(words)
                    seen.update(words)
                documents.update(seen)
                size += len(times) - before
                if size >= HELD:
                    yield rows()
                    held.clear()
                    size = 0
        if held:
            yield rows()

    empty = F.lit("")
    read = pick(docs, "lang", "source", "text").select(
        *[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])
    rows = map_batches(read, count, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def rates(counts: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(PARTS * (counts + 2) / whole), exactly while ``whole`` is
    under 9e15: the quotient is worked out three digits at a time."""
    out, rest = np.divmod(counts.astype(np.int64) + 2, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); rates are at most PARTS + 1, so that
    squares fit 64 bits."""
    return (p - q) ** 2 // (p + q)


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``short`` and in ``long`` of the values that both hold; both
    are sorted and have no repeats. Steps double from where the search of every
    64th value ended, then the last step is halved until the place is found."""
    if not len(short) or not len(long):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = len(long) - 1
    low = np.repeat(np.searchsorted(long, short[::64]), 64)[: len(short)].astype(np.int64)
    low = np.minimum(low, last)
    high, step = low.copy(), 1
    far = np.flatnonzero(long[high] < short)
    while len(far):
        low[far] = high[far]
        high[far] = np.minimum(high[far] + step, last)
        step *= 2
        far = far[(long[high[far]] < short[far]) & (high[far] < last)]
    while len(far := np.flatnonzero(high - low > 1)):
        middle = (low[far] + high[far]) // 2
        below = long[middle] < short[far]
        low[far[below]] = middle[below]
        high[far[~below]] = middle[~below]
    place = np.where(long[low] >= short, low, high)
    same = np.flatnonzero(long[place] == short)
    return same, place[same]


def _price(a: dict, b: dict, terms: int) -> int:
    """The sum of gaps over all ``terms`` of a slice."""
    if not terms:
        return 0
    short, long = (a, b) if len(a["ids"]) <= len(b["ids"]) else (b, a)
    i, j = gallop(short["ids"], long["ids"])
    total = int(gaps(short["rates"][i], long["rates"][j]).sum())
    for one, other, met in ((short, long, i), (long, short, j)):
        alone = gaps(one["rates"], other["none"])
        total += int(alone.sum()) - int(alone[met].sum())
    absent = terms - len(short["ids"]) - len(long["ids"]) + len(i)
    return total + absent * int(gaps(short["none"], long["none"]))


def _pair_prices(arrays: DataFrame) -> DataFrame:
    """(lang, a, b, value) of the pairs of each tile; a < b by their bytes.

    ``arrays``: lang, slice, i, j, own (the block of the source, i or j), source,
    ids, counts, whole (N + 2 V of the group), terms (of the slice).
    """

    def price(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        terms = table.column("terms")[0].as_py()
        sides: dict[int, list[dict]] = {i: [], j: []}
        own, sources = table.column("own").to_pylist(), table.column("source").to_pylist()
        wholes = table.column("whole").to_pylist()
        for r in range(table.num_rows):
            ids = table.column("ids")[r].values.to_numpy()
            counts = table.column("counts")[r].values.to_numpy()
            whole = max(wholes[r], 1)
            sides[own[r]].append({
                "name": sources[r].encode(), "ids": ids, "rates": rates(counts, whole),
                "none": rates(np.zeros(1, np.int64), whole)[0]})
        out: tuple[list, list, list] = ([], [], [])
        for x, one in enumerate(sides[i]):
            for two in sides[i][x + 1:] if i == j else sides[j]:
                a, b = (one, two) if one["name"] < two["name"] else (two, one)
                for held, value in zip(out, (a["name"], b["name"], _price(a, b, terms))):
                    held.append(value)
        lang = table.column("lang")[0].as_py()
        return pa.table({"lang": pa.array([lang] * len(out[0]), pa.string()), "a": _strings(out[0]), "b": _strings(out[1]),
                         "value": pa.array(out[2], pa.int64())})

    return arrays.groupBy("lang", "slice", "i", "j").applyInArrow(
        price, "lang string, a string, b string, value long")


def _rate(count: Column, whole: Column) -> Column:
    """The same rate in Spark, in decimals, which are exact."""
    high = (count.cast("decimal(20,0)") + F.lit(2)) * F.lit(PARTS).cast("decimal(10,0)")
    return F.call_function("div", high, whole.cast("decimal(20,0)")) + 1


def divergence_audit(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, slice_terms: int = SLICE, block: int = BLOCK
) -> DataFrame:
    """Gaps between the term rates of sources (``part`` = pair), and the terms
    that a source uses more than its language (``part`` = term).

    ``docs``: lang, source, text; null counts as ''. Terms are runs of letters
    (ASCII letters, of which A-Z are lower-cased, and all non-ASCII). Returns
    lang, source, part, item, value, rank: for each group the other sources of
    its language (all of them) and its ``top`` terms, largest value first, ties
    by the bytes of the item.

    Groups without terms take part with counts of 0; a language without kept
    terms has pairs of value 0 and no terms. Repeated rows count as often as
    they stand there. An empty table gives no rows. Other columns are ignored.
    """
    counts = materialize(term_counts(docs), "term-counts")
    groups = counts.where("term = ''").select("lang", "source")
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(
        F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = materialize(kept.select("lang", "term", "n_lang"), "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("all"))
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(langs, "lang", "left").select(
        "lang", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("all", F.lit(0)).alias("all"),
        F.greatest(F.lit(1), F.ceil(F.coalesce("v", F.lit(0)) / slice_terms)).alias("slices"),
        F.ceil(F.col("sources") / block).alias("blocks"))
    langs = materialize(langs, "languages")

    # terms are numbered within slices, which are even, so that no window holds a whole language
    sliced = kept.join(langs.select("lang", "slices"), "lang").withColumn(
        "slice", F.pmod(F.xxhash64("term"), F.col("slices")).cast("int"))
    number = F.row_number().over(W.partitionBy("lang", "slice").orderBy("term"))
    sliced = sliced.select("lang", "term", "n_lang", "slice", number.alias("id"))
    facts = counts.where("term <> ''").join(sliced, ["lang", "term"]).select(
        "lang", "source", "term", "slice", "id", "n", "n_lang")
    facts = materialize(facts, "facts")
    totals = facts.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    stats = groups.join(totals, ["lang", "source"], "left").join(langs, "lang").select(
        "lang", "source", "slices", "blocks", (F.coalesce("n_group", F.lit(0)) + 2 * F.col("v")).alias("whole"),
        (F.col("all") + 2 * F.col("v")).alias("whole_lang"))
    stats = materialize(stats, "groups")

    # one array per group and slice, empty ones too
    lists = facts.groupBy("lang", "source", "slice").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("s"))
    terms = facts.select("lang", "slice", "id").distinct().groupBy("lang", "slice").agg(F.count("*").alias("terms"))
    places = stats.withColumn("slice", F.explode(F.sequence(F.lit(0), (F.col("slices") - 1).cast("int"))))
    places = places.join(terms, ["lang", "slice"], "left").join(lists, ["lang", "source", "slice"], "left")
    own = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    placed = places.select(
        "lang", "source", "slice", "whole", F.coalesce("terms", F.lit(0)).alias("terms"), "blocks", own.alias("own"),
        F.coalesce(F.col("s.id"), F.array().cast("array<int>")).alias("ids"),
        F.coalesce(F.col("s.n"), F.array().cast("array<long>")).alias("counts"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
    tiles = dealt.select(
        "lang", "slice", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "source",
        "ids", "counts", "whole", "terms")
    prices = _pair_prices(tiles).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    prices = materialize(prices, "prices")
    pairs = prices.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        prices.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))

    rated = facts.join(stats.select("lang", "source", "whole", "whole_lang"), ["lang", "source"]).withColumns({
        "p": _rate(F.col("n"), F.col("whole")), "q": _rate(F.col("n_lang"), F.col("whole_lang"))}).where("p > q")
    gap = F.expr("((p - q) * (p - q)) div (p + q)")
    used = rated.select("lang", "source", F.col("term").alias("item"), gap.alias("value"))

    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(order)).select(
            "lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long"), "rank")

    return ranked(pairs, "pair").unionByName(ranked(used, "term").where(F.col("rank") <= top))
