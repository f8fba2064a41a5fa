"""Language-model scoring with a probabilistic suffix tree over characters.

A state is a context of up to DEPTH characters. Contexts seen LEAST times or
more, whatever the size of the corpus, are candidates. A candidate is retained
where its next-character distribution diverges from that of the context one
character shorter by more than the information criterion asks for, and where a
retained context needs it as a suffix; contexts of up to one character always
are. Distributions are smoothed towards the shorter context, so only characters
seen after a context are stored, and the weight of the shorter one for the rest.
The longest retained suffix of what came before scores a character.

Contexts grow in number with the corpus. They are made and tested in groups that
share their last two characters, side by side, and stay in a table. Scoring sends
BLOCK entries of it at a time and takes as many passes over the texts as there
are blocks; each pass scores the characters whose contexts its block holds.

Texts are read as their words, lower-cased, with one space between, and an end.
Characters beyond the ALPHABET - 2 most frequent share one symbol, and are told
apart by their own frequencies.

Words of training texts are counted exactly, all of them. Scores that need the
count of a word take it from a broadcast array if the word makes up HEAD_SHARE of
all or more (so at most 1 / HEAD_SHARE words are sent), and from a join else;
what is joined is rare by definition, so no key of the join is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.texts import NOT_BLANK, Shared, blocks, code_points, map_batches, pick, ragged, words
from evenkeel.sources.shared import materialize

DEPTH, ALPHABET, BITS = 6, 96, 7
HEAD_SHARE = 5e-7
#: Times that a context must be seen for its distribution to be tested.
LEAST = 32
#: Entries of contexts per broadcast and per group of the fit.
BLOCK, GROUP = 8_000_000, 1_000_000
#: Weight of the shorter context, in characters.
PRIOR = 4.0
END, RARE = 0, ALPHABET - 1
#: Stands for the weight of the shorter context among next symbols.
BACK = (1 << BITS) - 1
_FLUSH = 2_000_000
#: Codes whose answers a process keeps: 2^MEMO_BITS of 12 bytes each.
MEMO_BITS = 22
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the words of texts with one space between, 0 as the end of
    each text and DEPTH zeros before it; and where each begins."""
    points, at = code_points(data, offsets)
    chars = points.copy()
    chars[(chars >= 65) & (chars <= 90)] += 32
    blank = (chars == 32) | ((chars >= 9) & (chars <= 13))
    chars[blank] = 32
    chars[chars == 0] = 0xFFFF  # NUL is a character like any other
    keep = np.ones(len(chars), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    some = np.flatnonzero(at[:-1] < at[1:])
    keep[at[some]] = ~blank[at[some]]
    # of a last run of blanks only its first is left; drop it as well
    kept_at = np.flatnonzero(keep)
    ends = np.searchsorted(kept_at, at)
    tails = kept_at[ends[1:][ends[:-1] < ends[1:]] - 1]
    keep[tails] &= ~blank[tails]
    total = np.zeros(len(chars) + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    size = total[at[1:]] - total[at[:-1]]
    begin = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size + DEPTH + 1, out=begin[1:])
    out = np.zeros(begin[-1], np.uint32)
    mask = np.ones(len(out), bool)
    for j in range(DEPTH):
        mask[begin[:-1] + j] = False
    mask[begin[1:] - 1] = False
    out[mask] = chars[keep]
    return out, begin


class _Summed:
    """Counts of numbers, in sorted arrays that are merged now and then."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, found: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((found, n))
        self.size += len(found)
        if self.size > _FLUSH:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        values, n = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(values, kind="stable")
        values, n = values[order], n[order]
        first = np.flatnonzero(np.diff(values, prepend=~values[:1]))
        out = values[first], np.add.reduceat(n, first)
        self.parts, self.size = [out], len(first)
        return out

    def full(self) -> bool:
        return self.size > _FLUSH


def _count(docs: DataFrame, values_of, what: str) -> DataFrame:
    """(value, n) over all texts: summed per task, then by Spark. ``values_of``
    gives the values of a block and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums = _Summed()
        for _, data, offsets in blocks(batches):
            sums.add(*values_of(data, offsets))
            if sums.full():
                yield dict(zip(("value", "n"), sums.merge()))
                sums = _Summed()
        yield dict(zip(("value", "n"), sums.merge()))

    rows = map_batches(docs.select("text"), run, "value long, n long")
    # tasks have added up already; to do it again before the shuffle costs more than it saves
    return materialize(rows.repartition("value").groupBy("value").agg(F.sum("n").alias("n")), what)


def _codes(points: np.ndarray, begin: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """What came before each character, the nearest symbol first, and its own
    symbol last. Shorter contexts are what is left after a shift."""
    ids = symbol[points].astype(np.int64)
    n = max(0, len(ids) - DEPTH)
    code = np.zeros(n, np.int64)
    for j in range(DEPTH - 1, -1, -1):
        code = (code << BITS) | ids[j: j + n]
    code = (code << BITS) | ids[DEPTH: DEPTH + n]
    own = np.ones(n, bool)  # not those that end in the padding of the next text
    for j in range(DEPTH):
        own[begin[1:-1] + j - DEPTH] = False
    return code[own]


def _shorter(code: np.ndarray, depth: int, out: int) -> np.ndarray:
    """Codes of ``depth`` symbols of context, cut to ``out``."""
    return (code >> BITS * (depth - out + 1) << BITS) | (code & BACK)


def _group_of(pair: Column | np.ndarray, groups: int) -> Column | np.ndarray:
    """The group of contexts whose last two symbols are ``pair``."""
    if isinstance(pair, Column):
        return F.shiftright((pair * F.lit(2654435761)).bitwiseAND(F.lit(0xFFFFFFFF)), 12) % F.lit(groups)
    return (((pair * 2654435761) & 0xFFFFFFFF) >> 12) % groups


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``wanted`` are among sorted keys, and which of them are."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _retained(value: np.ndarray, n: np.ndarray, below: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, codes, log10 probabilities) of the contexts of two symbols and
    more that the divergence test or a longer context asks for. ``value``, ``n``:
    counts of whole codes; ``below``: probabilities of codes of one symbol."""
    tables, keep = [], []
    known, p = np.arange(len(below)), below
    for d in range(2, DEPTH + 1):
        codes, of = np.unique(_shorter(value, DEPTH, d), return_inverse=True)
        count = np.bincount(of, n)
        context, first, owner = np.unique(codes >> BITS, return_index=True, return_inverse=True)
        total = np.bincount(owner, count)
        some = (total >= LEAST)[owner]
        codes, count = codes[some], count[some]
        context, first, owner = np.unique(codes >> BITS, return_index=True, return_inverse=True)
        total = np.bincount(owner, count, minlength=len(context))
        # a suffix of a candidate is a candidate, so its codes are there
        shorter = p[_find(known, _shorter(codes, d, d - 1))[0]] if len(codes) else np.zeros(0)
        gain = np.bincount(owner, count * np.log(count / total[owner] / shorter), minlength=len(context))
        asked = 0.5 * np.bincount(owner, minlength=len(context)) * np.log(np.maximum(total, 2))
        known, p = codes, (count + PRIOR * shorter) / (total[owner] + PRIOR)
        tables.append((context, total, owner, codes, p))
        keep.append(gain > asked)
    for i in range(len(tables) - 1, 0, -1):
        needed = np.unique(tables[i][0][keep[i]] >> BITS)
        keep[i - 1][_find(tables[i - 1][0], needed)[0]] = True
    for i, (context, total, owner, codes, p) in enumerate(tables):
        mine = keep[i][owner]
        codes = np.concatenate([codes[mine], (context[keep[i]] << BITS) | BACK])
        yield i + 2, codes, np.log10(np.concatenate([p[mine], PRIOR / (total[keep[i]] + PRIOR)]))


class Memo:
    """Answers to the codes a process was asked for, one per slot, the last one
    stays. Each process fills its own; a copy that is sent starts empty."""

    def __init__(self):
        self.codes = self.logs = None

    def __reduce__(self):
        return Memo, ()

    def answers(self, code: np.ndarray, look_up: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """``look_up`` of all codes, asked only for distinct ones that are not here."""
        if self.codes is None:
            # logs of tables are 32-bit numbers, so nothing is rounded
            self.codes, self.logs = np.full(1 << MEMO_BITS, -1, np.int64), np.zeros(1 << MEMO_BITS, np.float32)
        slot = self._slot(code)
        out = self.logs[slot]
        missed = np.flatnonzero(self.codes[slot] != code)
        if not len(missed):
            return out
        code, slot = code[missed], slot[missed]
        new = np.unique(code)
        found = look_up(new)
        at = self._slot(new)
        self.codes[at] = new
        kept = self.codes[at] == new
        self.logs[at[kept]] = found[kept]
        answers = self.logs[slot]
        lost = np.flatnonzero(self.codes[slot] != code)  # others took their slots
        answers[lost] = found[np.searchsorted(new, code[lost])]
        out[missed] = answers
        return out

    @staticmethod
    def _slot(code: np.ndarray) -> np.ndarray:
        return ((code.view(np.uint64) * _ODD) >> np.uint64(64 - MEMO_BITS)).view(np.int64)


class SuffixTree(NamedTuple):
    """Characters and contexts. ``symbol``: symbols by character; ``extra``:
    log10 frequencies of characters among those that share a symbol; ``short``:
    log10 probabilities by one symbol of context and the next; ``table``: (group,
    depth, code, log) of longer contexts; in all ``entries`` in ``groups``."""

    symbol: np.ndarray
    extra: np.ndarray
    short: np.ndarray
    table: DataFrame
    entries: int
    groups: int

    def blocks(self) -> Iterator[Block]:
        """The parts that are sent, one after another, of some BLOCK entries."""
        passes = max(1, -(-self.entries // BLOCK))
        for i in range(passes):
            got = self.table.where(F.col("group") % passes == i).select("depth", "code", "log").toArrow()
            depth, code, log = (got.column(c).to_numpy() for c in got.column_names)
            tables = []
            for d in range(2, DEPTH + 1):
                at = np.flatnonzero(depth == d)
                at = at[np.argsort(code[at])]
                tables.append((code[at], log[at]))
            yield Block(self.symbol, self.extra, self.short, tables, self.groups, passes, i, Memo())


class Block(NamedTuple):
    """Part ``number`` of ``passes`` of a suffix tree; see there."""

    symbol: np.ndarray
    extra: np.ndarray
    short: np.ndarray
    tables: list[tuple[np.ndarray, np.ndarray]]
    groups: int
    passes: int
    number: int
    memo: Memo

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log10 probabilities of the characters of texts that are of this part.
        Equal characters after equal contexts are looked up once while the memo
        holds them."""
        chars, begin = _normal(data, offsets)
        size = np.diff(begin) - DEPTH
        owner = np.repeat(np.arange(len(size)), size)
        code = _codes(chars, begin, self.symbol)
        if self.passes > 1:
            mine = _group_of(code >> BITS * (DEPTH - 1), self.groups) % self.passes == self.number
            owner, code = owner[mine], code[mine]
        out = np.bincount(owner, self.memo.answers(code, self._logs), minlength=len(size))
        if self.number == 0:
            rare = np.flatnonzero(self.symbol[chars] == RARE)
            out += np.bincount(np.searchsorted(begin, rare, "right") - 1, self.extra[chars[rare]], minlength=len(size))
        return out

    def _logs(self, code: np.ndarray) -> np.ndarray:
        """Log10 probabilities of distinct sorted codes."""
        log = self.short[_shorter(code, DEPTH, 1)]
        left = np.arange(len(code))
        for d, (keys, logs) in enumerate(self.tables, 2):
            context = code[left] >> BITS * (DEPTH - d + 1)  # sorted, so equal ones are neighbours
            first = np.flatnonzero(np.diff(context, prepend=-1))
            at, found = _find(keys, (context[first] << BITS) | BACK)
            size = np.diff(first, append=len(left))
            left = left[np.repeat(found, size)]  # suffixes of what is retained are
            log[left] += np.repeat(logs[at[found]], size[found])
            at, found = _find(keys, _shorter(code[left], DEPTH, d))
            log[left[found]] = logs[at[found]]
        return log


def fit_suffix_tree(docs: DataFrame) -> SuffixTree:
    """Learn from all texts of ``docs`` (text); null texts are empty. Without
    rows all symbols are equally likely."""

    def tally(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.bincount(_normal(data, offsets)[0])
        found = np.flatnonzero(n)
        found = found[found > 0]
        return found, n[found]

    chars = _count(docs, tally, "characters").toPandas()
    chars = chars.sort_values(["n", "value"], ascending=[False, True])  # at most all of Unicode
    symbols = chars["value"].to_numpy(np.int64)[: ALPHABET - 2]
    rest = chars["value"].to_numpy(np.int64)[ALPHABET - 2:], chars["n"].to_numpy(np.float64)[ALPHABET - 2:]
    symbol = np.full(0x110000, RARE, np.uint8)
    symbol[0] = END
    symbol[symbols] = np.arange(1, len(symbols) + 1)
    extra = np.full(0x110000, 1.0)
    extra[rest[0]] += rest[1]
    extra = np.log10(extra / (rest[1].sum() + 0x110000)).astype(np.float32)
    shared = Shared(docs.sparkSession, symbol)

    def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(_codes(*_normal(data, offsets), shared.value), return_counts=True)

    counts = _count(docs, runs, "runs")
    # at most one row per two symbols
    last = F.shiftright("value", BITS * DEPTH) * F.lit(1 << BITS) + F.col("value").bitwiseAND(F.lit(BACK))
    pairs = counts.groupBy(last.alias("code")).agg(F.sum("n").alias("n"), F.count("*").alias("rows")).toPandas()
    table = np.zeros((1 << BITS, 1 << BITS))
    table.ravel()[pairs["code"].to_numpy(np.int64)] = pairs["n"]
    total = table.sum(1, keepdims=True)
    alone = (table.sum(0) + 1) / (table.sum() + ALPHABET)
    below = ((table + PRIOR * alone) / (total + PRIOR)).ravel()
    groups = max(32, -(-int(pairs["rows"].sum()) // GROUP))
    sent = Shared(docs.sparkSession, below)

    def fit(part: pa.Table) -> pa.Table:
        value, n = part.column("value").to_numpy(), part.column("n").to_numpy()
        found = list(_retained(value, n.astype(np.float64), sent.value))
        return pa.table({
            "group": np.full(sum(len(c) for _, c, _ in found), part.column("group")[0].as_py(), np.int64),
            "depth": np.concatenate([np.full(len(c), d, np.int32) for d, c, _ in found]),
            "code": np.concatenate([c for _, c, _ in found]),
            "log": np.concatenate([x.astype(np.float32) for _, _, x in found])})

    group = _group_of(F.shiftright("value", BITS * (DEPTH - 1)), groups).cast("long")
    made = counts.withColumn("group", group).groupBy("group").applyInArrow(
        fit, "group long, depth int, code long, log float")
    made = materialize(made, "contexts")
    return SuffixTree(symbol, extra, np.log10(below).astype(np.float32), made, made.count(), groups)


def _names(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(words(data, offsets, NOT_BLANK)[0].view(np.int64), return_counts=True)


def _partial(docs: DataFrame, block: Block) -> DataFrame:
    """(row, part): what a block adds to the scores of texts."""
    shared = Shared(docs.sparkSession, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, data, offsets in blocks(batches):
            yield {"row": batch.column("row"), "part": shared.value.score(data, offsets)}

    return map_batches(docs.select("row", "text"), run, "row long, part double")


def score_texts(docs: DataFrame, learned_from: str) -> DataFrame:
    """Score ``docs`` (doc_id, text), learning from rows where the SQL
    condition ``learned_from`` holds.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text is
    its words and one end. Returns doc_id, held_out (not learned from), n_tokens,
    n_known (tokens seen in training), train_tokens, base_score (log10, word
    frequencies with one added) and score (log10, the suffix tree).

    Null and empty texts are just an end. Each row is scored on its own; equal
    rows get equal scores. Without training rows no token is known and base
    scores are zero. Words are known by 64-bit hashes.
    """
    docs = pick(docs, "doc_id", "text").withColumn("held_out", ~F.coalesce(F.expr(learned_from), F.lit(False)))
    train = docs.where(~F.col("held_out"))
    counts = _count(train, _names, "words")
    texts = train.count()
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = n + texts, v + (texts > 0)
    floor = np.log10(n + v + 1.0)
    head = counts.where(F.col("n") >= max(1.0, HEAD_SHARE * n)).toPandas().sort_values("value")
    fitted = fit_suffix_tree(train)
    parts = fitted.blocks()
    shared = Shared(docs.sparkSession, (
        next(parts), head["value"].to_numpy(np.int64), head["n"].to_numpy(np.int64)))
    again = fitted.entries > BLOCK
    if again:  # more blocks are to score the same rows
        docs = materialize(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    else:
        docs = docs.withColumn("row", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tree, known, often = shared.value
        logs = np.log10(often + 1.0)
        for batch, data, offsets in blocks(batches):
            names, first, _ = words(data, offsets, NOT_BLANK)
            names = names.view(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
            at = np.minimum(np.searchsorted(known, names), max(len(known) - 1, 0))
            own = known[at] == names if len(known) else np.zeros(len(names), bool)
            size = np.diff(first)
            yield {
                "row": batch.column("row"),
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "n_tokens": size + 1,
                "n_known": np.bincount(owner[own], minlength=batch.num_rows) + int(texts > 0),
                "base": np.bincount(owner[own], logs[at[own]], minlength=batch.num_rows) + np.log10(texts + 1.0),
                "score": tree.score(data, offsets),
                "others": ragged(names[~own], np.bincount(owner[~own], minlength=batch.num_rows)),
            }

    scored = map_batches(docs.select("row", "doc_id", "text", "held_out"), run, (
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, others array<long>"))
    scored = materialize(scored, "scored")
    shared.sent.unpersist()
    further = None
    for part in parts:
        one = materialize(_partial(docs, part), "partial")
        further = one if further is None else further.unionByName(one)
    rest = counts.where(F.col("n") < max(1.0, HEAD_SHARE * n))
    tail = scored.select("row", F.explode("others").alias("value")).join(rest, "value").groupBy("row").agg(
        F.count("*").alias("more"), F.sum(F.log10(F.col("n") + F.lit(1.0))).alias("add"))
    out = scored.drop("others").join(tail, "row", "left")
    if further is not None:
        sums = further.groupBy("row").agg(F.sum("part").alias("part"))
        out = out.join(sums, "row").withColumn("score", F.col("score") + F.col("part"))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("add", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(floor))).alias("base_score"),
        "score")


def training_condition(parts: int, held_out: int) -> str:
    """A SQL condition: the CRC of the id as text is not ``held_out`` modulo ``parts``."""
    return f"crc32(coalesce(cast(doc_id AS string), '')) % {parts} <> {held_out}"
