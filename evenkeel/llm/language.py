"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of order ORDER over lower-case letters and word
boundaries, with the counts of a sample of its texts. All models share sorted
arrays of n-gram hashes, one per order, with a row of log probabilities, one per
language; where a language lacks an n-gram that another has, its row holds what
it backs off to. A text goes to the language of the lowest cross-entropy per
character. A part of the sample is kept out of the counts: it sets the
temperature of the score and how far above its usual cross-entropy a language
may be before the text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evenkeel.llm.texts import Shared, blocks, carrying, checked, fold, grams, letters, map_batches, pick, spans

ORDER = 4
#: Texts per language that a model learns from; a quarter sets thresholds.
SAMPLE, KEPT_OUT = 600, 4
UNKNOWN = "und"
#: Bits per character above the usual that are never a reason to reject.
TOLERANCE = 0.75


def _find(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in sorted keys, and which were found."""
    if not len(keys):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return at, keys[at] == values


class LanguageModel:
    """Kneser-Ney models of several languages.

    ``counts``: per language its n-grams (a matrix of ORDER characters each)
    and how often each occurs.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.names = sorted(counts)
        self.temperature, self.usual, self.spread = 1.0, np.zeros(len(counts)), np.zeros(len(counts))
        symbols = {int(c) for rows, _ in counts.values() for c in np.unique(rows)}
        floor = -np.log2(len(symbols) + 1.0)
        raw = [self._orders(*counts[name]) for name in self.names]
        self.floor, below = floor, None
        self.keys, self.rows, self.contexts, self.weights = [], [], [], []
        for k in range(1, ORDER + 1):
            matrix = np.concatenate([r[k][0] for r in raw]) if raw else np.zeros((0, k), np.uint32)
            keys, first = np.unique(self._hash(matrix), return_index=True)
            matrix = matrix[first]
            ctx_keys = np.unique(self._hash(matrix[:, :-1]))
            rows = np.zeros((len(keys), len(self.names)), np.float32)
            weights = np.zeros((len(ctx_keys), len(self.names)), np.float32)
            for l, orders in enumerate(raw):
                grams_l, c = orders[k]
                d = self._discount(c)
                ctx, of = np.unique(self._hash(grams_l[:, :-1]), return_inverse=True)
                total, types = np.bincount(of, c), np.bincount(of)
                lam = np.maximum(d * types / np.maximum(total, 1), 1e-9)
                weights[_find(ctx_keys, ctx)[0], l] = np.log2(lam)
                lower = np.full(len(keys), floor) if below is None else below(matrix[:, 1:])[:, l]
                at, own = _find(ctx, self._hash(matrix[:, :-1]))
                backed = lower + (np.where(own, np.log2(lam[at]), 0.0) if len(ctx) else 0.0)
                rows[:, l] = backed
                place = _find(keys, self._hash(grams_l))[0]
                rows[place, l] = np.log2(np.maximum(c - d, 0) / total[of] + 2.0 ** backed[place])
            self.keys.append(keys)
            self.rows.append(rows)
            self.contexts.append(ctx_keys)
            self.weights.append(weights)
            below = self._lookup_rows

    @staticmethod
    def _orders(rows: np.ndarray, n: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Counts of the highest order, and below it the number of different
        characters that come before an n-gram."""
        out = {ORDER: (rows, n.astype(np.float64))}
        for k in range(ORDER - 1, 0, -1):
            shorter, c = np.unique(out[k + 1][0][:, 1:], axis=0, return_counts=True)
            out[k] = shorter, c.astype(np.float64)
        return out

    @staticmethod
    def _discount(c: np.ndarray) -> float:
        once, twice = np.sum(c == 1), np.sum(c == 2)
        return once / (once + 2 * twice) if once and twice else 0.5

    @staticmethod
    def _hash(matrix: np.ndarray) -> np.ndarray:
        k = matrix.shape[1]
        if not k:
            return np.zeros(len(matrix), np.uint64)
        return grams(matrix.ravel(), k)[::k] if len(matrix) else np.zeros(0, np.uint64)

    def _lookup_rows(self, matrix: np.ndarray) -> np.ndarray:
        width = matrix.shape[1]
        last = {k: self._hash(matrix[:, width - k:]) for k in range(1, width + 1)}
        context = {k: self._hash(matrix[:, width - k: width - 1]) for k in range(1, width + 1)}
        return self._lookup(last, context, width)

    def _lookup(self, last: dict, context: dict, order: int) -> np.ndarray:
        """Log probabilities by language. last[k]: hashes of the last k
        characters; context[k]: of those without the last one."""
        out = np.zeros((len(last[order]), len(self.names)), np.float32)
        left = np.arange(len(out))
        for k in range(order, 0, -1):
            at, own = _find(self.keys[k - 1], last[k][left])
            out[left[own]] += self.rows[k - 1][at[own]]
            left = left[~own]
            if not len(left):
                break
            at, own = _find(self.contexts[k - 1], context[k][left])
            out[left[own]] += self.weights[k - 1][at[own]]
        out[left] += np.float32(self.floor)  # a character that no language has
        return out

    def entropies(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text under each language, and the number
        of characters (letters and the boundaries between them)."""
        chars, begin = letters(data, offsets, ORDER - 1)
        hashes = {k: grams(chars, k) for k in range(1, ORDER + 1)}
        sums = np.zeros((len(offsets) - 1, len(self.names)))
        n = np.diff(begin) - (ORDER - 1)
        scored = np.repeat(np.arange(len(n)), n)
        place = spans(begin[:-1] + ORDER - 1, n)
        step = max(1, (1 << 20) // max(1, len(self.names)))
        for low in range(0, len(place), step):
            p, t = place[low: low + step], scored[low: low + step]
            last = {k: hashes[k][p - k + 1] for k in range(1, ORDER + 1)}
            context = {k: hashes[k - 1][p - k + 1] for k in range(2, ORDER + 1)}
            context[1] = np.zeros(len(p), np.uint64)
            rows = self._lookup(last, context, ORDER)
            cuts = np.flatnonzero(np.diff(t, prepend=t[:1] - 1))
            if len(cuts):
                sums[t[cuts]] += np.add.reduceat(rows, cuts, axis=0, dtype=np.float64)
        return -sums / np.maximum(n, 1)[:, None], n - 1

    def calibrate(self, bits: np.ndarray, n: np.ndarray, truth: np.ndarray) -> None:
        """Learn from texts of known languages that were not counted."""
        use = n > 0
        bits, n, truth = bits[use], n[use], truth[use]
        if not len(n):
            self.usual[:], self.spread[:] = np.inf, 0
            return
        own = bits[np.arange(len(n)), truth]
        best = None
        for t in 2.0 ** np.arange(-2, 7):
            z = -t * bits
            z -= z.max(1, keepdims=True)
            loss = np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(n)), truth])
            if best is None or loss < best:
                best, self.temperature = loss, float(t)
        for l in range(len(self.names)):
            mine = truth == l
            if mine.any():
                self.usual[l] = np.median(own[mine])
                self.spread[l] = np.max((own[mine] - self.usual[l]) * np.sqrt(n[mine]), initial=0.0)
            else:
                self.usual[l] = np.inf

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> dict:
        bits, n = self.entropies(data, offsets)
        if not self.names:
            return {"lang_pred": [UNKNOWN] * len(n), "score": np.zeros(len(n)),
                    "bits": np.zeros(len(n)), "rejected": np.ones(len(n), bool)}
        best = bits.argmin(1)
        z = -self.temperature * bits
        p = np.exp(z - z.max(1, keepdims=True))
        own = bits[np.arange(len(n)), best]
        far = own - self.usual[best] > TOLERANCE + 1.5 * self.spread[best] / np.sqrt(np.maximum(n, 1))
        known = n > 0
        return {
            "lang_pred": [self.names[b] if k else UNKNOWN for b, k in zip(best, known)],
            "score": np.where(known, p.max(1) / p.sum(1), 0.0), "bits": np.where(known, own, 0.0),
            "rejected": far | ~known,
        }


def fit_language(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """Learn from ``docs`` (text, lang) where lang is not null.

    At most ``sample`` different texts per language, those of the smallest
    hashes; the rest of the table is not needed for a model of this order. Texts
    are whole, and copies of a text count once.
    """
    rows = pick(docs, "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.withColumn("key", F.xxhash64("lang", "text"))
    # languages are few: each is a column of the model
    sizes = F.broadcast(rows.groupBy("lang").agg(F.approx_count_distinct("key").alias("texts")))
    place = F.col("key") / F.lit(2.0**64) + 0.5  # of the hash among all hashes
    low = rows.select("lang", "key").join(sizes, "lang").where(place * F.col("texts") < 4.0 * sample + 100)
    least = W.partitionBy("lang").orderBy("key")
    keys = low.select("lang", "key").distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= sample)
    # the sample is small by its definition: ``sample`` keys per language
    chosen = rows.join(F.broadcast(keys), ["lang", "key"])
    chosen = chosen.groupBy("lang", "key").agg(F.any_value("text").alias("text"), F.any_value("n").alias("n"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, data, offsets in blocks(batches):
            lang = np.array(batch.column("lang").to_pylist(), dtype=object)
            chars, begin = letters(data, offsets, ORDER - 1)
            h = grams(chars, ORDER)
            n = np.maximum(np.diff(begin) - (ORDER - 1), 0)
            place = spans(begin[:-1] + ORDER - 1, n)
            owner = np.repeat(np.arange(len(n)), n)
            for name in np.unique(lang.astype(str)):
                at = place[(lang == name)[owner]] - (ORDER - 1)
                if len(at):
                    _, first, c = np.unique(h[at], return_index=True, return_counts=True)
                    rows = chars[at[first][:, None] + np.arange(ORDER)]
                    text = rows.astype("<u4").tobytes().decode("utf-32-le")
                    yield {"lang": [name] * len(c), "gram": [text[i: i + ORDER] for i in range(0, len(text), ORDER)],
                           "n": c.astype(np.int64)}

    # the first text of a language is always counted, so that none is left out of the model
    kept_out = (F.pmod(F.shiftright("key", 8), F.lit(KEPT_OUT)) == 0) & (F.col("n") > 1)
    counted = map_batches(chosen.where(~kept_out).select("text", "lang"), count, "lang string, gram string, n long")
    table = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    model = LanguageModel({
        name: (np.frombuffer("".join(g["gram"]).encode("utf-32-le"), np.uint32).reshape(-1, ORDER), g["n"].to_numpy())
        for name, g in table.groupby("lang")})
    shared = Shared(docs.sparkSession, model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, data, offsets in blocks(batches):
            bits, n = shared.value.entropies(data, offsets)
            yield {"lang": batch.column("lang"), "n": n, "bits": pa.array(list(bits), pa.list_(pa.float64()))}

    held = map_batches(chosen.where(kept_out).select("text", "lang"), measure, "lang string, n long, bits array<double>")
    seen = held.toPandas()
    seen = seen[seen["lang"].isin(model.names)]
    index = {name: i for i, name in enumerate(model.names)}
    model.calibrate(
        np.array(seen["bits"].tolist()).reshape(len(seen), len(model.names)), seen["n"].to_numpy(),
        seen["lang"].map(index).to_numpy(np.int64))
    return model


def identify(docs: DataFrame, model: LanguageModel, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The language of ``docs`` (text): the ``carry`` columns, lang_pred,
    score (0 to 1), bits (per character) and rejected.

    Texts that are null or have no letter are 'und' with a score of 0, and
    rejected; others get the nearest language, and are rejected if they are
    unlike all that was learned. A model of no languages calls all 'und'. On
    ties the first language by name counts. Repeated rows are judged alike.
    """
    checked(carry, {"lang_pred", "score", "bits", "rejected"})
    docs = pick(docs, *dict.fromkeys([*carry, "text"]))
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, data, offsets in blocks(batches):
            yield {c: batch.column(c) for c in carry} | shared.value.predict(data, offsets)

    return map_batches(docs, run, carrying(docs, carry, "lang_pred string, score double, bits double, rejected boolean"))


def training_rows(docs: DataFrame) -> DataFrame:
    """Documents whose language may be learned from."""
    return pick(docs, "doc_id", "text", "lang").where(fold("doc_id", 5) != 0)
