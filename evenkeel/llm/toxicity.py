"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes.

A text is the set of its words and of their runs of 4 to 8 letters, boundaries
included, and of the first 3 to 9 letters of each word, hashed to BUCKETS numbers;
in scripts that set no spaces between words, of its runs of 2 to 10 characters. Each
is scaled by its log-count ratio, the log of how much more often toxic texts hold it
than others. Logistic regression is fitted on the scaled sets; ratio times
coefficient is the weight of a part.

The classifier is fitted on a sample of labelled texts of bounded size. Scoring
reads all texts, with one small array of weights.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.texts import Shared, _tables, blocks, carrying, checked, fold, grams, letters, map_batches, mixed, pick
from evenkeel.sources.shared import materialize

BITS = 20
#: Runs from the beginning of a word on, and those that are parts anywhere in it.
ORDERS, INNER, BUCKETS = tuple(range(4, 11)), tuple(range(4, 9)), 1 << BITS
#: Scripts without spaces between words (first and last character), and the
#: shorter runs that are parts there too.
UNSPACED, SHORT = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)), (2, 3)
#: Labelled texts that the classifier is fitted on, at most.
SAMPLE = 8_000
#: Parts with ratios below or in fewer texts are no evidence and are left out.
#: Parts, ratio and penalty were chosen by cross-validation in the training folds.
LEAST_RATIO, LEAST_TEXTS, SMOOTHING = 2.0, 5, 2.0
PENALTY, ROUNDS = 0.003, 40


def _features(
    data: np.ndarray, offsets: np.ndarray, asked: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs, sorted; only of buckets ``asked`` for (a
    flag each), if given."""
    chars, begin = letters(data, offsets, max(ORDERS) - 1)
    owner = np.repeat(np.arange(len(offsets) - 1) << 32, np.diff(begin))
    blank, dense = chars == 32, np.zeros(len(chars), bool)
    for low, high in UNSPACED if len(chars) and chars.max() >= UNSPACED[0][0] else ():
        dense |= (chars >= low) & (chars <= high)
    blanks = np.concatenate([[0], np.cumsum(blank)])
    parts = []

    def add(at: np.ndarray, hashes: np.ndarray) -> None:
        bucket = _bucket(hashes)
        if asked is not None:
            some = asked[bucket]
            at, bucket = at[some], bucket[some]
        parts.append(owner[at] | bucket)

    for k in (*SHORT, *ORDERS):
        n = len(chars) - k + 1
        if n <= 0:
            continue
        begins = dense[:n] & ~blank[k - 1:]  # so that no part holds two texts' letters
        if k in INNER:
            begins = np.ones(n, bool)
        elif k in ORDERS:
            begins |= blank[:n]
        at = np.flatnonzero(begins & (blanks[k - 1: k - 1 + n] == blanks[1: n + 1]))
        add(at, grams(chars, k)[at] if k in INNER else grams(chars, k, at))
    ends = np.flatnonzero(blank)
    low, high = ends[:-1], ends[1:]
    low, high = low[high - low > 1], high[high - low > 1]
    power, inverse = _tables(len(chars))
    total = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum(mixed(chars.astype(np.uint64)) * power[: len(chars)], out=total[1:])
    add(low, mixed((total[high] - total[low + 1]) * inverse[low]))
    pairs = np.sort(np.concatenate(parts))
    pairs = pairs[np.flatnonzero(np.diff(pairs, prepend=-1))]
    return pairs >> 32, pairs & 0xFFFFFFFF


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic) of at most ``sample`` labelled documents.

    Labels of the held-out fold, null labels and null ids are left out; several
    labels of an id count as the largest. Those of the smallest hashes are
    taken, so the choice does not depend on partitions. A document that repeats
    an id gives a row each.
    """
    rows = pick(labels, "doc_id", "toxic").where(fold("doc_id", 5) != 0).where("toxic IS NOT NULL")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("key", F.xxhash64("doc_id"))
    n = rows.count()
    share = min(1.0, 2 * sample / max(n, 1))  # so that few rows are sorted
    few = rows.where(F.pmod("key", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("key", "doc_id").limit(sample)
    # the sample is small by its definition
    return pick(docs, "doc_id", "text").join(F.broadcast(few), "doc_id").select("doc_id", "text", "toxic")


def fit_toxicity(rows: DataFrame) -> tuple[np.ndarray, float]:
    """Weights of all buckets and the intercept, from ``rows`` (text, toxic)."""
    spark = rows.sparkSession

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, data, offsets in blocks(batches):
            owner, bucket = _features(data, offsets)
            cuts = np.searchsorted(owner, np.arange(1, batch.num_rows))
            yield {"toxic": batch.column("toxic"), "buckets": pa.array(
                np.split(bucket.astype(np.int32), cuts), pa.list_(pa.int32()))}

    toxic = (F.col("toxic") > 0).cast("int").alias("toxic")
    sets = materialize(map_batches(rows.select("text", toxic), read, "toxic int, buckets array<int>"), "toxic-sets")
    n, bad = sets.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if bad in (0, n):  # nothing to tell apart
        return np.zeros(BUCKETS), 0.0 if not n else (20.0 if bad else -20.0)
    counts = sets.select("toxic", F.explode("buckets").alias("b")).groupBy("b").agg(
        F.sum("toxic").alias("bad"), F.count("*").alias("n")).where(F.col("n") >= LEAST_TEXTS).toPandas()
    p, q = np.zeros(BUCKETS), np.zeros(BUCKETS)
    p[counts["b"]], q[counts["b"]] = counts["bad"], counts["n"] - counts["bad"]
    # smoothed in proportion to the classes, so that an unseen n-gram says nothing
    ratio = np.log((p + SMOOTHING * bad / n) / bad) - np.log((q + SMOOTHING * (n - bad) / n) / (n - bad))
    ratio[(np.abs(ratio) < LEAST_RATIO) | (p + q < LEAST_TEXTS)] = 0
    used = np.flatnonzero(ratio)
    if not len(used):  # nothing tells them apart
        return np.zeros(BUCKETS), float(np.log(bad / (n - bad)))
    shared = Shared(spark, (used, ratio[used]))

    @F.udf(VectorUDT())
    def scaled(buckets: list[int]) -> SparseVector:
        used, scale = shared.value
        own = np.isin(used, np.array(buckets or [], np.int64), assume_unique=True)
        at = np.flatnonzero(own)
        return SparseVector(len(used), at, scale[at])

    known = sets.select(scaled("buckets").alias("features"), F.col("toxic").cast("double").alias("label"))
    learner = LogisticRegression(regParam=PENALTY, maxIter=ROUNDS, standardization=False)
    model = learner.fit(known)
    weights = np.zeros(BUCKETS)
    weights[used] = ratio[used] * model.coefficients.toArray()
    return weights, float(model.intercept)


def score_toxicity(
    docs: DataFrame, weights: np.ndarray, intercept: float, carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Score ``docs`` (text): the ``carry`` columns, score (0 to 1) and
    predicted (1 from 0.5 on).

    Null and empty texts have no parts and get the score of the intercept.
    Texts are judged whole and each on its own; repeated rows get equal scores.
    """
    checked(carry, {"score", "predicted"})
    docs = pick(docs, *dict.fromkeys([*carry, "text"]))
    shared = Shared(docs.sparkSession, (weights, weights != 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch, data, offsets in blocks(batches):
            weights, asked = shared.value
            owner, bucket = _features(data, offsets, asked)
            total = np.bincount(owner, weights[bucket], minlength=batch.num_rows) + intercept
            score = 1 / (1 + np.exp(-np.clip(total, -500, 500)))
            yield {c: batch.column(c) for c in carry} | {
                "score": score, "predicted": (score >= 0.5).astype(np.int32)}

    return map_batches(docs, run, carrying(docs, carry, "score double, predicted int"))
