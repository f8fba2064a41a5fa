import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from evenkeel.llm import jaccard, suffix_tree, texts
from evenkeel.llm.decontaminate import decontaminate


def test_tiles_of_long_sets_are_small(spark, monkeypatch):
    sets = spark.range(12).selectExpr("id AS class", "transform(sequence(0, 99), x -> x * 7 + id % 3 * 10000) AS tokens")
    members = sets.selectExpr("1L AS block", "class", "100L AS n", "class + 1 AS copies")

    def links():
        return jaccard._inner_links(members, sets, 85).groupBy("class").agg(
            F.sum("links").alias("links"), F.min("leader").alias("leader"), F.count("*").alias("tiles")).collect()

    one = {r["class"]: (r["links"], r["leader"], r["tiles"]) for r in links()}
    monkeypatch.setattr(jaccard, "TILE_TOKENS", 300)
    many = {r["class"]: (r["links"], r["leader"], r["tiles"]) for r in links()}
    for c in range(12):
        others = [d for d in range(12) if d % 3 == c % 3 and d != c]
        assert one[c] == (sum(d + 1 for d in others), c % 3, 1)
        assert many[c][0] == one[c][0] and many[c][2] > 1
    assert min(leader for _, leader, _ in many.values()) == 0


def test_kept_answers_of_few_slots(monkeypatch):
    monkeypatch.setattr(suffix_tree, "MEMO_BITS", 6)
    memo, asked = suffix_tree.Memo(), []

    def look_up(codes):
        asked.append(codes)
        return (codes / 3).astype(np.float32)

    draws = np.random.default_rng(5)
    for _ in range(20):
        codes = draws.integers(0, 500, 1000)
        assert (memo.answers(codes, look_up) == (codes / 3).astype(np.float32)).all()
    assert all((np.diff(codes) > 0).all() for codes in asked)
    before = len(asked)
    memo.answers(codes[:1].repeat(9), look_up)
    memo.answers(codes[:1], look_up)
    assert len(asked) <= before + 1 and memo.logs.dtype == np.float32


def test_items_are_hashed_by_tasks(spark, monkeypatch):
    monkeypatch.setattr(texts, "_kept", texts._Kept())
    docs = spark.createDataFrame([(1, "so One two, three four!"), (2, ""), (3, "three two one")], "doc_id long, text string")
    items = [("none", ""), ("null", None), ("b", "one two three"), (None, "two one")]
    bench = spark.createDataFrame(items, "item_id string, text string").repartition(4)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate(docs, bench).collect()} == {
        1: (5, 3, 1), 2: (0, 0, 0), 3: (3, 2, 1)}
    assert not texts._kept  # the driver made no tables of its own


def test_words_of_empty_texts(monkeypatch):
    monkeypatch.setattr(texts, "_kept", texts._Kept())
    hashes, first, begins = texts.words(np.zeros(0, np.uint8), np.zeros(3, np.int64), texts.NOT_BLANK)
    assert not len(hashes) and not len(begins) and first.tolist() == [0, 0, 0]


def test_workers_keep_one_shared_object(spark):
    one, two = texts.Shared(spark, np.arange(5)), texts.Shared(spark, np.arange(9))

    def look(batches):
        for _ in batches:
            total = one.value.sum() + two.value.sum()
            held = [name for x in (one, two) for name in ("loaded", "_value") if name in vars(x.sent)]
            yield {"total": [total + one.value.sum()], "held": [len(held)]}

    seen = texts.map_batches(spark.range(1).repartition(1), look, "total long, held int").collect()
    assert [tuple(r) for r in seen] == [(10 + 36 + 10, 1)]


def test_sets_take_little_memory(monkeypatch):
    monkeypatch.setattr(texts, "_kept", texts._Kept())
    batch = pa.record_batch({"text": [f"one text number {i} of ten words and some letters" for i in range(40_000)]})
    tracemalloc.start()
    try:
        n = sum(len(sets) for _, sets in jaccard._sets([batch], 4))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 40_000 and peak < 48 << 20
