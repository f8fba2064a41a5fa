import hashlib
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import evenkeel as ek
from evenkeel.operators import sampling


def order(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


def ids(df, name="id"):
    return sorted(r[name] for r in df.select(name).collect())


def test_rank_is_a_permutation(spark):
    df = spark.range(5000).repartition(7)
    got = {r["id"]: r["rank"] for r in ek.exact_rank(df, ["id"]).collect()}
    assert got == {k: i for i, k in enumerate(order(range(5000)), 1)}


def test_rank_by_group_keeps_null_groups(spark):
    df = spark.range(300).withColumn("g", F.when(F.col("id") % 3 > 0, F.concat(F.lit("g"), F.col("id") % 3)))
    rows = ek.exact_rank(df, ["id"], by=["g"]).collect()
    for g in ("g1", "g2", None):
        part = {r["id"]: r["rank"] for r in rows if r["g"] == g}
        assert part == {k: i for i, k in enumerate(order(part), 1)}
    assert len(rows) == 300


@pytest.mark.parametrize("limit", [100_000, 5])
def test_cuts(spark, monkeypatch, limit):
    """Also with a limit that forces several counting passes."""
    monkeypatch.setattr(sampling, "BOUNDARY_ROWS", limit)
    monkeypatch.setattr(sampling, "PREFIX_STEP", 1)
    df = spark.range(700)
    wanted = [0, 1, 2, 350, 351, 699, 700, 9000, -4]
    n, cuts = sampling.hash_cuts(df, ["id"], 42, lambda n: wanted)
    assert n == 700
    for k, cut in zip(wanted, cuts, strict=True):
        kept = df.filter(sampling.row_hash(["id"], 42) <= cut)
        assert ids(kept) == sorted(order(range(700))[: max(k, 0)])


def test_keys_must_tell_rows_apart(spark, monkeypatch):
    df = spark.createDataFrame([(1,)] * 50, "k int")
    with pytest.raises(ek.ValidationError, match="tell rows apart"):
        ek.cap_rows(df, 10, ["k"])
    monkeypatch.setattr(sampling, "BOUNDARY_ROWS", 5)
    with pytest.raises(ek.ValidationError, match="tell rows apart"):
        ek.cap_rows(df, 10, ["k"])


@pytest.mark.parametrize("n", [4, 7, 100, 1001])
def test_split_partitions_the_table(spark, n):
    df = spark.range(n)
    splits = ek.train_val_test_split(df, ["id"])
    parts = {name: ids(frame) for name, frame in splits.items()}
    assert {k: len(v) for k, v in parts.items()} == dict(splits.sizes)
    assert sorted(sum(parts.values(), [])) == list(range(n))
    ranks = order(range(n))
    assert parts["train"] == sorted(ranks[: splits.sizes["train"]])
    labels = Counter(r["split"] for r in ek.split_labels(df, ["id"]).collect())
    assert dict(labels) == {k: v for k, v in splits.sizes.items() if v}


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(500).withColumn("t", F.concat(F.lit("x"), F.col("id") % 9))
    a = ek.train_val_test_split(df.repartition(1), ["id"])
    b = ek.train_val_test_split(df.orderBy(F.desc("t")).repartition(6), ["id"])
    for (_, x), (_, y) in zip(a.items(), b.items(), strict=True):
        assert ids(x) == ids(y)
    c = ek.train_val_test_split(df, ["id"], seed=1)
    assert ids(c.test) != ids(a.test)


def test_split_sizes():
    # Rows, then sizes of train, val, test.
    for n, sizes in {1000: (700, 150, 150), 2: (1, 1, 0), 3: (2, 1, 0), 4: (2, 1, 1), 10: (7, 1, 2)}.items():
        assert ek.split_sizes(n, 0.15, 0.15) == sizes
    for n in (0, 1):
        with pytest.raises(ek.ValidationError):
            ek.split_sizes(n, 0.15, 0.15)
    assert ek.split_sizes(10, 0.0, 0.0) == (10, 0, 0)


@given(st.integers(2, 10**12), st.floats(0.0, 0.45), st.floats(0.0, 0.45))
def test_split_sizes_add_up(n, test, val):
    try:
        parts = ek.split_sizes(n, test, val)
    except ek.ValidationError:
        return
    assert sum(parts) == n
    assert min(parts) >= 0
    assert parts[0] >= 1


def test_split_without_key(spark):
    """A third of the rows are equal; copies spread over the splits."""
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("t"),
        F.when(F.col("id") % 3 != 0, F.col("id") * 0.5).alias("x"),
    )
    splits = ek.train_val_test_split(df)
    assert dict(splits.sizes) == {"train": 630, "val": 135, "test": 135}
    parts = [Counter((r["t"], r["x"]) for r in f.collect()) for _, f in splits.items()]
    assert sum(parts, Counter()) == Counter((r["t"], r["x"]) for r in df.collect())
    assert all(p["same", None] > 20 for p in parts)
    assert splits.train.columns == ["t", "x"]
    again = ek.train_val_test_split(df.repartition(5, "x"))
    assert Counter(map(tuple, again.test.collect())) == Counter(map(tuple, splits.test.collect()))


def test_copies_of_very_common_rows(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPY_CHUNK", 4)
    monkeypatch.setattr(sampling, "RARE_COPIES", 1)
    df = spark.createDataFrame([("a",)] * 11 + [("b",)] * 4 + [("c",)], "t string")
    got = sorted(map(tuple, ek.with_copy_numbers(df).collect()))
    assert got == [("a", i) for i in range(1, 12)] + [("b", i) for i in range(1, 5)] + [("c", 1)]
    nested = df.withColumn("l", F.array("t"))
    with pytest.raises(ek.ValidationError, match="nested"):
        ek.with_copy_numbers(nested)


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_copies_however_many_rows_repeat(spark, monkeypatch, most):
    monkeypatch.setattr(sampling, "BROADCAST_DIGESTS", most)
    rows = [(0.0, None), (-0.0, None), (1.0, "a"), (None, None), (None, "a")] + [(2.0, "b")] * 30
    df = spark.createDataFrame(rows, "x double, t string")
    got = Counter((str(r["x"]), r["t"], r["copy_no"]) for r in ek.with_copy_numbers(df).collect())
    want = [(str(x), t, 1) for x, t in rows[:5]] + [("2.0", "b", i) for i in range(1, 31)]
    assert got == Counter(want)
    assert ek.with_copy_numbers(df.limit(0)).count() == 0


def test_single_rows_are_not_shuffled(spark):
    plan = ek.with_copy_numbers(spark.range(100))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_times_of_a_repeated_hour_differ(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Vienna")
    try:
        # 02:30 before and after clocks go back
        df = spark.createDataFrame([(1729989000,), (1729992600,)], "s long").selectExpr("timestamp_seconds(s) AS t")
        assert [r["copy_no"] for r in ek.with_copy_numbers(df).collect()] == [1, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_cap(spark):
    assert ids(ek.cap_rows(spark.range(100), 30, ["id"])) == sorted(order(range(100))[:30])
    assert ek.cap_rows(spark.range(20), 30, ["id"]).count() == 20
    assert ek.cap_rows(spark.range(20), 0, ["id"]).count() == 0
    twice = spark.createDataFrame([("a",)] * 8, "t string")
    assert ek.cap_rows(twice, 5).count() == 5


def test_shuffle(spark):
    got = [r["id"] for r in ek.shuffle(spark.range(200), ["id"]).collect()]
    assert got == order(range(200))
    same = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2, "t string")
    assert Counter(r[0] for r in ek.shuffle(same).collect()) == {"a": 3, "b": 2}


def test_draws(spark, monkeypatch):
    df = spark.range(134)
    drawn = ek.draw_with_replacement(df, 952, ["id"])
    rows = [tuple(r) for r in drawn.collect()]
    assert len(rows) == 952 == len(set(rows))
    ranks = order(range(134))
    want = Counter(
        ranks[int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:15], 16) % 134] for i in range(1, 953)
    )
    assert Counter(i for i, _ in rows) == want
    assert sorted(rows) == sorted(map(tuple, ek.draw_with_replacement(df.repartition(9), 952, ["id"]).collect()))
    assert ek.draw_with_replacement(df, 0, ["id"]).count() == 0
    with pytest.raises(ek.ValidationError):
        ek.draw_with_replacement(df.limit(0), 5, ["id"])
    one = ek.draw_with_replacement(spark.range(1), 1234, ["id"])
    assert sorted(r["draw_no"] for r in one.collect()) == list(range(1, 1235))
