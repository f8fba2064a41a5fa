from collections import Counter

import pytest

import evenkeel as ek
from evenkeel.operators import mitigate


def over(df, **kw):
    return ek.oversample(df, ["sensitive_attr"], "target", **kw)


def plan(df):
    rows = ek.oversample_plan(df, ["sensitive_attr"], "target").collect()
    return {r["sensitive_attr"]: r["n_to_add"] for r in rows}


def test_two_groups(rows_from_counts):
    df = rows_from_counts([("a", 20, 10), ("b", 20, 4)])
    assert plan(df) == {"a": 0, "b": 12}
    out = over(df, key=["id"]).collect()
    added = [r for r in out if r["draw_no"]]
    assert len(added) == 12
    assert {(r["sensitive_attr"], r["target"]) for r in added} == {("b", 1)}
    assert len({(r["id"], r["draw_no"]) for r in out}) == len(out) == 52


def test_every_group_is_raised_to_the_best(rows_from_counts):
    df = rows_from_counts([("a", 100, 60), ("b", 100, 20), ("c", 50, 25), ("d", 10, 6)])
    assert plan(df) == {"a": 0, "b": 100, "c": 12, "d": 0}
    rates = ek.group_rates(over(df, key=["id"]), ["sensitive_attr"], "target").collect()
    assert max(abs(r["rate"] - 0.6) for r in rates) < 1 / 50


def test_nothing_to_do(rows_from_counts):
    equal = rows_from_counts([("a", 10, 5), ("b", 20, 10)])
    assert plan(equal) == {"a": 0, "b": 0}
    assert over(equal, key=["id"]).count() == 30
    one = rows_from_counts([("a", 10, 5)])
    assert over(one, key=["id"]).count() == 10
    full = rows_from_counts([("a", 10, 10), ("b", 10, 5)])
    assert plan(full) == {"a": 0, "b": 0}


def test_tiny_gap_counts_as_equal(spark):
    rows = [("a", 2_000_000, 1_000_000), ("b", 2_000_000, 999_999)]
    rates = spark.createDataFrame(rows, "sensitive_attr string, n long, positives long")
    rates = rates.withColumn("rate", rates.positives / rates.n)
    assert {r["n_to_add"] for r in mitigate._plan(rates).collect()} == {0}


def test_errors(rows_from_counts, spark):
    with pytest.raises(ek.ValidationError, match="none to copy"):
        over(rows_from_counts([("a", 10, 5), ("b", 10, 0)]), key=["id"])
    bad = spark.createDataFrame([("a", 2), ("b", 1)], "sensitive_attr string, target int")
    with pytest.raises(ek.ValidationError, match="other than 0 or 1"):
        over(bad)
    gap = spark.createDataFrame([("a", None), ("b", 1)], "sensitive_attr string, target int")
    with pytest.raises(ek.ValidationError, match="other than 0 or 1"):
        over(gap)


def test_null_groups_stay_but_are_not_drawn(spark):
    rows = [(i, g, y) for i, (g, y) in enumerate(
        [("a", 1)] * 5 + [("a", 0)] * 5 + [("b", 1)] * 2 + [("b", 0)] * 8 + [(None, 1)] * 3
    )]
    df = spark.createDataFrame(rows, "id int, sensitive_attr string, target int")
    out = over(df, key=["id"])
    groups = Counter(r["sensitive_attr"] for r in out.collect())
    assert groups == {"a": 10, "b": 16, None: 3}


def test_without_key(spark):
    rows = [("a", 1)] * 6 + [("a", 0)] * 4 + [("b", 1)] * 2 + [("b", 0)] * 8
    df = spark.createDataFrame(rows, "sensitive_attr string, target int")
    out = over(df)
    assert out.columns == ["sensitive_attr", "target", "copy_no", "draw_no"]
    assert out.count() == 20 + 10
    assert out.distinct().count() == 30


def test_many_groups_are_not_broadcast(rows_from_counts, monkeypatch):
    df = rows_from_counts([("a", 20, 10), ("b", 20, 4)])
    want = sorted(map(tuple, over(df, key=["id"]).collect()))
    monkeypatch.setattr(mitigate, "BROADCAST_GROUPS", 0)
    assert sorted(map(tuple, over(df, key=["id"]).collect())) == want


def test_several_sensitive_columns(spark):
    rows = [(i, g, h, int(i % d == 0)) for i, (g, h, d) in enumerate(
        [("a", 1, 2)] * 40 + [("a", 2, 4)] * 40 + [("b", 1, 5)] * 40
    )]
    df = spark.createDataFrame(rows, "id int, g string, h int, y int")
    out = ek.oversample(df, ["g", "h"], "y", ["id"])
    rates = [r["rate"] for r in ek.group_rates(out, ["g", "h"], "y").collect()]
    assert len(rates) == 3
    assert max(rates) - min(rates) < 0.03


def test_repeatable(rows_from_counts):
    df = rows_from_counts([("a", 30, 20), ("b", 40, 9)])
    first = sorted(map(tuple, over(df, key=["id"]).collect()))
    assert first == sorted(map(tuple, over(df.repartition(6), key=["id"]).collect()))
    assert first != sorted(map(tuple, over(df, key=["id"], seed=1).collect()))


def test_whole_rows_are_fetched_last(rows_from_counts, monkeypatch):
    """One exchange at most holds the wide column, whether hits are broadcast or not."""
    from pyspark.sql import functions as F

    from evenkeel.operators import sampling

    df = rows_from_counts([("a", 60, 30), ("b", 60, 9)]).withColumn("wide", F.concat(F.lit("w"), "id"))
    want = None
    for most, exchanges in ((500_000, 0), (0, 1)):
        monkeypatch.setattr(sampling, "BROADCAST_HITS", most)
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            out = over(df, key=["id"])
            plan_ = out._jdf.queryExecution().executedPlan().toString()
        finally:
            df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        assert plan_.count("Exchange hashpartitioning(__key_hash") <= 2 * exchanges
        got = sorted(map(tuple, out.collect()))
        want = want or got
        assert got == want
