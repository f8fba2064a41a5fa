"""Inputs that once gave wrong answers."""

import pytest
from pyspark.sql import types as T

import evenkeel as ek


def test_recode_leaves_keys_of_another_sort_alone(spark):
    df = spark.createDataFrame([(1, "x"), (2, "1")], "n long, s string")
    assert [r.n for r in ek.recode(df, "n", {"Männer": 1, "Frauen": 2}).collect()] == [None, None]
    assert [r.s for r in ek.recode(df, "s", {1: 10}).collect()] == [None, None]
    assert [r.n for r in ek.recode(df, "n", {True: "b"}).collect()] == [None, None]


def test_rate_skips_missing_targets(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 0)], "g string, y int")
    got = {r.g: (r.n, r.rate) for r in ek.group_rates(df, ["g"], "y").collect()}
    assert got == {"a": (2, 1.0), "b": (1, 0.0)}
    with pytest.raises(ek.ValidationError):
        ek.oversample_plan(df, ["g"], "y")


def test_numbers_with_suffixes_are_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a\n1.5\n1d\n0x1p3\n")
    schema = T.StructType([T.StructField("a", T.DoubleType())])
    assert [r.a for r in ek.read_csv(spark, str(path), schema=schema).collect()] == [1.5, None, None]
    assert ek.malformed_rows(spark, str(path), schema).count() == 2


def test_medians_of_huge_values(spark, monkeypatch):
    from evenkeel.operators import quantiles

    monkeypatch.setattr(quantiles, "SORT_ROWS", 2)
    df = spark.range(50).selectExpr("8.5e307 + id * 1e305 AS v", "CASE WHEN id % 2 = 0 THEN -1.7e308 ELSE 1.7e308 + id * 1e300 END AS w")
    medians, _ = quantiles.exact_medians(df, ["v", "w"])
    assert medians["v"] == pytest.approx(8.5e307 + 24.5e305)


def test_an_error_stops_the_parity_flow(spark):
    df = spark.createDataFrame([(i, None, i % 2, 1.0) for i in range(20)], "id long, g string, y int, x double")
    with pytest.raises(ek.ValidationError):
        ek.parity_flow(df, ek.DatasetSpec(target="y", sensitive=("g",), key=("id",)))


def test_copies_are_spread_for_their_true_total(spark, monkeypatch):
    from evenkeel.operators import sampling

    told = []
    spread = sampling.spread_copies
    monkeypatch.setattr(sampling, "spread_copies", lambda df, count, out, total: told.append(total) or spread(df, count, out, total))
    rows = [(i, "a", 1) for i in range(900)] + [(1000 + i, "a", 0) for i in range(100)] + [(2000 + i, "b", int(i < 10)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, g string, y int")
    out = ek.oversample(df, ["g"], "y", ["id"])
    assert told[-1] == out.count() - len(rows)
