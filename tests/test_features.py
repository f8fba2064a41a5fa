import random
import statistics

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import evenkeel as ek
from evenkeel.functions.vectors import folded_vector, vector_parts
from evenkeel.operators import categories, features, quantiles


def values(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,), (float("nan"),)], "x double")
    assert ek.exact_medians(df, ["x"])[0] == {"x": 3.0}
    assert [v for (v,) in values(ek.impute_median(df, ["x"]), "x")] == [1.0, 2.0, 4.0, 10.0, 3.0, 3.0]


def draw(kind, n, rng):
    if kind == "heavy":
        return [rng.paretovariate(0.3) * rng.choice([-1, 1]) for _ in range(n)]
    if kind == "hot":
        return [7.0 if rng.random() < 0.4 else rng.random() * 100 for _ in range(n)]
    if kind == "two":
        return [float(i % 2) for i in range(n)]
    if kind == "wide":
        return [10.0 ** rng.randint(-300, 300) for _ in range(n)]
    return [rng.gauss(0, 1) for _ in range(n)]


@pytest.mark.parametrize("n", [1000, 1001])
def test_median_search(spark, monkeypatch, n):
    """The narrowing search, forced on small data by a small sort limit."""
    monkeypatch.setattr(quantiles, "SORT_ROWS", 10)
    monkeypatch.setattr(quantiles, "RANGES", 64)
    kinds = ["gauss", "heavy", "hot", "two", "wide"]
    data = {k: draw(k, n, random.Random(f"{k}{n}")) for k in kinds}
    schema = ", ".join(f"{k} double" for k in kinds)
    df = spark.createDataFrame(list(zip(*data.values())), schema).repartition(5)
    found, _ = ek.exact_medians(df, kinds)
    assert found == {k: statistics.median(xs) for k, xs in data.items()}


def test_medians_without_values(spark):
    df = spark.createDataFrame([(None, 1)], "x double, y int")
    assert ek.exact_medians(df, ["x", "y"])[0] == {"x": None, "y": 1.0}
    assert ek.exact_medians(df.limit(0), ["x", "y"])[0] == {"x": None, "y": None}


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (3.0, 5)], "x double, k int")
    out = values(ek.standardize(df, ["x", "k"]), "x", "k")
    assert [round(x, 6) for x, _ in out] == [-1.224745, 0.0, 1.224745]
    assert [k for _, k in out] == [0.0, 0.0, 0.0]


def test_one_hot(spark):
    df = spark.createDataFrame([("b", 2), ("a", 10), (None, 2)], "c string, n int")
    out = ek.one_hot(df, ["c", "n"])
    assert out.columns == ["c_a", "c_b", "c_nan", "n_2", "n_10"]
    assert [tuple(r) for r in out.collect()] == [(0, 1, 0, 1, 0), (1, 0, 0, 0, 1), (0, 0, 1, 1, 0)]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1.0, None, "u", "x", True, "f", 1), (None, None, "v", None, False, "m", 0), (5.0, None, "u", "y", True, "f", 1)],
        "a double, empty double, c string, d string, flag boolean, g string, y int",
    )


ROLES = ek.ColumnRoles("y", ("g",), ("a", "empty"), ("c", "d"))


def test_preprocessor(people):
    with pytest.warns(UserWarning, match="empty"):
        fitted = ek.fit_preprocessor(people, ROLES)
    out = fitted.transform(people)
    assert out.columns == ["a", "c_u", "c_v", "d_x", "d_y", "d_nan", "flag", "g", "y"]
    assert [tuple(r) for r in out.collect()] == [
        (1.0, 1, 0, 1, 0, 0, True, "f", 1),
        (3.0, 0, 1, 0, 0, 1, False, "m", 0),
        (5.0, 1, 0, 0, 1, 0, True, "f", 1),
    ]
    again = ek.FittedPreprocessor.from_json(fitted.to_json())
    assert again == fitted
    assert again.transform(people).collect() == out.collect()


def test_preprocessor_scales_after_imputing(people):
    with pytest.warns(UserWarning):
        fitted = ek.fit_preprocessor(people, ROLES, remainder="drop", scale=True)
    out = fitted.transform(people)
    assert out.columns == ["a", "c_u", "c_v", "d_x", "d_y", "d_nan", "g", "y"]
    dev = statistics.pstdev([1, 3, 5])
    assert [r["a"] for r in out.collect()] == pytest.approx([-2 / dev, 0, 2 / dev])


def test_unseen_categories_are_zero(people, spark):
    with pytest.warns(UserWarning):
        fitted = ek.fit_preprocessor(people, ROLES)
    other = spark.createDataFrame(
        [(None, 9.0, "w", "z", True, "f", 0)], people.schema
    )
    assert tuple(fitted.transform(other).first()) == (3.0, 0, 0, 0, 0, 0, True, "f", 0)


def test_empty_input_keeps_columns(people):
    fitted = ek.fit_preprocessor(people.limit(0), ROLES)
    out = fitted.transform(people.limit(0))
    assert out.columns == ["a", "empty", "flag", "g", "y"]
    assert out.count() == 0


def test_wide_category_becomes_a_vector(people):
    with pytest.warns(UserWarning):
        fitted = ek.fit_preprocessor(people, ROLES, category_form="vector")
    out = fitted.transform(people)
    assert out.columns == ["a", "c_onehot", "d_onehot", "flag", "g", "y"]
    assert [list(r["d_onehot"].toArray()) for r in out.collect()] == [[1, 0, 0], [0, 0, 1], [0, 1, 0]]
    unseen = people.withColumn("d", F.lit("zz"))
    assert [sum(r["d_onehot"].toArray()) for r in fitted.transform(unseen).collect()] == [0, 0, 0]


def test_missing_is_no_category_of_that_name(spark):
    df = spark.createDataFrame([(1, None, "f", 1), (2, "nan", "f", 0), (3, "x", "m", 1)], "id long, c string, g string, y int")
    roles = ek.ColumnRoles("y", ("g",), (), ("c",))
    out = ek.fit_preprocessor(df, roles, category_form="vector").transform(df, keep=["id"])
    assert len({tuple(r["c_onehot"].toArray()) for r in out.collect()}) == 3


def test_too_many_categories(people, monkeypatch):
    monkeypatch.setattr(features, "MAX_CATEGORIES", 1)
    with pytest.warns(UserWarning), pytest.raises(ek.ValidationError, match="categories"):
        ek.fit_preprocessor(people, ROLES)


def test_colliding_names(spark):
    df = spark.createDataFrame([("x_y", "y", "f", 1), ("q", "y", "m", 0)], "a string, a_x string, g string, y int")
    fitted = ek.fit_preprocessor(df, ek.ColumnRoles("y", ("g",), (), ("a", "a_x")))
    with pytest.raises(ek.ValidationError, match="a_x_y"):
        fitted.transform(df)
    case = spark.createDataFrame([("A",), ("a",)], "c string")
    with pytest.raises(ek.ValidationError):
        ek.one_hot(case, ["c"])


def test_text_is_not_numeric(people):
    with pytest.raises(ek.ValidationError, match="not numeric"):
        ek.fit_preprocessor(people, ek.ColumnRoles("y", ("g",), ("c",)))
    with pytest.raises(ek.ValidationError):
        ek.fit_preprocessor(people, ROLES, remainder="keep")


def test_infinite_values(spark):
    df = spark.createDataFrame([(float("inf"),), (float("inf"),), (1.0,), (None,)], "x double")
    assert ek.exact_medians(df, ["x"])[0] == {"x": float("inf")}
    assert [r[0] for r in ek.impute_median(df, ["x"]).collect()][-1] == float("inf")


@pytest.mark.parametrize("most, longest", [(100_000, 256), (2, 256), (0, 0), (100_000, 1)])
def test_category_numbers(spark, monkeypatch, most, longest):
    """By broadcast, by shuffle, and both; any text is a category of its own."""
    monkeypatch.setattr(categories, "BROADCAST_VALUES", most)
    monkeypatch.setattr(categories, "BROADCAST_BYTES", longest)
    texts = ["b", "a", None, "a", "nan", "missing", "=a", "", "x" * 300, "ä", "a"]
    rows = [(i, t, None if i == 3 else float((i * 7) % 5), i % 2 == 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, c string, n double, flag boolean").repartition(3)
    found = ek.category_dictionary(df, ["c", "n", "flag"])
    order = [*sorted({t for t in texts if t is not None}, key=str.encode), None]
    numbers = [*sorted({r[2] for r in rows if r[2] is not None}), None]
    assert found.widths == {"c": len(order), "n": len(numbers), "flag": 2}
    got = ek.with_category_index(df, found).collect()
    assert {r["id"]: (r["c_index"], r["n_index"], r["flag_index"]) for r in got} == {
        i: (order.index(t), numbers.index(x), int(f)) for i, t, x, f in rows}
    other = spark.createDataFrame([(1, "new", 99.0, None)], df.schema)
    assert tuple(ek.with_category_index(other, found, ["c", "flag"]).first())[-2:] == (None, None)
    counts = {(r["column"], r["value"]): r["n"] for r in found.table(spark).collect()}
    assert counts["c", "a"] == 3 and counts["c", None] == 1 and counts["flag", "true"] == 6


def test_vectors_have_no_bound_of_categories(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(features, "MAX_CATEGORIES", 1)
    df = spark.range(500).selectExpr("id", "concat('c', id) AS c", "'f' AS g", "CAST(id % 2 AS int) AS y")
    fitted = ek.fit_preprocessor(df, ek.ColumnRoles("y", ("g",), (), ("c",)), category_form="vector", dictionary_path=str(tmp_path / "d"))
    assert fitted.categories == {} and fitted.dictionary.widths == {"c": 500}
    again = ek.FittedPreprocessor.from_json(fitted.to_json())
    assert again == fitted
    out = again.transform(df, keep=["id"]).select("id", ek.vector_parts(F.col("c_onehot")).alias("p")).collect()
    names = sorted(f"c{i}" for i in range(500))
    assert all(r["p"]["indices"] == [names.index(f"c{r['id']}")] and r["p"]["size"] == 500 for r in out)
    with pytest.raises(ek.ValidationError):
        ek.one_hot(df, ["c"], "rows")


def test_folded_vectors(spark):
    df = spark.createDataFrame([(Vectors.sparse(9, [1, 4, 8], [1.0, 2.0, 3.0]),), (Vectors.dense([0.0, 5.0]),), (Vectors.sparse(3, [], []),)], ["v"])
    rows = df.select("v", folded_vector(vector_parts(F.col("v")), 4).alias("w")).collect()
    for r in rows:
        assert r["w"].size == 4 and sum(r["w"].toArray()) == sum(r["v"].toArray())


def test_medians_of_many_columns(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SORT_ROWS", 40)
    rng = random.Random(8)
    data = [[rng.choice([None, rng.gauss(i, 9), float(i)]) for i in range(120)] for _ in range(101)]
    df = spark.createDataFrame(data, ", ".join(f"x{i} double" for i in range(120))).repartition(3)
    want = {f"x{i}": statistics.median([r[i] for r in data if r[i] is not None]) for i in range(120)}
    assert ek.exact_medians(df, list(want))[0] == want
    monkeypatch.setattr(quantiles, "SORT_ROWS", 1_000_000)
    assert ek.exact_medians(df, list(want), rows=101)[0] == want


def test_few_rows_are_fitted_in_one_pass(people):
    with pytest.warns(UserWarning):
        one, two = [ek.fit_preprocessor(people, ROLES, scale=True, rows=rows) for rows in (3, None)]
    assert one == two
