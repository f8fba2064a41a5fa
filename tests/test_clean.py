import pytest

import evenkeel as ek


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_drop_and_recode(spark):
    df = spark.createDataFrame([("Männer", 1), ("Frauen", 2), ("x", 3), (None, 4)], "g string, i int")
    assert ek.drop_if_present(df, ["i", "zz"]).columns == ["g"]
    assert rows(ek.recode(df, "g", {"Männer": 1, "Frauen": 2})) == [(1, 1), (2, 2), (None, 3), (None, 4)]


def test_roles(spark):
    df = spark.createDataFrame(
        [(1, 2.0, "a", True, "s", 1)], "i long, d double, c string, b boolean, g string, y int"
    )
    roles = ek.infer_roles(df, "y", ["g"])
    assert (roles.numeric, roles.categorical) == (("i", "d"), ("c",))
    assert ek.assign_roles(df, roles).columns == ["i", "d", "c", "b", "g", "y"]
    assert ek.assign_roles(df, roles, "drop").columns == ["i", "d", "c", "g", "y"]
    with pytest.raises(ek.ValidationError):
        ek.infer_roles(df, "nope", ["g"])


def test_drop_missing(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 1.0), ("b", float("nan")), ("c", None)], "g string, y double")
    assert rows(ek.drop_missing(df, ["g", "y"])) == [("a", 1.0)]
    assert rows(ek.missing_counts(df, ["g", "y"])) == [(4, 1, 3)]


def test_to_numeric(spark):
    text = ["1", " 2.5 ", "1e3", "-.5", "5.", "abc", "1d", "0x1p3", "", "NaN", "1 2", "inf"]
    df = spark.createDataFrame([(t,) for t in text] + [(None,)], "t string")
    assert [r[0] for r in ek.to_numeric(df, ["t"]).collect()] == [
        1.0, 2.5, 1000.0, -0.5, 5.0, None, None, None, None, None, None, float("inf"), None,
    ]


def test_labels(spark):
    df = spark.createDataFrame([(0.5,), (0.51,), (None,), (1.9,), (-1.9,)], "s double")
    assert [r["p"] for r in ek.binarize(df, "s", "p").collect()] == [0, 1, 0, 1, 0]
    assert [r[0] for r in ek.to_label(df, ["s"]).collect()] == [0, 0, None, 1, -1]


def test_align_features(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert ek.align_features(["b", "a"], df) == ["b", "a"]
    with pytest.warns(UserWarning, match="c"):
        assert ek.align_features(["a", "c"], df) == ["a"]
    with pytest.raises(ek.ValidationError):
        ek.align_features(["c"], df)
    with pytest.raises(ek.ValidationError):
        ek.numeric_features(df.select("a"), "a")
