import pytest

import evenkeel as ek
from evenkeel.operators import contingency as contingency_module


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", None), (3, None, float("nan")), (4, "b", 0.0)],
        "id long, grp string, y double",
    )


def test_columns(people):
    ek.require_columns(people, ["id", "y"])
    with pytest.raises(ek.ValidationError, match="zz"):
        ek.require_columns(people, ["id", "zz"])
    with pytest.warns(UserWarning, match="zz"):
        rows = ek.check_expected_columns(people, ["zz"], ["id", "mm"]).collect()
    assert [tuple(r) for r in rows] == [("id", True, "ok"), ("mm", False, "error"), ("zz", False, "warning")]


def test_null_ratio_counts_nan(people):
    row = ek.null_ratio(people, ["y"], 0.5).first()
    assert (row["n_rows"], row["n_null"], row["null_ratio"], row["passed"]) == (4, 2, 0.5, True)
    with pytest.raises(ek.ValidationError, match="50.00%"):
        ek.require_null_ratio(people, "y", 0.49)
    assert ek.require_null_ratio(people.limit(0), "y") == 0.0


def test_profile(people):
    rows = ek.profile(people).orderBy("position").collect()
    assert [(r["column"], r["type"], r["n_present"]) for r in rows] == [
        ("id", "bigint", 4), ("grp", "string", 3), ("y", "double", 2),
    ]
    assert {(r["n_rows"], r["n_columns"]) for r in rows} == {(4, 3)}


def test_distinct_preview(people):
    rows = ek.distinct_preview(people, ["grp", "id"], limit=3).collect()
    got = {}
    for r in rows:
        got.setdefault(r["column"], []).append(r["value"])
    assert {k: sorted(v) for k, v in got.items()} == {"grp": ["a", "b"], "id": ["1", "2", "3"]}
    assert ek.distinct_preview(people.limit(0), ["grp"]).count() == 0


def test_distinct_preview_sends_little(spark):
    df = spark.range(0, 5000, 1, 4).selectExpr("CAST(id AS string) AS t", "IF(id % 3 = 0, 'é', 'z') AS u")
    preview = ek.distinct_preview(df, ["t", "u", "t"], limit=4)
    got = [tuple(r) for r in preview.orderBy("column", "position").collect()]
    want = sorted(str(i) for i in range(5000))[:4]
    assert got == [("t", v, i) for i, v in enumerate(want, 1)] + [("u", "z", 1), ("u", "é", 2)]


def test_value_shares(people):
    got = {r["value"]: (r["n"], r["share"]) for r in ek.value_shares(people, "grp").collect()}
    assert got == {"a": (1, 1 / 3), "b": (2, 2 / 3)}


def test_binary(people, spark):
    assert {tuple(r) for r in ek.binary_violations(people, ["y", "grp"]).collect()} == {(4, "y", 2), (4, "grp", 4)}
    with pytest.warns(UserWarning):
        assert ek.check_binary(people, ["y"]) == 2
    with pytest.raises(ek.ValidationError):
        ek.check_binary(people, ["y"], on_violation="error")
    text = spark.createDataFrame([("1",), ("0",)], "y string")
    assert ek.check_binary(text, ["y"], on_violation="error") == 0


def test_group_cardinality(people, spark):
    assert tuple(ek.group_cardinality(people, ["grp"]).first()) == (2, "ok")
    assert tuple(ek.group_cardinality(people, ["id"]).first()) == (4, "many")
    assert tuple(ek.group_cardinality(people.limit(0), ["grp"]).first()) == (0, "too_few")


def test_constant_target(people):
    assert ek.target_is_constant(people.filter("id = 1"), "y")
    assert not ek.target_is_constant(people, "y")


def test_parse_features():
    assert ek.parse_features(" a, b ,,c") == ["a", "b", "c"]
    with pytest.raises(ek.ValidationError):
        ek.parse_features(" , ")


def test_validate_spec(people, spark):
    spec = ek.DatasetSpec(target="y", sensitive=("grp",), expected=("id",), null_threshold=0.6)
    assert ek.validate(people, spec).count() == 3
    with pytest.raises(ek.ValidationError, match="is null in"):
        ek.validate(people, ek.DatasetSpec(target="y", sensitive=("grp",)))
    with pytest.raises(ek.ValidationError, match="missing"):
        ek.validate(people, ek.LABOUR_MARKET)


def test_reserved_names(people):
    with pytest.raises(ek.ValidationError):
        ek.contingency(people.withColumnRenamed("grp", "n"), ["n"], "y")
