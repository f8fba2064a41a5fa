import pytest

import evenkeel as ek
from evenkeel.operators import model as model_module


@pytest.fixture(scope="module")
def encoded(spark):
    rows = [(i, float(i % 5), f"c{i % 6}", "ab"[i % 2], int(i % 6 < 3)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, x double, c string, g string, y int")
    roles = ek.ColumnRoles("y", ("g",), ("x",), ("c",))
    wide = ek.fit_preprocessor(df, roles, category_form="vector").transform(df, keep=["id"])
    return ek.materialize(wide, "encoded")


def test_sparse_categories_are_features(encoded):
    model = ek.train_regressor(encoded, "y", trees=5, max_depth=4, exclude=["id"])
    assert model.features == ("x", "c_onehot")
    scored = ek.predict(model, encoded, "p")
    assert scored.columns == [*encoded.columns, "p_regression", "p"]
    assert scored.filter("p = y").count() >= 110


def test_label_is_missing_or_features_are(encoded):
    with pytest.raises(ek.ValidationError, match="missing"):
        ek.train_regressor(encoded, "nope")
    with pytest.raises(ek.ValidationError, match="no numeric"):
        ek.train_regressor(encoded.select("g", "y"), "y")
    model = ek.train_regressor(encoded, "y", trees=2, max_depth=2, exclude=["id"])
    with pytest.warns(UserWarning), pytest.raises(ek.ValidationError, match="lacks"):
        ek.predict(model, encoded.drop("x"))


def test_missing_numbers_can_be_scored(spark, encoded):
    plain = encoded.select("x", "y")
    model = ek.train_regressor(plain, "y", trees=2, max_depth=2)
    gap = spark.createDataFrame([(None, 1)], "x double, y int")
    assert ek.predict(model, gap).first()["prediction"] in (0, 1)


@pytest.mark.parametrize("key", [["id"], None])
def test_forest_does_not_depend_on_partitions(spark, encoded, monkeypatch, key):
    monkeypatch.setattr(model_module, "LAYOUT_ROWS", 50)
    rows = encoded if key else encoded.drop("id")
    scores = []
    for parts in (1, 3, 8):
        train = rows.repartition(parts).orderBy("x") if parts > 1 else rows.coalesce(1)
        fitted = ek.train_regressor(train, "y", trees=7, max_depth=3, key=key)
        scores.append(sorted(map(str, ek.predict(fitted, encoded, "p").select("id", "p_regression").collect())))
    assert scores[0] == scores[1] == scores[2]
    assert fitted.features == ("x", "c_onehot")


def test_layout_follows_from_the_rows(spark, monkeypatch):
    monkeypatch.setattr(model_module, "LAYOUT_ROWS", 20)
    rows = spark.range(100).selectExpr("id", "id % 3 AS x")
    parts = [[tuple(r) for r in p] for p in model_module.training_layout(rows, ["id"]).rdd.glom().collect()]
    again = [[tuple(r) for r in p] for p in model_module.training_layout(rows.repartition(7), ["id"]).rdd.glom().collect()]
    assert len(parts) == 6 and parts == again


def test_wide_vectors_are_folded(spark):
    df = spark.range(400).selectExpr("id", "concat('c', id % 200) AS c", "'g' AS g", "CAST(id % 200 < 90 AS int) AS y")
    wide = ek.fit_preprocessor(df, ek.ColumnRoles("y", ("g",), (), ("c",)), category_form="vector").transform(df, keep=["id"])
    fitted = ek.train_regressor(wide, "y", trees=3, max_depth=8, key=["id"], max_width=64)
    assert fitted.folded == ("c_onehot",)
    assert fitted.stages.stages[-1].numFeatures == 64
    scored = ek.predict(fitted, wide, "p")
    assert scored.columns == [*wide.columns, "p_regression", "p"]
    assert scored.filter("p = y").count() > 240


def test_a_hundred_thousand_categories(spark):
    """The vectors of all of them go through a space of the default width."""
    df = spark.range(100_000).selectExpr("id", "concat('c', id) AS c", "'g' AS g", "CAST(id % 2 AS int) AS y")
    wide = ek.fit_preprocessor(df, ek.ColumnRoles("y", ("g",), (), ("c",)), category_form="vector").transform(df, keep=["id"])
    fitted = ek.train_regressor(wide.filter("id % 50 = 0"), "y", trees=1, max_depth=2, key=["id"])
    assert fitted.stages.stages[-1].numFeatures == model_module.MAX_WIDTH
