import json
from pathlib import Path

import pytest
from pyspark.sql import types as T

import evenkeel as ek


def write(tmp_path, text, encoding="utf-8", name="in.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_latin1_semicolons(spark, tmp_path):
    path = write(tmp_path, "Geschlecht;ABGANG\nMänner;1\nFrauen;0\n", "latin1")
    df = ek.read_csv(spark, path, sep=";", encoding="latin1")
    assert [tuple(r) for r in df.collect()] == [("Männer", 1), ("Frauen", 0)]


def test_missing_tokens_and_inference(spark, tmp_path):
    path = write(tmp_path, "i,f,s,b,e\n1,1.5,x,True,\nNA,n/a,null,False,NaN\n3,2,y,true,\n")
    df = ek.read_csv(spark, path)
    assert dict(df.dtypes) == {"i": "bigint", "f": "double", "s": "string", "b": "boolean", "e": "double"}
    assert [tuple(r) for r in df.collect()] == [
        (1, 1.5, "x", True, None), (None, None, None, False, None), (3, 2.0, "y", True, None),
    ]


def test_numbers_too_large_for_integers(spark, tmp_path):
    df = ek.read_csv(spark, write(tmp_path, "a,b\n99999999999999999999,1d\n1,2\n"))
    assert dict(df.dtypes) == {"a": "double", "b": "string"}


def test_schema_by_name(spark, tmp_path):
    path = write(tmp_path, "a,b,c\n1,x,2.5\nbad,y,\n")
    schema = T.StructType([T.StructField("c", T.DoubleType()), T.StructField("a", T.IntegerType())])
    df = ek.read_csv(spark, path, schema=schema)
    assert [tuple(r) for r in df.collect()] == [(2.5, 1), (None, None)]
    with pytest.raises(ek.ValidationError, match="missing columns"):
        ek.read_csv(spark, path, schema=T.StructType([T.StructField("zz", T.StringType())]))


def test_quotes_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", text'), (2, "back\\slash")], "id long, t string")
    ek.write_table(df, str(tmp_path / "out"), "csv")
    back = ek.read_csv(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_short_and_long_rows(spark, tmp_path):
    path = write(tmp_path, 'a,b\n1,2\n3\n4,"5,6",7\n8,x\n9,NA\n')
    df = ek.read_csv(spark, path)
    assert df.count() == 5
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    rows = ek.malformed_rows(spark, path, schema).collect()
    got = {(r["kind"], r["n_cells"], r["n_expected"], tuple(r["bad_columns"] or ())) for r in rows}
    # the long row's second cell is no number either, but its shape comes first
    assert got == {("short", 1, 2, ()), ("long", 3, 2, ()), ("value", 2, 2, ("b",))}
    text = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    assert sorted(r["kind"] for r in ek.malformed_rows(spark, path, text).collect()) == ["long", "short"]


def test_empty_files(spark, tmp_path):
    with pytest.raises(ek.EmptyInputError):
        ek.read_csv(spark, write(tmp_path, ""))
    df = ek.read_csv(spark, write(tmp_path, "a,b\n", name="head.csv"))
    assert df.columns == ["a", "b"]
    with pytest.raises(ek.EmptyInputError):
        ek.require_nonempty(df)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ek.read_csv(spark, str(tmp_path / "nothing.csv"))


def test_wrong_encoding_is_found(spark, tmp_path):
    path = write(tmp_path, "name,n\nMänner,1\nFrauen,2\n", "latin1")
    df = ek.read_csv(spark, path, encoding="utf-8")
    rows = [tuple(r) for r in ek.encoding_suspects(df).collect()]
    assert rows == [(2, "name", 1)]


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ek.ValidationError):
        ek.write_table(spark.range(1), str(tmp_path / "x"), "feather")


def test_empty_splits_are_skipped(spark, tmp_path):
    rows = spark.range(3)
    paths = {n: str(tmp_path / n) for n in ("train", "val", "test")}
    splits = {"train": rows, "val": rows.filter("id = 0"), "test": rows.limit(0)}
    assert ek.write_splits(splits, paths) == ["train", "val"]
    assert spark.read.parquet(paths["train"]).count() == 3
    assert not (tmp_path / "test").exists()


def test_report_keeps_nulls(spark, tmp_path):
    report = spark.createDataFrame([(None, 1)], "a double, b int")
    ek.write_report(report, str(tmp_path / "r"))
    (part,) = (tmp_path / "r").glob("part-*.json")
    assert json.loads(part.read_text()) == {"a": None, "b": 1}


def test_other_missing_tokens(spark, tmp_path):
    path = write(tmp_path, "a,b\n-,NA\n1,it's\n")
    df = ek.read_csv(spark, path, na_values=["-"])
    assert [tuple(r) for r in df.collect()] == [(None, "NA"), (1, "it's")]
    assert dict(ek.read_csv(spark, path, na_values=[]).dtypes) == {"a": "string", "b": "string"}


def test_landing_gives_rows_and_bad_lines_from_one_parse(spark, tmp_path):
    path = write(tmp_path, 'a,b\n1,2\n3\n4,"5,6",7\n8,x\n9,NA\n10,1d\n')
    schema = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("a", T.IntegerType())])
    landed = ek.land_csv(spark, path, str(tmp_path / "copy"), schema=schema)
    Path(path).unlink()  # nothing is read from the file again
    assert sorted(map(str, map(tuple, landed.rows.collect()))) == sorted(map(str, [
        (2, 1), (None, 3), (None, 4), (None, 8), (None, 9), (None, 10)]))
    got = {(r["kind"], r["n_cells"], r["n_expected"], tuple(r["bad_columns"] or ()), r["line"]) for r in landed.bad.collect()}
    assert got == {("short", 1, 2, (), "3"), ("long", 3, 2, (), '4,"5,6",7'), ("value", 2, 2, ("b",), "8,x"), ("value", 2, 2, ("b",), "10,1d")}
    assert landed.counts == {"n_rows": 6, "bad:short": 1, "bad:long": 1, "bad:unreadable": 2}
    assert "MapInArrow" not in landed.rows._jdf.queryExecution().executedPlan().toString()


def test_landing_infers_types_and_finds_wrong_encodings(spark, tmp_path):
    path = write(tmp_path, "name,n\nMänner,1\nFrauen,2\n", "latin1")
    landed = ek.land_csv(spark, path)
    assert dict(landed.rows.dtypes) == {"name": "string", "n": "bigint"}
    assert landed.counts["suspect:name"] == 1 and landed.counts["suspect:n"] == 0 and landed.bad.isEmpty()
    right = ek.land_csv(spark, path, encoding="latin1")
    assert right.counts["suspect:name"] == 0 and {r[0] for r in right.rows.collect()} == {"Männer", "Frauen"}
    with pytest.raises(ek.ValidationError, match="missing columns"):
        ek.land_csv(spark, path, schema=T.StructType([T.StructField("zz", T.StringType())]))
    with pytest.raises(ek.EmptyInputError):
        ek.land_csv(spark, write(tmp_path, "", name="none.csv"))
    empty = ek.land_csv(spark, write(tmp_path, "a,b\n", name="head.csv"))
    assert empty.counts["n_rows"] == 0 and empty.rows.columns == ["a", "b"]


def test_latin1_output(spark, tmp_path):
    df = spark.createDataFrame([("Männer", "a;b"), ("Frauen", None)], "g string, t string")
    ek.write_table(df, str(tmp_path / "out"), "csv", sep=";", encoding="latin1")
    raw = b"".join(p.read_bytes() for p in (tmp_path / "out").glob("part-*"))
    assert "Männer;\"a;b\"".encode("latin1") in raw
    back = ek.read_csv(spark, str(tmp_path / "out"), sep=";", encoding="latin1")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_observed_copy(spark):
    df = spark.createDataFrame([(1, "x�", 1.0), (2, None, float("nan")), (0, "y", None)], "y int, t string, v double")
    copy, counts = ek.observed_copy(df, present_in=["t", "v"], binary=["y"], essential=["t", "v"], texts=None)
    assert counts == {"n_rows": 3, "null:t": 1, "null:v": 2, "not_binary:y": 1, "suspect:t": 1, "dropped": 2}
    assert copy.count() == 3
    assert ek.observed_copy(df.limit(0), binary=["y"])[1] == {"n_rows": 0, "not_binary:y": 0}
    with pytest.raises(ek.ValidationError):
        ek.observed_copy(df, binary=["nope"])


def test_splits_in_one_pass(spark, tmp_path):
    splits = ek.train_val_test_split(spark.range(2).withColumnRenamed("id", "k"), ["k"])
    assert ek.write_splits(splits, str(tmp_path / "a")) == ["train", "val"]
    assert sorted(p.name for p in (tmp_path / "a").glob("split=*")) == ["split=train", "split=val"]
    frames = {"train": spark.range(5), "held": spark.range(5, 7), "none": spark.range(0)}
    assert ek.write_splits(frames, str(tmp_path / "b"), "csv") == ["train", "held"]
    back = spark.read.option("header", True).csv(str(tmp_path / "b"))
    assert sorted((r["split"], int(r["id"])) for r in back.collect()) == sorted(
        [("train", i) for i in range(5)] + [("held", 5), ("held", 6)])
    with pytest.raises(ek.ValidationError):
        ek.write_splits({"x": spark.range(2).withColumnRenamed("id", "split")}, str(tmp_path / "c"))
    with pytest.raises(ek.ValidationError):
        ek.write_splits(frames, str(tmp_path / "d"), "feather")


def test_group_reports(spark, tmp_path, monkeypatch):
    from evenkeel.operators import contingency

    monkeypatch.setattr(contingency, "DOCUMENT_GROUPS", 10)
    df = spark.range(4000).selectExpr("concat('g', lpad(id % 500, 3, '0')) AS g", "id % 2 AS h", "CAST(id % 3 = 0 AS int) AS y", "CAST(id % 5 = 0 AS int) AS p")
    for kind, prediction in (("parity", None), ("rates", None), ("impact", None), ("odds", "p")):
        report = ek.group_report(df, kind, ["g", "h"], "y", prediction)
        path = tmp_path / kind
        ek.write_report(report, str(path))
        lines = [json.loads(line) for f in sorted((path / "groups").glob("part-*.json")) for line in f.read_text().splitlines()]
        assert [(r["g"], r["h"]) for r in lines] == sorted((f"g{i:03}", i % 2) for i in range(500))
        (summary,) = [json.loads(f.read_text()) for f in (path / "summary").glob("part-*.json")]
        assert summary["n_groups"] == 500 and summary["report"] == kind and summary["sensitive_features"] == ["g", "h"]
    with pytest.raises(Exception, match="groups do not fit"):
        ek.demographic_parity_report(df, ["g", "h"], "y").collect()
    with pytest.raises(ek.ValidationError):
        ek.group_report(df, "parity", ["g"], "y", "p")
