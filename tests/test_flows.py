from collections import Counter
from pathlib import Path

import pytest

import evenkeel as ek


@pytest.fixture(scope="module")
def people(spark):
    rows = []
    for i in range(240):
        g = "groupA" if i % 2 else "groupB"
        x = float((i * 37) % 101)
        y = int(x > (40 if g == "groupA" else 70))
        rows.append((x if i % 20 else None, float(i % 7), "uvw"[i % 3], g, y))
    return spark.createDataFrame(
        rows, "feature1 double, feature2 double, kind string, sensitive_attr string, target int"
    )


@pytest.fixture(scope="module")
def with_id(spark, people):
    return people.rdd.zipWithIndex().map(lambda p: (p[1], *p[0])).toDF(
        "id long, feature1 double, feature2 double, kind string, sensitive_attr string, target int"
    )


KEYED = ek.DatasetSpec(target="target", sensitive=("sensitive_attr",), key=("id",))


def test_parity_flow_without_key(people):
    result = ek.parity_flow(people, ek.TOY)
    assert result.processed.columns == [
        "feature1", "feature2", "kind_u", "kind_v", "kind_w", "sensitive_attr", "target",
    ]
    assert result.report.first()["bias_check_status"] == "Warning"
    assert dict(result.splits.sizes) == {"train": 168, "val": 36, "test": 36}
    assert result.splits.train.columns == result.processed.columns
    whole = sum((Counter(map(tuple, f.collect())) for _, f in result.splits.items()), Counter())
    assert whole == Counter(map(tuple, result.processed.collect()))


def test_mitigation_flow(with_id, people):
    for table, spec in ((with_id, KEYED), (people, ek.TOY)):
        result = ek.mitigation_flow(table, spec)
        assert result.mitigated
        assert result.report.first()["bias_check_status"] == "Warning"
        assert result.final_report.first()["bias_check_status"] == "Passed"
        assert result.balanced.columns == result.processed.columns
        n = result.balanced.count()
        assert n > 240
        assert sum(result.splits.sizes.values()) == n
        assert {name: f.count() for name, f in result.splits.items()} == dict(result.splits.sizes)


def test_mitigation_flow_passes(with_id):
    import dataclasses

    result = ek.mitigation_flow(with_id, dataclasses.replace(KEYED, dp_threshold=0.9))
    assert not result.mitigated
    assert result.balanced.count() == 240
    assert sum(result.splits.sizes.values()) == 240


@pytest.mark.parametrize("fit_on", ["all", "train"])
def test_odds_flow(with_id, fit_on):
    result = ek.odds_flow(with_id, KEYED, trees=5, max_depth=4, fit_on=fit_on)
    assert "id" not in result.model.features
    assert {"pred_col_regression", "pred_col"} <= set(result.predictions.columns)
    report = result.report.first()
    assert report["overall_metrics"]["count"] == 36
    assert report["error_message"] is None
    labels = result.predictions.select("pred_col_regression", "pred_col").collect()
    assert all(r["pred_col"] == int(r["pred_col_regression"] > 0.5) for r in labels)
    # better than always answering the more common label
    guesses = result.predictions.groupBy("target").count().agg({"count": "max"}).first()[0]
    assert result.predictions.filter("pred_col = target").count() > guesses


def test_bounded_training_rows(with_id):
    result = ek.parity_flow(with_id, KEYED, max_train_rows=50)
    assert dict(result.splits.sizes) == {"train": 50, "val": 36, "test": 36}
    assert {name: f.count() for name, f in result.splits.items()} == dict(result.splits.sizes)


def test_cleanup_deletes_what_the_flow_wrote(people, tmp_path):
    result = ek.mitigation_flow(people, ek.TOY)
    folders = [Path(p.removeprefix("file:")) for p in result.scratch]
    assert {p.name.split("-")[1] for p in folders} == {"landed", "repeated", "prepared", "group", "hits", "balanced"}
    assert all(p.is_dir() for p in folders)
    result.cleanup()
    assert not any(p.exists() for p in folders)
    result.cleanup()


def test_labour_market(spark, tmp_path):
    lines = ["Datum;RGSCode;RGSName;Geschlecht;Verweildauer;Altersgruppe;ABGANG;DS_VWD"]
    for i in range(60):
        sex = "Männer" if i % 2 else "Frauen"
        lines.append(f"2024-01-01;{300 + i % 4};Ort;{sex};{'kurz' if i % 3 else 'lang'};{'<25' if i % 5 else '50+'};{int(i % 4 == 0)};{i / 2}")
    path = tmp_path / "labour.csv"
    path.write_bytes("\n".join(lines).encode("latin1"))
    spec = ek.LABOUR_MARKET
    landed = ek.land(spark, str(path), spec, str(tmp_path / "landed"))
    path.unlink()  # the file is parsed once
    result = ek.parity_flow(landed, spec)
    assert result.counts["n_rows"] == 60 and result.counts["bad:short"] == 0 and result.counts["dropped"] == 0
    assert result.processed.columns == [
        "RGSCode", "DS_VWD", "Verweildauer_kurz", "Verweildauer_lang",
        "Altersgruppe_50+", "Altersgruppe_<25", "Geschlecht", "ABGANG",
    ]
    assert result.report.first()["selection_rate_by_group"] == {"1": 0.0, "2": 0.5}


def test_eurostat(spark):
    rows = [("A", f"Y{i % 3}", "PC", f"g{i % 2}", "F" if i % 2 else "M", 2000 + i % 5, float(i % 2), "x") for i in range(40)]
    df = spark.createDataFrame(
        rows, "freq string, age string, unit string, geo string, sex string, TIME_PERIOD long, OBS_VALUE double, extra string"
    )
    with pytest.warns(UserWarning, match="DATAFLOW"):
        result = ek.parity_flow(df, ek.EUROSTAT)
    assert result.processed.columns == [
        "TIME_PERIOD", "freq_A", "age_Y0", "age_Y1", "age_Y2", "unit_PC", "geo_g0", "geo_g1", "sex", "OBS_VALUE",
    ]
    assert result.report.first()["selection_rate_by_group"] == {"F": 1.0, "M": 0.0}


def test_failed_checks_stop_a_flow(spark, people):
    with pytest.raises(ek.ValidationError, match="missing"):
        ek.parity_flow(people.drop("target"), ek.TOY)
    from pyspark.sql import functions as F

    holes = people.withColumn("target", F.when(F.col("kind") != "u", F.col("target")))
    with pytest.raises(ek.ValidationError, match="is null in"):
        ek.mitigation_flow(holes, ek.TOY)
    lost = people.withColumn("sensitive_attr", F.lit(None).cast("string"))
    with pytest.raises(ek.ValidationError, match="no rows"):
        ek.mitigation_flow(lost, ek.TOY)


class _Session:
    """Stands in for a session: the setting is fixed when a real one starts."""

    def __init__(self, master, named=None):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master = master
        self.chosen = None

    def getCheckpointDir(self):
        return self.chosen

    def setCheckpointDir(self, path):
        self.chosen = path


def test_shared_folder(spark):
    from evenkeel.sources import shared_dir

    assert shared_dir(_Session("spark://host", "s3a://bucket/shared/")) == "s3a://bucket/shared"
    local = _Session("local[2]")
    assert shared_dir(local) == local.chosen
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("spark://host"))
    assert ek.materialize(spark.range(3), "t").count() == 3


def test_bad_lines_are_warned_of(spark, tmp_path):
    lines = ["feature1,sensitive_attr,target", *[f"{i},{'ab'[i % 2]},{int(i % 3 == 0)}" for i in range(30)], "1,a,1,9", "2,b"]
    path = tmp_path / "toy.csv"
    path.write_text("\n".join(lines))
    with pytest.warns(UserWarning, match="1 lines of the file are long"):
        result = ek.parity_flow(ek.land(spark, str(path), ek.TOY), ek.TOY)
    assert result.counts["bad:long"] == result.counts["bad:short"] == 1
    assert result.counts["n_rows"] == 32 and result.counts["null:target"] == 1 and result.counts["dropped"] == 1


def test_odds_flow_tells_of_odd_labels(spark, with_id):
    from pyspark.sql import functions as F

    odd = with_id.withColumn("target", F.when(F.col("id") % 11 == 0, 2).when(F.col("id") % 23 != 1, F.col("target")))
    with pytest.warns(UserWarning) as told:
        result = ek.odds_flow(odd, KEYED, trees=2, max_depth=2)
    texts = " ".join(str(w.message) for w in told)
    assert "'target' holds" in texts and "lack an essential value" in texts
    tested = result.predictions
    assert result.counts["test_n_rows"] == tested.count() == 36
    assert result.counts["test_dropped"] == tested.filter("target IS NULL").count() > 0
    assert result.counts["test_not_binary:target"] == tested.filter("target IS NULL OR target = 2").count()
    assert result.counts["not_binary:target"] == odd.filter("target IS NULL OR target = 2").count()


def test_parity_flow_reads_its_input_once(spark, with_id, tmp_path):
    path = str(tmp_path / "raw")
    with_id.write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def counting(batches):
        reads.add(1)
        yield from batches

    source = spark.read.parquet(path)
    watched = source.coalesce(1).mapInArrow(counting, source.schema)
    result = ek.parity_flow(watched, KEYED)
    assert reads.value == 1 and sum(f.count() for _, f in result.splits.items()) == 240
    assert reads.value == 1
