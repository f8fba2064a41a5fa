"""Published results: the counts behind them must give them bit by bit."""

import json

import pytest

import evenkeel as ek

# Fixed values: (group, rows, positives), rates, overall rate, difference, status.
PARITY = {
    "labour": (
        [("Frauen", 224749, 35877), ("Männer", 236157, 36637)],
        {"Frauen": 0.15963141104076103, "Männer": 0.15513831899964853},
        0.15732926019622223, 0.004493092041112506, "Passed",
    ),
    "biased": (
        [("groupA", 497, 371), ("groupB", 503, 134)],
        {"groupA": 0.7464788732394366, "groupB": 0.2664015904572565},
        0.505, 0.48007728278218015, "Warning",
    ),
    "unbiased": (
        [("groupA", 512, 267), ("groupB", 488, 236)],
        {"groupA": 0.521484375, "groupB": 0.48360655737704916},
        0.503, 0.03787781762295084, "Passed",
    ),
}

# Fixed values: (group, tp, fn, fp, tn); overall; spreads; status.
ODDS = {
    "biased": (
        [("groupA", 24, 37, 7, 14), ("groupB", 14, 8, 27, 19)],
        [(0.3780487804878049, 0.39344262295081966, 0.3333333333333333),
         (0.6029411764705882, 0.6363636363636364, 0.5869565217391305)],
        (0.48, 0.4578313253012048, 0.5074626865671642),
        (14.0, 0.22489239598278332, 0.2429210134128167, 0.2536231884057972),
        0.2536231884057972,
        "Warning: Equalized Odds Difference (0.2536) > threshold (0.05)",
    ),
    "unbiased": (
        [("groupA", 24, 18, 26, 14), ("groupB", 17, 14, 18, 19)],
        [(0.6097560975609756, 0.5714285714285714, 0.65),
         (0.5147058823529411, 0.5483870967741935, 0.4864864864864865)],
        (0.5666666666666667, 0.5616438356164384, 0.5714285714285714),
        (14.0, 0.09505021520803447, 0.02304147465437789, 0.1635135135135135),
        0.1635135135135135,
        "Warning: Equalized Odds Difference (0.1635) > threshold (0.05)",
    ),
}

# Ten rows of two groups of five, three positives each.
SAMPLE = "feature1,feature2,sensitive_attr,target\n" + "".join(
    f"{i * 0.25 - 1},{10.5 - i},group{'AB'[i % 2]},{int(i < 6)}\n" for i in range(10)
)


@pytest.mark.parametrize("name", PARITY)
def test_parity_goldens(spark, rows_from_counts, name):
    counts, rates, overall, difference, status = PARITY[name]
    if name == "labour":  # by weight, not row by row: range plus a threshold
        from pyspark.sql import functions as F

        parts = [
            spark.range(n).select(F.lit(g).alias("sensitive_attr"), (F.col("id") < p).cast("int").alias("target"))
            for g, n, p in counts
        ]
        df = parts[0].unionByName(parts[1])
    else:
        df = rows_from_counts(counts)
    row = ek.demographic_parity_report(df, ["sensitive_attr"], "target").first()
    assert row["selection_rate_by_group"] == rates
    assert row["overall_selection_rate"] == overall
    assert row["demographic_parity_difference"] == difference
    assert row["bias_check_status"] == status
    assert row["bias_threshold_used"] == 0.1
    assert row["sensitive_features"] == ["sensitive_attr"]
    assert row["target_column"] == "target"
    assert row["check_type"] == "Demographic Parity"


@pytest.mark.parametrize("name", ODDS)
def test_odds_goldens(spark, name):
    confusion, by_group, overall, spreads, difference, status = ODDS[name]
    rows = []
    for g, tp, fn, fp, tn in confusion:
        rows += [(g, 1, 1)] * tp + [(g, 1, 0)] * fn + [(g, 0, 1)] * fp + [(g, 0, 0)] * tn
    df = spark.createDataFrame(rows, "sensitive_attr string, target int, pred_col int")
    row = ek.equalized_odds_report(df, ["sensitive_attr"], "target", "pred_col").first()
    got = [(g.selection_rate, g.true_positive_rate, g.false_positive_rate) for g in row["metrics_by_group"]]
    assert got == by_group
    assert [g["sensitive_attr"] for g in row["metrics_by_group"]] == ["groupA", "groupB"]
    assert [g["count"] for g in row["metrics_by_group"]] == [82.0, 68.0]
    o = row["overall_metrics"]
    assert (o.selection_rate, o.true_positive_rate, o.false_positive_rate) == overall
    assert o["count"] == 150
    assert o.equalized_odds_difference == difference
    d = row["disparity_metrics"]["difference"]
    assert (d["count"], d.selection_rate, d.true_positive_rate, d.false_positive_rate) == spreads
    assert row["bias_check_status"] == status
    assert row["error_message"] is None


def test_sample_file(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text(SAMPLE)
    df = ek.read_csv(spark, str(path))
    assert dict(df.dtypes) == {
        "feature1": "double", "feature2": "double", "sensitive_attr": "string", "target": "bigint",
    }
    row = ek.positive_rate_report(df, ["sensitive_attr"], "target").first()
    stats = {g: (s.positive_rate, s["count"]) for g, s in row["group_statistics"].items()}
    assert stats == {"groupA": (0.6, 5), "groupB": (0.6, 5)}
    assert row["positive_rate_difference"] == 0.0
    assert row["bias_check_status"] == "Passed"


def test_oversampling_of_the_biased_set(rows_from_counts):
    """952.5 rows are missing; ties go to the even number."""
    df = rows_from_counts(PARITY["biased"][0])
    plan = {r["sensitive_attr"]: r for r in ek.oversample_plan(df, ["sensitive_attr"], "target").collect()}
    assert plan["groupB"]["n_to_add"] == 952
    assert plan["groupA"]["n_to_add"] == 0
    out = ek.oversample(df, ["sensitive_attr"], "target", ["id"])
    assert out.count() == 1952
    after = ek.demographic_parity(out, ["sensitive_attr"], "target").first()
    assert after["demographic_parity_difference"] < 1 / 1000
    assert after["bias_check_status"] == "Passed"


def test_disparate_impact_of_the_biased_set(rows_from_counts):
    row = ek.disparate_impact_report(
        rows_from_counts(PARITY["biased"][0]), ["sensitive_attr"], "target"
    ).first()
    assert row["disparate_impact_min_max_ratio"] == 0.2664015904572565 / 0.7464788732394366
    assert row["bias_check_status"] == "Warning: Potential Adverse Impact Detected"
    assert [g["count"] for g in row["group_statistics"]] == [497, 503]


def test_split_sizes_of_the_toy_sets(rows_from_counts):
    splits = ek.train_val_test_split(rows_from_counts(PARITY["biased"][0]), ["id"])
    assert splits.sizes == {"train": 700, "val": 150, "test": 150}


def test_report_document(spark, rows_from_counts, tmp_path):
    report = ek.demographic_parity_report(rows_from_counts(PARITY["biased"][0]), ["sensitive_attr"], "target")
    path = tmp_path / "report"
    ek.write_report(report, str(path))
    (part,) = path.glob("part-*.json")
    document = json.loads(part.read_text())
    assert document["selection_rate_by_group"] == PARITY["biased"][1]
    assert document["demographic_parity_difference"] == 0.48007728278218015
