import pytest

import evenkeel as ek
from evenkeel.operators import contingency as contingency_module


def frame(spark, rows, schema="g string, y double"):
    return spark.createDataFrame(rows, schema)


def parity(df, **kw):
    return ek.demographic_parity(df, ["g"], "y", **kw).first()


def test_rate_is_equality_with_one(spark):
    df = frame(spark, [("a", 2.0), ("a", 1.0), ("b", 0.0), ("b", 1.0)])
    rates = {r["g"]: r["selection_rate"] for r in ek.selection_rate_by_group(df, ["g"], "y").collect()}
    assert rates == {"a": 0.5, "b": 0.5}
    means = {r["g"]: r["positive_rate"] for r in ek.positive_rate_by_group(df, ["g"], "y").collect()}
    assert means == {"a": 1.5, "b": 0.5}


def test_missing_rows_do_not_count(spark):
    df = frame(spark, [("a", 1.0), ("a", None), (None, 1.0), ("b", 0.0), ("b", float("nan"))])
    row = parity(df)
    assert (row["n_rows"], row["n_groups"], row["demographic_parity_difference"]) == (2, 2, 1.0)


def test_constant_target_passes(spark):
    row = ek.demographic_parity_report(frame(spark, [("a", 3.0), ("b", 3.0)]), ["g"], "y").first()
    assert row["overall_selection_rate"] == 3.0
    assert row["demographic_parity_difference"] == 0.0
    assert row["bias_check_status"] == "Passed"
    assert row["selection_rate_by_group"] == {}


def test_one_group_passes(spark):
    row = parity(frame(spark, [("a", 1.0), ("a", 0.0)]))
    assert (row["demographic_parity_difference"], row["bias_check_status"]) == (0.0, "Passed")


def test_no_rows_is_an_error(spark):
    row = parity(frame(spark, [(None, 1.0)]))
    assert (row["n_rows"], row["bias_check_status"]) == (0, "Error")


def test_threshold_is_strict(spark):
    df = frame(spark, [("a", 1.0), ("a", 0.0), ("b", 0.0)])
    assert parity(df, threshold=0.5)["bias_check_status"] == "Passed"
    assert parity(df, threshold=0.49)["bias_check_status"] == "Warning"


def test_text_and_boolean_targets(spark):
    text = frame(spark, [("a", "1"), ("a", "x"), ("b", "0")], "g string, y string")
    assert parity(text)["demographic_parity_difference"] == 0.5
    truth = frame(spark, [("a", True), ("b", False)], "g string, y boolean")
    assert parity(truth)["demographic_parity_difference"] == 1.0


def test_several_sensitive_columns(spark):
    df = frame(spark, [("a", "x", 1), ("a", "y", 0), ("b", "x", 1)], "g string, h string, y int")
    row = ek.demographic_parity_report(df, ["g", "h"], "y").first()
    assert row["selection_rate_by_group"] == {'["a","x"]': 1.0, '["a","y"]': 0.0, '["b","x"]': 1.0}
    labels = ek.group_key(df, ["g", "h"]).select("g_h").first()[0]
    assert labels == '["a","x"]'


def test_odd_column_names(spark):
    df = frame(spark, [("a", 1), ("b", 0)], "`g.r o`up` string, `y-1` int".replace("`g.r o`up`", "`g.r o up`"))
    row = ek.demographic_parity_report(df, ["g.r o up"], "y-1").first()
    assert row["selection_rate_by_group"] == {"a": 1.0, "b": 0.0}


def test_too_many_groups_for_a_document(spark, monkeypatch):
    monkeypatch.setattr(contingency_module, "DOCUMENT_GROUPS", 2)
    df = frame(spark, [("a", 1.0), ("b", 0.0), ("c", 1.0)])
    with pytest.raises(Exception, match="over 2 groups"):
        ek.demographic_parity_report(df, ["g"], "y").first()
    assert ek.selection_rate_by_group(df, ["g"], "y").count() == 3


def test_all_groups_are_listed(spark):
    df = spark.range(10_001).selectExpr("CAST(id AS string) AS g", "CAST(id % 2 AS double) AS y")
    row = ek.demographic_parity_report(df, ["g"], "y").first()
    assert len(row["selection_rate_by_group"]) == 10_001
    assert len(ek.disparate_impact_report(df, ["g"], "y").first()["group_statistics"]) == 10_001


@pytest.mark.parametrize("per_row", [1, 4, 1000])
def test_more_groups_than_a_document_holds(spark, monkeypatch, per_row):
    monkeypatch.setattr(contingency_module, "DOCUMENT_GROUPS", 2)
    df = frame(spark, [(f"g{i}", float(i % 2)) for i in range(20)] + [(None, 1.0), ("g1", 0.0)])
    rows = ek.demographic_parity_report(df, ["g"], "y", groups_per_row=per_row).collect()
    rates = [r["selection_rate_by_group"] for r in rows]
    assert sum(map(len, rates)) == 20 and (len(rows) == 1) == (per_row == 1000)
    assert {k: v for r in rates for k, v in r.items()} == {f"g{i}": 0.5 if i == 1 else i % 2 for i in range(20)}
    assert {(r["n_rows"], r["n_groups"], r["demographic_parity_difference"]) for r in rows} == {(21, 20, 1.0)}


def test_parts_of_a_report_on_no_groups_or_one_value(spark):
    for rows in ([], [("a", 1.0), ("b", 1.0)]):
        df = frame(spark, rows, "g string, y double")
        whole = ek.demographic_parity_report(df, ["g"], "y").collect()
        assert ek.demographic_parity_report(df, ["g"], "y", groups_per_row=10).collect() == whole


# Rates per group, then ratio and status.
LADDER = [
    ([1.0, 0.5], 0.5, "Warning: Potential Adverse Impact Detected"),
    ([1.0, 0.8], 0.8, "Passed"),
    ([0.0, 0.0], 1.0, "Passed (All rates zero)"),
    ([-1.0, 0.0], None, "Error (Max rate zero, Min rate non-zero)"),
    ([-1.0, -2.0], None, "Error (Max rate zero, Min rate non-zero)"),
    ([0.7, None], 1.0, "Skipped (Only one group)"),
    ([None, None], None, "Skipped (No valid rates)"),
    ([], None, "Skipped (No valid rates)"),
]


@pytest.mark.parametrize(("rates", "expected", "status"), LADDER)
def test_disparate_impact_ladder(spark, rates, expected, status):
    df = frame(spark, [(f"g{i}", r) for i, r in enumerate(rates)])
    row = ek.disparate_impact(df, ["g"], "y").first()
    assert (row["disparate_impact_min_max_ratio"], row["bias_check_status"]) == (expected, status)
    report = ek.disparate_impact_report(df, ["g"], "y").first()
    assert report["bias_check_status"] == status
    assert len(report["group_statistics"]) == len(rates)


def test_positive_rate_groups(spark):
    df = frame(spark, [("a", "1"), ("a", "x"), (None, "1"), ("b", None)], "g string, y string")
    got = {r["g"]: (r["positive_rate"], r["count"]) for r in ek.positive_rate_by_group(df, ["g"], "y").collect()}
    assert got == {"a": (1.0, 1), "b": (None, 0)}


def odds(spark, rows, **kw):
    return ek.equalized_odds(frame(spark, rows, "g string, y double, p double"), ["g"], "y", "p", **kw).first()


def test_group_without_positives(spark):
    rows = [("a", 1.0, 1.0), ("a", 0.0, 0.0), ("b", 0.0, 0.0)]
    row = odds(spark, rows)
    assert row["true_positive_rate_difference"] == 1.0
    assert row["equalized_odds_difference"] == 1.0
    assert row["bias_check_status"].startswith("Warning: Equalized Odds Difference (1.0000)")
    open_ = odds(spark, rows, zero_division=None)
    assert open_["true_positive_rate_difference"] == 0.0  # only one group has a rate


def test_odds_status(spark):
    same = [("a", 1.0, 1.0), ("a", 0.0, 0.0), ("b", 1.0, 1.0), ("b", 0.0, 0.0)]
    assert odds(spark, same)["bias_check_status"] == "Passed (Equalized Odds disparity within threshold)"
    nothing = odds(spark, [("a", 1.0, 1.0), ("b", 1.0, 1.0)], zero_division=None)
    assert nothing["bias_check_status"].startswith("Inconclusive")


@pytest.mark.parametrize("rows", [
    [("a", 2.0, 1.0), ("b", 0.0, 1.0)],
    [("a", -1.0, 1.0), ("b", 0.0, 1.0)],
    [(None, 1.0, 1.0)],
])
def test_odds_errors(spark, rows):
    row = odds(spark, rows)
    assert row["bias_check_status"] == "Calculation Error"
    assert row["error_message"]
    assert row["equalized_odds_difference"] is None


def test_labels_minus_one_and_one(spark):
    row = odds(spark, [("a", 1.0, 1.0), ("a", -1.0, -1.0), ("b", 1.0, -1.0), ("b", -1.0, -1.0)])
    assert row["error_message"] is None
    assert row["true_positive_rate_difference"] == 1.0


def test_labels_are_cut_and_text_is_dropped(spark):
    df = frame(
        spark, [("a", "1.9", "1"), ("a", "0.2", "0"), ("b", "1", "1"), ("b", "?", "1"), ("b", "0", "0")],
        "g string, y string, p string",
    )
    row = ek.equalized_odds(df, ["g"], "y", "p").first()
    assert (row["n_rows"], row["equalized_odds_difference"]) == (4, 0.0)


def test_results_do_not_depend_on_partitions(spark):
    rows = [(f"g{i % 3}", float(i % 5 == 0)) for i in range(500)]
    df = frame(spark, rows)
    a, b = df.repartition(1), df.repartition(7, "y").orderBy("y")
    assert parity(a) == parity(b)
    assert ek.disparate_impact(a, ["g"], "y").first() == ek.disparate_impact(b, ["g"], "y").first()


def test_counts_add_up_before_and_after_a_join(spark):
    facts = frame(spark, [(i % 4, int(i % 3 == 0)) for i in range(60)], "k int, y int")
    side = frame(spark, [(0, "a"), (1, "b"), (2, "a"), (3, "b")], "k int, g string")
    early = ek.recount(ek.contingency(facts, ["k"], "y").join(side, "k"), ["g"])
    late = ek.contingency(facts.join(side, "k"), ["g"], "y")
    assert sorted(map(tuple, early.collect())) == sorted(map(tuple, late.collect()))
