from __future__ import annotations

import math

import pytest

from riskmill.operators import cleaning, contract, dedup, profile


@pytest.fixture
def grades(table):
    return table(
        "row_id int, g1 double, g2 double, approved1 int, approved2 int",
        (1, 0.0, 12.4, 0, 1),
        (2, 14.0, 0.0, 1, 0),
        (3, 1.34e16, 1.73e16, 1, 1),
        (4, 10375.0, 13875.0, 1, 1),
    )


def test_two_columns_repaired_independently(grades, records):
    stats = {r["column_name"]: r for r in records(
        cleaning.repair_statistics(grades, ["g1", "g2", "absent"]))}
    assert set(stats) == {"g1", "g2"}
    for name in stats:
        assert stats[name]["n_values"] == 4
        assert stats[name]["n_corrected"] == 2
        assert stats[name]["pct_corrected"] == 50.0
        assert stats[name]["max_after"] <= 20
    fixed = cleaning.repair_columns(grades, ["g1", "g2", "absent"])
    assert all(r["ok"] for r in records(cleaning.all_in_scale(fixed, ["g1", "g2"])))
    assert grades.columns == fixed.columns
    assert [r["g1"] for r in records(grades)][2] == 1.34e16  # the input is unchanged


def test_numbers_as_text(table, records):
    df = table("g string", "13875", "14", "")
    fixed = [r["g"] for r in records(cleaning.repair_columns(df, ["g"]))]
    assert fixed == [13.875, 14.0, None]
    assert records(cleaning.repair_statistics(df, ["g"]))[0]["n_corrected"] == 1


def test_examples_come_in_row_order(grades, records):
    got = records(cleaning.repair_examples(grades, "g1", ["row_id"], n=1))
    assert got[0]["row_id"] == 3 and got[0]["after"] == pytest.approx(13.4)


@pytest.mark.parametrize("values, ok", [
    ([0.0, 20.0, 13.5], True), ([0.0, 25.0, 13.5], False), ([-1.0, 13.5], False),
    ([None, 3.0], True), ([None], True),
])
def test_all_in_scale(table, records, values, ok):
    assert records(cleaning.all_in_scale(table("g double", *values), ["g"]))[0]["ok"] is ok


def test_consistency_pairs_columns_of_the_same_period(table, records):
    df = table("a1 int, g1 double, a2 int, g2 double", (0, 0.0, 5, 12.0), (0, 13.5, 0, 0.0))
    got = records(cleaning.consistency_check(df, {"g1": "a1", "g2": "a2", "g3": "a3"}))
    assert [(r["ok"], r["n_violations"]) for r in got] == [(False, 1), (True, 0), (False, None)]


@pytest.mark.parametrize("small_distinct", [100, 0])
def test_distribution_check(table, records, small_distinct):
    df = table("g double", 10.0, 12.0, 13875.0, 1.34e16)
    got = records(cleaning.repair_distribution(df, ["g"], small_distinct=small_distinct))[0]
    assert got["untouched_n"] == 2 and got["corrected_n"] == 2
    assert got["n_corrupted_integers"] == 2 and got["pct_corrupted_integers"] == 100.0
    assert got["untouched_median"] == 11.0
    assert got["corrected_median"] == pytest.approx((13.875 + 13.4) / 2)
    assert got["ok"] is True


def test_distribution_needs_repaired_whole_numbers(table, records):
    nothing = records(cleaning.repair_distribution(table("g double", 10.0, 12.0), ["g"]))[0]
    assert nothing["ok"] is False and nothing["mean_difference"] is None
    assert nothing["all_corrected_within_scale"] is True
    fraction = records(cleaning.repair_distribution(table("g double", 10.0, 150.5), ["g"]))[0]
    assert fraction["ok"] is False and fraction["n_corrupted_integers"] == 0


def test_targets(table, records):
    df = table("Target string", "Desistente", "Graduado", "Matriculado", "Desistente")
    labelled = cleaning.add_targets(df, "Target", "Desistente", "Graduado")
    got = records(labelled)
    assert [r["target"] for r in got] == [1, 0, 0, 1]
    assert [r["target_excl_enrolled"] for r in got] == [1, 0, None, 1]
    assert [r["target_class"] for r in got] == [r["Target"] for r in records(df)]
    assert labelled.columns == ["target_class", "target", "target_excl_enrolled"]
    with pytest.raises(KeyError):
        cleaning.add_targets(df, "absent", "a", "b")


def test_raw_label_is_kept_where_names_have_case(spark, table):
    df = table("id int, Target string", (1, "Graduado"))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        columns = cleaning.add_targets(df, "Target", "Desistente", "Graduado").columns
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert columns == ["id", "Target", "target_class", "target", "target_excl_enrolled"]


def test_target_summary(table, records):
    rows = ["Desistente"] * 2 + ["Graduado"] * 3 + ["Matriculado"] * 5
    df = cleaning.add_targets(table("Target string", *rows), "Target", "Desistente", "Graduado")
    main, sensitivity = records(cleaning.target_summary(df))
    assert main["positive_share"] == 0.2 and main["total"] == 10
    assert sensitivity["positive_share"] == 0.4 and sensitivity["excluded"] == 5


def test_target_summary_of_nothing(table, records):
    df = table("target int, target_excl_enrolled int")
    assert all(r["positive_share"] is None for r in records(cleaning.target_summary(df)))


def test_missing_profile_counts_nan_and_null(table, records):
    df = table("a double, b string, c int", (1.0, "x", 1), (math.nan, "y", 2), (None, "z", 3))
    assert records(profile.missing_profile(df)) == [{"column_name": "a", "n_missing": 2}]


def test_histogram_edges(table, records):
    df = table("x double", 0.0, 1.0, 39.99, 40.0, None)
    got = {r["bin"]: r["n"] for r in records(profile.histogram(df, "x", 40))}
    assert got == {1: 1, 2: 1, 40: 2}
    constant = records(profile.histogram(table("x double", 5.0, 5.0), "x", 40))
    assert [(r["bin"], r["n"]) for r in constant] == [(1, 2)]


def test_duplicates_keep_the_first(table, records):
    df = table("id int, a int, b string", (3, 1, "x"), (1, 1, "x"), (2, 2, "y"), (9, None, "z"),
               (8, None, "z"))
    for order in (["id"], ["b", "id"]):
        kept = records(dedup.drop_exact_duplicates(df, ["a", "b"], order).orderBy("id"))
        assert [r["id"] for r in kept] == [1, 2, 8]
    report = records(dedup.duplicate_report(df, ["a", "b"]))[0]
    assert report == {
        "n_rows_before": 5, "n_rows_after": 3, "n_rows_in_duplicate_groups": 4,
        "n_duplicate_groups": 2, "n_removed": 2,
    }


def test_duplicates_carry_the_other_columns_of_the_first_row(table, records):
    df = table("id int, a int, note string", (2, 1, "second"), (1, 1, "first"), (3, 1, "third"))
    got = records(dedup.group_copies(df, ["a"], ["id"]))
    assert got == [{"id": 1, "a": 1, "note": "first", "n_copies": 3}]


def test_hot_duplicate_group(spark, records):
    """A third of the rows are copies of one row."""
    df = spark.range(3000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' else cast(id as string) end as text"
    )
    kept = dedup.drop_exact_duplicates(df, ["text"], ["id"])
    assert kept.count() == 2001
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "HashAggregate" in plan


def test_class_counts_keep_missing(table, records):
    df = table("c string", "a", None, "a")
    got = {r["c"]: r["n_rows"] for r in records(contract.class_counts(df, "c"))}
    assert got == {"a": 2, None: 1}
