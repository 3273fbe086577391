from __future__ import annotations

import pytest

from riskmill.operators import results

SCHEMA = (
    "scenario string, scenario_label string, target string, stage string, model string, "
    "metric string, train_mean double, cv_mean double, cv_std double, gap double"
)


def row(model, cv, gap, metric="f2", scenario="early_warning", stage="tuned"):
    return (scenario, "Early Warning", "principal", stage, model, metric, cv + gap, cv, 0.0, gap)


def select(table, *rows, **options):
    return results.select_final_candidate(table(SCHEMA, *rows), "early_warning", **options)


@pytest.mark.parametrize("behind, taken", [(0.002, "calm"), (0.004, "calm"), (0.0125, "wild"), (0.25, "wild")])
def test_margin_decides_between_close_models(table, behind, taken):
    """Within the margin the smaller gap wins, beyond it the better metric."""
    rows = row("wild", 0.6, 0.125), row("calm", 0.6 - behind, 0.0625), row("poor", 0.125, 0.0)
    got = select(table, *rows)
    close = behind <= 0.01
    assert got["chosen_model"] == taken
    assert got["within_margin"] == (["calm", "wild"] if close else ["wild"])
    assert got["reason"] == (results.REASON_TIE.format(margin=0.01) if close else results.REASON_BEST)


@pytest.mark.parametrize("other", [
    row("dummy_prior", 1.0, 0.0), row("rival", 1.0, 0.0, stage="default"), row("rival", 1.0, 0.0, metric="f1"),
    row("rival", 1.0, 0.0, scenario="full"),
])
def test_only_tuned_models_of_the_scenario_compete(table, other):
    assert select(table, other, row("plain", 0.25, 0.0))["chosen_model"] == "plain"
    if other[4] == "dummy_prior":
        with pytest.raises(ValueError, match="early_warning"):
            select(table, other)


@pytest.mark.parametrize("train, cv, test", [(t, c, c + d) for t in (0.41, 0.73, 0.97) for c in (0.395, 0.72) for d in (-0.02, 0.01)])
def test_diagnosis(table, records, train, cv, test):
    df = table("train_mean double, cv_mean double, test_value double", (train, cv, test))
    got = records(results.diagnose_fit(df))[0]
    assert got["explanation"] == results.DIAGNOSES[got["diagnosis"]]
    if train - cv > 0.2:
        assert got["diagnosis"] == "overfitting"
    elif max(train, cv) < 0.5:
        assert got["diagnosis"] == "underfitting"
    else:
        assert got["diagnosis"] in ("overfitting", "ajuste_adequado")
    if max(train, cv) >= 0.5 and abs(train - cv) < 0.02:
        assert got["diagnosis"] == "ajuste_adequado"
    assert got["gap_train_cv"] == pytest.approx(train - cv)
    assert got["gap_cv_test"] == pytest.approx(cv - test)


def test_published_selection(table):
    """Fixed values, the published pair: forest 0.7721 (gap 0.0581) against logistic 0.7712 (0.0110)."""
    got = select(
        table, row("random_forest_balanced", 0.7721, 0.0581), row("logistic_balanced", 0.7712, 0.011)
    )
    assert got["chosen_model"] == "logistic_balanced"


def test_summary_and_table_order(table, records):
    folds = table("model string, metric string, cv_value double, train_value double",
                  ("m", "f2", 0.6, 0.9), ("m", "f2", 0.8, 0.9))
    got = records(results.summarize_folds(folds, ("model", "metric")))[0]
    assert got["cv_mean"] == pytest.approx(0.7) and got["cv_std"] == pytest.approx(0.1)
    assert got["gap"] == pytest.approx(0.2)
    extra = table("best_params string, model string", ("{}", "m"))
    joined = results.result_table([results.summarize_folds(folds, ("model", "metric")), extra])
    assert joined.columns == ["model", "metric", "train_mean", "cv_mean", "cv_std", "gap",
                              "best_params"]
    assert results.result_table([table(SCHEMA)]).count() == 0


def test_key_table_and_long_form(table, records):
    df = table(SCHEMA, row("a", 0.6, 0.1), row("a", 0.5, 0.3, metric="recall"), row("b", 0.7, 0.2))
    key = records(results.key_table(df))
    assert [r["model"] for r in key] == ["b", "a"]
    assert key[1]["gap_f2"] == 0.1 and key[1]["recall"] == 0.5 and key[0]["recall"] is None
    long = records(results.gap_long(df.where("metric = 'f2' and model = 'a'")))
    assert {r["part"]: r["value"] for r in long} == {
        "Treino": pytest.approx(0.7), "Validacao cruzada": 0.6}
    assert long[0]["label"] == "Early Warning | a"


def test_rankings(table, records):
    df = table(SCHEMA, *[row(f"m{i}", 0.1 * i, 0.01 * (5 - i)) for i in range(5)])
    assert [r["model"] for r in records(results.top_results(df, 3))] == ["m4", "m3", "m2"]
    assert [r["model"] for r in records(results.largest_gaps(df, 2))] == ["m0", "m1"]
    assert [r["model"] for r in records(results.model_order(df))][0] == "m4"
    wide = records(results.pivot_metric(df, ["m1", "m2", "absent"]))[0]
    assert wide["m2"] == pytest.approx(0.2) and wide["absent"] is None
