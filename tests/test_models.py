"""Training queries have no SQL counterpart: their properties are checked instead."""

import pytest

from scoreloom.operators import evaluate, model as learning
from scoreloom.operators.score import with_probability
from scoreloom.catalog import QUERIES, SQL
from scoreloom.catalog.model_queries import SMALL, STOPPED, _prepared

TRAINING = sorted(set(QUERIES) - set(SQL))


def rows(spark, folder, name):
    return QUERIES[name](spark, folder).collect()


@pytest.mark.parametrize("name", ["train_gbt", "train_gbt_lgb_preset", "retrain_selected"])
def test_models_beat_chance(spark, small_dir, name):
    auc = {r["split"]: r["roc_auc"] for r in rows(spark, small_dir, name)}
    assert set(auc) == {"train", "val", "test"} and auc["test"] > 0.6


def test_validation_stops_the_fit(spark, small_dir):
    """The best round lies more than the patience before the last, so the loss has stopped the fit."""
    rounds = {r["rounds"] for r in rows(spark, small_dir, "train_gbt")}
    assert len(rounds) == 1 and 1 <= rounds.pop() <= STOPPED["n_estimators"] - 10


def test_search_orders_trials(spark, small_dir):
    for name, n_params in (("tune_random", 7), ("tune_random_lgb", 6)):
        trials = rows(spark, small_dir, name)
        aucs = [t["auc"] for t in trials]
        assert len(trials) == 4 and aucs == sorted(aucs, reverse=True) and {t["n_params"] for t in trials} == {n_params}


def test_saved_model_gives_same_probabilities(spark, small_dir):
    row = rows(spark, small_dir, "model_roundtrip")[0]
    assert row["n_rows"] == 1165 and row["gap"] == 0.0


def test_probabilities_lie_between_0_and_1(spark, small_dir):
    found = rows(spark, small_dir, "score_probability")
    assert len(found) == 1165 and all(0 <= r["probability"] <= 1 for r in found)


def test_importance_names_every_feature(spark, small_dir):
    found = sorted(rows(spark, small_dir, "importance_table"))
    assert len(found) == 17 and abs(sum(r["importance"] for r in found) - 1) < 1e-9
    assert all((r["split"] > 0) == (r["importance"] > 0) for r in found)
    assert found[4]["variable"] == "total_price" and found[4]["importance"] > 0


def test_stored_features_keep_their_order(spark, small_dir):
    names = [r["variable"] for r in sorted(rows(spark, small_dir, "registry_features"))]
    assert names[:3] == ["acctbal", "is_overdrawn", "region_key"] and names[-1] == "urgent_status_P"


def test_guided_draws_go_where_trials_did_well():
    """On a made-up measure with one peak the guided trials come much nearer to it than as many random ones."""
    bounds = {"a": (0.0, 1.0), "b": (-5.0, 5.0), "fixed": (2, 2), "max_depth": (2, 10)}
    gain = lambda p: -(p["a"] - 0.83) ** 2 - ((p["b"] - 3.1) / 10) ** 2 - ((p["max_depth"] - 8) / 16) ** 2

    def found(seed, guided):
        done = [learning.Trial(i, p, 1, gain(p)) for i, p in enumerate(learning.draw_params(bounds, 5 if guided else 35, seed))]
        while len(done) < 35:
            for p in learning.guided_params(bounds, done, 2, seed):
                assert 0 <= p["a"] <= 1 and -5 <= p["b"] <= 5 and p["fixed"] == 2 and p["max_depth"] in range(2, 11)
                done.append(learning.Trial(len(done), p, 1, gain(p)))
        return max(t.auc for t in done)

    guided, chance = ([found(seed, way) for seed in range(20)] for way in (True, False))
    assert sum(guided) / sum(chance) < 0.7
    one = [learning.Trial(0, {"a": 0.5}, 1, float("nan"))]
    assert learning.guided_params({"a": (0, 1)}, one, 3, 1) == learning.guided_params({"a": (0, 1)}, one, 3, 1)
    assert learning.guided_params({"a": (0, 1)}, one, 0, 1) == []


def test_whole_runs(spark, small_dir):
    row = rows(spark, small_dir, "development_run")[0]
    assert 1 <= row["rounds"] <= row["most_rounds"] and 14 <= row["most_rounds"] <= 20
    assert row["final_model"] == "xgb_240101_100000" and row["test_roc"] > 0.6 and 0 <= row["psi"] < 1
    grades = rows(spark, small_dir, "monthly_scoring_run")
    assert sum(r["general_count"] for r in grades) == 884 == QUERIES["prep_scoring"](spark, small_dir).count()
    assert abs(sum(r["general_percentage"] for r in grades) - 100) < 1e-9


def test_refit_is_a_prefix_and_auc_per_round_is_exact(spark, small_dir):
    prepared = _prepared(spark, small_dir)
    train, val, names = prepared.part("train"), prepared.part("val"), prepared.encoder.names
    long = learning.fit_model(train, None, names, {**SMALL, "n_estimators": 4})
    vectors = learning.Learner(tuple(names), SMALL).vectors(val)
    per_round = learning.auc_per_round(long.model.stages[-1], vectors)
    assert len(per_round) == 4
    for rounds in (2, 4):
        short = learning.fit_model(train, None, names, {**SMALL, "n_estimators": rounds})
        assert evaluate.auc_value(with_probability(val, short.model)) == pytest.approx(per_round[rounds - 1], abs=1e-9)
        assert learning.auc_at_round(long.model.stages[-1], vectors, rounds) == pytest.approx(per_round[rounds - 1], abs=1e-9)


def test_patience():
    assert learning.best_round([0.5, 0.6, 0.55, 0.7], patience=2) == 4
    assert learning.best_round([0.5, 0.6, 0.55, 0.58, 0.9], patience=2) == 2
    assert learning.best_round([0.5], patience=10) == 1


def test_fit_lengths():
    assert learning.fit_lengths(300) == [75, 300] and learning.fit_lengths(500) == [32, 125, 500]
    assert learning.fit_lengths(20) == [20] and learning.fit_lengths(1) == [1] and learning.fit_lengths(16, 2) == [4, 16]
    assert learning.fit_lengths(9, 0) == [3, 9]
    assert all(sum(learning.fit_lengths(n)) <= 1.4 * n for n in range(20, 600))
    assert learning.stop_of([0.5, 0.6, 0.55, 0.58], 2) == (2, True) and learning.stop_of([0.5, 0.6, 0.55], 2) == (2, False)


@pytest.mark.parametrize("part,most,patience,lengths", [("val", 16, 2, [4]), ("train", 12, 1, [3, 12])])
def test_short_fits_stop_where_the_long_one_does(spark, small_dir, monkeypatch, part, most, patience, lengths):
    """A fit that overfits at once never gets long; one judged by its own rows does, and both keep the same rounds."""
    prepared = _prepared(spark, small_dir)
    train, names = prepared.part("train"), tuple(prepared.encoder.names)
    learner = learning.Learner(names, {"max_depth": 4, "learning_rate": 0.3, "n_estimators": most})
    vectors = learner.vectors(prepared.part(part))
    want = learning.best_round(
        learning.round_values(learner.fit(train, learner.max_rounds).stages[-1], vectors, "logloss"), patience)
    fitted, fit = [], learning.Learner.fit
    monkeypatch.setattr(learning.Learner, "fit", lambda self, df, n: fitted.append(n) or fit(self, df, n))
    model, rounds = learning.fit_until_stopped(learner, train, vectors, patience)
    assert rounds == want and fitted == lengths and len(model.stages[-1].treeWeights) == lengths[-1]


def test_parameter_mapping(caplog):
    settings = learning.gbt_params(
        {"max_depth": 4.9, "learning_rate": 0.05, "n_estimators": 20.7, "min_child_weight": 3.2, "gamma": 5,
         "subsample": 0.7, "colsample_bytree": 0.5, "reg_alpha": 1.0}
    )
    assert settings["maxDepth"] == 4 and settings["maxIter"] == 20 and settings["minInstancesPerNode"] == 3
    assert settings["featureSubsetStrategy"] == "0.5" and settings["minInfoGain"] == pytest.approx(0.025)
    assert "reg_alpha" in caplog.text
    with pytest.raises(ValueError):
        learning.check_model_type("svm")


def test_draws_are_repeatable():
    bounds = {"max_depth": (3, 10), "learning_rate": (0.01, 0.2)}
    assert learning.draw_params(bounds, 3, 1) == learning.draw_params(bounds, 3, 1)
    assert all(3 <= d["max_depth"] <= 10 for d in learning.draw_params(bounds, 50, 7))
