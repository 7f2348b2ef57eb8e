"""Registered model queries hand the whole protocol to the operators: nothing is fitted here."""

import pytest

from riskweft.operators import features as fe
from riskweft.plans import experiments as ex, models as md, workflows as wf
from riskweft.queries import modeling as mq
from riskweft.queries.registry import QUERIES


@pytest.fixture
def calls(monkeypatch):
    made = {}

    def catch(module, name, result):
        monkeypatch.setattr(module, name, lambda *args, **kwargs: made.update({name: (args, kwargs)}) or result)

    class Stop(Exception):
        pass

    def stop(module, name):
        def caught(*args, **kwargs):
            made[name] = (args, kwargs)
            raise Stop

        monkeypatch.setattr(module, name, caught)

    monkeypatch.setattr(mq, "labelled", lambda spark, sf: "panel")
    monkeypatch.setattr(mq, "prepared", lambda spark, sf: (["c"], "train", "validation"))
    monkeypatch.setattr(mq, "train_features", lambda spark, sf: "features")
    monkeypatch.setattr(mq, "staging_path", lambda spark, name: name)
    monkeypatch.setattr(mq, "stage", lambda df, name="": df)
    catch(ex, "part", type("T", (), {"drop": lambda self, *c: self})())
    catch(ex, "a3_builder", lambda df: df)
    catch(ex, "oof_scores", "oof")
    for module, names in (
        (ex, ("temporal_experiments", "frozen_promotion", "grid_search", "random_search", "hard_negative_experiments", "resampling_experiments", "feature_group_experiments")),
        (wf, ("modeling_workflow", "variant_workflow", "optimization_workflow", "trajectory_workflow", "hard_negative_workflow", "continuation_workflow")),
    ):
        for name in names:
            stop(module, name)

    def run(query, name):
        with pytest.raises(Stop):
            query(None, "")
        return made[name]

    run.made = made
    return run


def test_models_have_the_full_settings():
    assert mq.BOOST == md.base_boosted() and mq.BOOST.settings["n_estimators"] == 200
    for spec in (mq.LOGISTIC, mq.TREE, mq.FOREST, mq.HIST):
        assert spec.settings == md.DEFAULTS[spec.family]
    assert mq.CAT.settings == md.CATBOOST_CONFIGS[3]


def test_searches_sets_and_folds_are_whole(calls, monkeypatch):
    assert len(calls(mq.tun1_grid_search, "grid_search")[0][3]) == 18
    args, kwargs = calls(mq.tun2_random_search, "random_search")
    assert args[4] == md.F1_SPACE and not args[5:] and not kwargs
    args, _ = calls(mq.mod15_temporal_sets, "temporal_experiments")
    assert args[1] == md.base_boosted() and args[2] == 3 and args[3] == fe.TEMPORAL_SETS
    args, _ = calls(mq.mod16_frozen_promotion, "frozen_promotion")
    assert [s.params for s in args[2].values()] == list(md.CATBOOST_CONFIGS) and args[3] == 3
    assert calls(mq.mod14_resampled_refits, "resampling_experiments")[0][4] == ex.RESAMPLING
    assert calls(mq.mod10_hard_negative_experiments, "hard_negative_experiments")[0][4] == md.base_boosted()
    assert calls.made["oof_scores"][0][2] == 5
    asked = {}
    monkeypatch.setattr(mq, "validated", lambda spark, sf, specs: asked.update(specs))
    mq.mod3_decision_tree(None, "")
    assert [s.weighting for s in asked.values()] == [None, "balanced", "manual_light"]


def test_feature_group_experiments_are_registered(calls):
    for name, sets, n in (("feature_experiments", fe.EXPERIMENTS, 6), ("focused_experiments", fe.FOCUSED_EXPERIMENTS, 3), ("ablations", fe.ABLATIONS, 4)):
        args, kwargs = calls(QUERIES[f"mod15_{name}"], "feature_group_experiments")
        assert args == ("panel", sets, md.base_boosted()) and len(sets) == n and not kwargs


def test_workflows_run_with_their_defaults(calls):
    for name in ("modeling", "hard_negative", "continuation"):
        assert calls(getattr(mq, f"flow_{name}_workflow"), f"{name}_workflow") == (("panel",), {})
    assert calls(mq.flow_trajectory_workflow, "trajectory_workflow") == (("panel", "run"), {})
    args, kwargs = calls(mq.flow_variant_workflow, "variant_workflow")
    assert args == ("panel",) and list(kwargs) == ["grids"] and len(kwargs["grids"]["xgboost"]) == 18
    args, kwargs = calls(mq.flow_optimization_workflow, "optimization_workflow")
    assert args[1] == md.base_boosted() and len(args[2]) == 18 and args[3] == md.F1_SPACE and not args[5:] and not kwargs
