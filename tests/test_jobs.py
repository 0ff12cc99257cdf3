import tempfile

import pytest
from pyspark.sql import functions as F

from paths import SF001
from histwise.operators.model import GBTParams, predict, train_all, train_cv
from histwise.plans import jobs, training
from histwise.plans.context import FeatureContext
from histwise.plans.matrix import FOLD, LABEL, feature_matrix, matrix_columns
from histwise.sources import sinks
from histwise.sources.testdata import load_inputs

NAMES = ["Fold", "Target", "UserCumulativeUserInteractions", "ContentNumberOfAnswers"]


@pytest.fixture(scope="module")
def ctx(spark):
    return FeatureContext(load_inputs(spark, SF001))


def test_feature_jobs_then_assembled_matrix(spark, ctx):
    root = tempfile.mkdtemp(prefix="hw-feat-")
    for n in NAMES:
        jobs.build_feature(ctx, n, root)
    m = jobs.load_matrix(spark, root, NAMES)
    fused = feature_matrix(ctx, NAMES[2:])
    assert m.count() == fused.count() == ctx.base().count()
    cols = ["row_id"] + matrix_columns(NAMES)
    a = sorted(tuple(r) for r in m.select(*cols).collect())
    b = sorted(tuple(r) for r in fused.select(*cols).collect())
    assert a == b
    assert dict(m.dtypes)["Fold_val"] == "tinyint"


def test_a_log_with_a_row_twice_publishes_nothing(spark, ctx):
    from dataclasses import replace
    from histwise.sources import tables
    root = tempfile.mkdtemp(prefix="hw-twice-")
    path = jobs.build_feature(ctx, "Target", root)
    inputs = load_inputs(spark, SF001)
    one = inputs.question_rows().orderBy("row_id").limit(1)
    twice = FeatureContext(replace(inputs, train=inputs.train.unionByName(one), _cache={}))
    with pytest.raises(tables.TableCheckError, match="2 times"):
        jobs.build_feature(twice, "Target", root)
    assert tables.info(spark, path).rows == ctx.base().count()


def test_stored_matrix_plan_has_no_exchange(spark, ctx):
    root = tempfile.mkdtemp(prefix="hw-plan-")
    for n in NAMES:
        jobs.build_feature(ctx, n, root)
    plan = jobs.load_matrix(spark, root, NAMES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == len(NAMES) - 1, plan


def test_debug_job_writes_first_rows(spark, ctx):
    root = tempfile.mkdtemp(prefix="hw-dbg-")
    jobs.build_feature(ctx, "Target", root, debug=True, debug_rows=100)
    got = sinks.read_feature(spark, root, "Target", debug=True)
    ids = sorted(r["row_id"] for r in ctx.base().select("row_id").collect())[:100]
    assert sorted(r["row_id"] for r in got.collect()) == ids


def test_refit_on_all_rows_and_model_round_trip(spark, ctx):
    m = feature_matrix(ctx, ["UserCumulativeUserInteractions", "ContentNumberOfAnswers"])
    feats = matrix_columns(["UserCumulativeUserInteractions", "ContentNumberOfAnswers"])
    nullable = training.nullable_columns(m, feats)
    p = GBTParams(max_iter=3, max_depth=3, max_bins=16)
    res = train_cv(m, feats, LABEL, [FOLD], p, nullable)
    model, vcols = train_all(m, feats, LABEL, p, res.best_iteration, nullable)
    assert model.stages[-1].getNumTrees == max(1, int(res.best_iteration * 1.1 * 1.3165))
    out = tempfile.mkdtemp(prefix="hw-model-")
    training.save_run(res, {"evals_result": {"oof_score": res.oof_score}}, out)
    back = sinks.load_model(out, "model_fold_0")
    from histwise.operators.model import model_inputs
    data, _ = model_inputs(m, feats, nullable)
    a = predict(res.folds[0].model, data, LABEL).orderBy("row_id").collect()
    b = predict(back, data, LABEL).orderBy("row_id").collect()
    assert a == b
    assert sinks.read_run_record(spark, out)["evals_result"]["oof_score"]["auc"] == res.oof_score["auc"]
