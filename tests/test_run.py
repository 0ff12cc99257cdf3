"""The command-line jobs: feature tables, then a run from a config over them."""

import json
import os
import tempfile

import pytest

from histwise import run
from histwise.plans import training
from histwise.sources import sinks, tables
from histwise.sources.inputs import Inputs
from histwise.sources.testdata import load_inputs
from paths import SF001

NAMES = ["Fold", "Target", "UserCumulativeUserInteractions", "ContentNumberOfAnswers"]


@pytest.fixture(scope="module")
def folder(spark):
    """The bound test tables as a folder of parquet files, as a user would have them."""
    root = tempfile.mkdtemp(prefix="hw-inputs-")
    own = load_inputs(spark, SF001)
    for name in ("train", "questions", "lectures", "val_row_id", "embeddings"):
        getattr(own, name).write.parquet(f"{root}/{name}.parquet")
    return root


def test_features_then_train(spark, folder, capsys):
    out = tempfile.mkdtemp(prefix="hw-cli-")
    config = f"{out}/run.json"
    with open(config, "w") as f:
        json.dump({"features": NAMES[2:], "target": ["Target"], "folds": ["Fold"], "model": {
            "name": "lightgbm", "model_params": {"learning_rate": 0.5, "max_depth": 3, "num_iterations": 6},
            "train_params": {"early_stopping_rounds": 2}}}, f, indent=1)
    run.main(["features", "--inputs", folder, "--out", out, "--names", *NAMES])
    assert len(capsys.readouterr().out.split()) == len(NAMES)
    run.main(["train", "--inputs", folder, "--out", f"{out}/stored", "--config", config, "--features", out])
    stored = json.loads(capsys.readouterr().out)
    run.main(["train", "--inputs", folder, "--out", f"{out}/fused", "--config", config])
    fused = json.loads(capsys.readouterr().out)
    rows = Inputs.from_folder(spark, folder).question_rows().count()
    assert stored["n_data"] == fused["n_data"] == rows and stored["n_features"] == 6
    assert stored["oof_score"]["auc"] == pytest.approx(fused["oof_score"]["auc"], abs=0.05)
    record = sinks.read_run_record(spark, f"{out}/stored")
    assert record["config"]["train_params"] == {"early_stopping_rounds": 2} and record["n_folds"] == 1
    m = tables.assemble(spark, [sinks.feature_path(out, n) for n in NAMES])
    assert training.predict_cv(spark, f"{out}/stored", m).count() == rows


def test_debug_jobs_keep_apart(spark, folder, capsys, monkeypatch):
    monkeypatch.setattr(run.jobs, "DEBUG_ROWS", 300)
    out = tempfile.mkdtemp(prefix="hw-cli-")
    run.main(["features", "--inputs", folder, "--out", out, "--names", "Target", "--debug"])
    assert os.listdir(out) == ["features_debug"]
    config = f"{out}/run.json"
    with open(config, "w") as f:
        json.dump({"features": NAMES[2:], "model": {"model_params": {"max_depth": 2, "num_iterations": 2}}}, f)
    run.main(["train", "--inputs", folder, "--out", f"{out}/r", "--config", config, "--debug"])
    assert sorted(os.listdir(out)) == ["features_debug", "r_debug", "run.json"]
    assert sinks.read_run_record(spark, f"{out}/r_debug")["evals_result"]["n_data"] == 300


def test_train_needs_a_config(folder):
    with pytest.raises(SystemExit):
        run.main(["train", "--inputs", folder, "--out", "x"])
