"""Command-line jobs: feature tables from a log, and a training run from a config.

    python -m histwise.run features --inputs DIR --out DIR [--names A B ...] [--debug]
    python -m histwise.run train --inputs DIR --out DIR --config run.json [--features DIR] [--debug]

``--inputs`` holds the tables ``train``, ``questions``, ``lectures``, ``val_row_id`` and ``embeddings`` as parquet.
``train`` takes its matrix from the stored feature tables of ``--features``, or computes it from the log.
``--debug`` works on the first rows by ``row_id`` and writes to a folder of its own.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from histwise.operators import matrix as M
from histwise.plans import jobs, training
from histwise.plans.context import FeatureContext
from histwise.plans.features import MATRIX_FEATURES
from histwise.plans.matrix import feature_matrix
from histwise.session import apply_sizing, work_path
from histwise.sources import tables
from histwise.sources.inputs import Inputs


def feature_job(ctx: FeatureContext, out: str, names: Sequence[str], debug: bool = False) -> list[str]:
    """Publish each feature's table; the paths."""
    return [jobs.build_feature(ctx, name, out, debug=debug) for name in names]


def run_matrix(ctx: FeatureContext, config: training.RunConfig, features: str | None, debug: bool) -> DataFrame:
    names = [config.target, *config.folds, *config.features]
    if features:
        return jobs.load_matrix(ctx.inputs.spark, features, names, debug=debug, narrow=False)
    m = feature_matrix(ctx, config.features)
    return M.debug_sample(m, jobs.DEBUG_ROWS) if debug else m


def train_job(ctx: FeatureContext, out: str, config: training.RunConfig, features: str | None = None, debug: bool = False) -> dict:
    """Train one run and save its models, predictions, importances and record under ``out``; the record."""
    spark = ctx.inputs.spark
    work = work_path(spark, "run")
    # the matrix of a debug run has other keys than the log
    res, record = training.run(None if debug else ctx, config, run_matrix(ctx, config, features, debug), work)
    training.save_run(res, record, f"{out.rstrip('/')}{'_debug' if debug else ''}")
    tables.discard(spark, work)
    return record


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="histwise.run")
    p.add_argument("job", choices=["features", "train"])
    p.add_argument("--inputs", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--names", nargs="*", default=["Fold", "Target", *MATRIX_FEATURES])
    p.add_argument("--config")
    p.add_argument("--features")
    p.add_argument("--debug", action="store_true")
    a = p.parse_args(argv)
    if a.job == "train" and not a.config:
        p.error("train needs --config")
    spark = SparkSession.builder.appName(f"histwise-{a.job}").getOrCreate()
    apply_sizing(spark, a.inputs)
    ctx = FeatureContext(Inputs.from_folder(spark, a.inputs))
    if a.job == "features":
        print("\n".join(feature_job(ctx, a.out, a.names, a.debug)))
        return
    text = "\n".join(r["value"] for r in spark.read.text(a.config, wholetext=True).collect())
    record = train_job(ctx, a.out, training.RunConfig.from_json(text), a.features, a.debug)
    print(json.dumps(record["evals_result"], indent=1))


if __name__ == "__main__":
    main()
