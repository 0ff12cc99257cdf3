"""Feature storage and run outputs.

Everything is written with Spark writers straight to the target URI
(local path, HDFS or an object store): there is no separate upload step.
``debug`` runs write under ``features_debug/`` instead of ``features/``.
"""

from __future__ import annotations

import json
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histwise.sources import tables


def feature_root(root: str, debug: bool = False) -> str:
    return f"{root.rstrip('/')}/{'features_debug' if debug else 'features'}"


def feature_path(root: str, name: str, data_type: str = "training", debug: bool = False) -> str:
    return f"{feature_root(root, debug)}/{name}_{data_type}"


def write_feature(df: DataFrame, root: str, name: str, data_type: str = "training", debug: bool = False,
                  expected: tables.Keys | None = None) -> str:
    """Publish one feature table (key ``row_id`` + prefixed columns), once it is found whole."""
    path = feature_path(root, name, data_type, debug)
    tables.publish(df, path, expected=expected)
    return path


def read_feature(spark: SparkSession, root: str, name: str, data_type: str = "training",
                 debug: bool = False, narrow: bool = True) -> DataFrame:
    """Load a stored feature table (S8, S9), by default with the types its ranges allow (M2)."""
    return tables.read(spark, feature_path(root, name, data_type, debug), narrow)


def load_features(spark: SparkSession, root: str, names: Sequence[str], data_type: str = "training",
                  debug: bool = False) -> list[DataFrame]:
    return [read_feature(spark, root, n, data_type, debug) for n in names]


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """Raw files as (path, modificationTime, length, content) rows."""
    return spark.read.format("binaryFile").load(path)


def write_importances(df: DataFrame, out_dir: str) -> str:
    """Importances sorted descending, one CSV file with header."""
    path = f"{out_dir.rstrip('/')}/importances"
    (df.orderBy(F.desc("value"), "feature").coalesce(1)
       .write.mode("overwrite").option("header", True).csv(path))
    return path


def write_predictions(df: DataFrame, out_dir: str, name: str = "oof_pred") -> str:
    path = f"{out_dir.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path


def _plain(o):
    if isinstance(o, dict):
        return {str(k): _plain(v) for k, v in o.items()}
    if isinstance(o, (list, tuple)):
        return [_plain(v) for v in o]
    if hasattr(o, "item"):
        return o.item()
    return o


def write_run_record(spark: SparkSession, record: dict, out_dir: str) -> str:
    """The run record (config + scores) as one JSON document."""
    path = f"{out_dir.rstrip('/')}/output"
    doc = json.dumps(_plain(record), sort_keys=True)
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_run_record(spark: SparkSession, out_dir: str) -> dict:
    rows = spark.read.text(f"{out_dir.rstrip('/')}/output").collect()
    return json.loads("".join(r["value"] for r in rows))


def save_model(model: PipelineModel, out_dir: str, name: str) -> str:
    path = f"{out_dir.rstrip('/')}/{name}"
    model.write().overwrite().save(path)
    return path


def load_model(out_dir: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{out_dir.rstrip('/')}/{name}")
