"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histwise.session import ensure_checkpoint_dir

#: Prefix of every helper column that the operators add to a caller's table.
OWN = "__llm_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, and every
    later read of it (also after a lost executor) sees the same rows."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


#: A key counts as hot if it holds more than this share of all rows; so there are fewer than 1000.
HOT_SHARE = 1e-3


def hot_join(rows: DataFrame, one: DataFrame, keys: list[str], n: str, spread: Column) -> DataFrame:
    """``rows`` joined with ``one``, which has a row for each of their keys (none of them null) and the
    number ``n`` of rows with this key.

    Keys of more than ``HOT_SHARE`` of all rows (and of more than one) are fewer than 1 / HOT_SHARE; these are broadcast. Their
    rows go through the shuffle of the others dealt by ``spread``, so no task gets them together."""
    total = one.agg(F.sum(n)).first()[0] or 0
    values = [c for c in one.columns if c not in keys and c != n]
    hot = one.where(F.col(n) > max(total * HOT_SHARE, 1)).select(*keys, F.struct(*values).alias(f"{OWN}hot"))
    cold = one.select(*keys, F.struct(*values).alias(f"{OWN}cold"), F.lit(0).cast("long").alias(f"{OWN}deal"))
    out = rows.join(F.broadcast(hot), keys, "left")
    out = out.withColumn(f"{OWN}deal", F.when(F.col(f"{OWN}hot").isNull(), F.lit(0)).otherwise(F.pmod(spread, F.lit(1_000_000)) + 1).cast("long"))
    out = out.join(cold, [*keys, f"{OWN}deal"], "left")
    both = F.coalesce(f"{OWN}hot", f"{OWN}cold")
    return out.select(*rows.columns, *[both[v].alias(v) for v in values])


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package also where it is not installed but only on the
    driver's path, at the same place on every node."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, root]))
    return spark
