"""Feature jobs (M1): compute one feature, check it while it is written, publish it.

``build_feature`` computes the feature on all rows, prefixes its columns with the class name (P5) and
writes the table under ``features/`` or, in debug mode, the first ``debug_rows`` rows by ``row_id`` under
``features_debug/`` (S4, L2, S6, S7). The pass that writes also checks: one row for each question row
of the log, no ``row_id`` twice (S3, J9). A table that fails is not published; the one before it stays.
Ranges are taken in the same pass, and narrow types (M2) are applied when the table is read.
``load_matrix`` assembles stored tables by key (S8, M3, J7, J9).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from histwise.operators import matrix as M
from histwise.plans.context import FeatureContext
from histwise.plans.features import REGISTRY, Feature, build_features
from histwise.sources import sinks, tables

DEBUG_ROWS = 10_000


def prefixed(ctx: FeatureContext, feat: Feature | str) -> DataFrame:
    """``row_id`` + the feature's columns named ``{Class}_{column}``."""
    f = REGISTRY[feat] if isinstance(feat, str) else feat
    return build_features(ctx, [f]).select("row_id", *[f.out(c) for c in f.columns])


def build_feature(ctx: FeatureContext, feat: Feature | str, root: str, debug: bool = False,
                  debug_rows: int = DEBUG_ROWS) -> str:
    """Publish one feature's table under ``root``; returns its path."""
    f = REGISTRY[feat] if isinstance(feat, str) else feat
    df, expected = prefixed(ctx, f), ctx.keys()
    if debug:
        df, expected = M.debug_sample(df, debug_rows), tables.Keys(min(expected.rows, debug_rows))
    return sinks.write_feature(df, root, f.name, debug=debug, expected=expected)


def load_matrix(spark: SparkSession, root: str, names: Sequence[str], debug: bool = False,
                narrow: bool = True, to_float32: bool = False) -> DataFrame:
    """Stored feature tables side by side, by merge joins without an exchange."""
    return tables.assemble(spark, [sinks.feature_path(root, n, debug=debug) for n in names], narrow, to_float32)
