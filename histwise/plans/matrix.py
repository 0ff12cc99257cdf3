"""The fused feature job: all features of a run in one plan.

The window needs of all features are merged and evaluated once: for cold
users all windows share one hash exchange on ``user_id`` (the lecture union
of F11 sets it up, the filter after it keeps it); hot users go through the
blocked path (``plans.evaluate``). Item statistics and side
tables are size-checked broadcasts, so they add no exchange on the row
side. The posterior join is the one extra exchange; AQE turns it into a
broadcast when the aggregate is small at runtime.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from histwise.plans.context import FeatureContext
from histwise.plans.features import MATRIX_FEATURES, REGISTRY, build_features

LABEL = "Target_answered_correctly"
FOLD = "Fold_val"


def matrix_columns(names: Sequence[str]) -> list[str]:
    return [REGISTRY[n].out(c) for n in names for c in REGISTRY[n].columns]


def feature_matrix(ctx: FeatureContext, names: Sequence[str] = MATRIX_FEATURES,
                   with_target: bool = True) -> DataFrame:
    """``row_id``, Fold, Target and the chosen features (prefixed), one row per question row."""
    unknown = [n for n in names if n not in REGISTRY]
    if unknown:
        raise KeyError(f"unknown features {unknown}")
    wanted = (["Fold", "Target"] if with_target else []) + [n for n in names
                                                              if n not in ("Fold", "Target")]
    frame = build_features(ctx, [REGISTRY[n] for n in wanted])
    return frame.select("row_id", *matrix_columns(wanted))
