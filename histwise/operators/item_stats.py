"""Per-item statistics joined back to rows.

``item_summary`` gets first-attempt accuracy, answer counts and repeat
counts from two aggregations instead of ``ROW_NUMBER`` windows:

1. ``groupBy(user_id, content_id)``: attempts ``n`` and the first attempt
   (``min_by`` on ``(timestamp, row_id)``) -> one row per pair;
2. ``groupBy(content_id)``: ``answers = sum(n)``, ``answered_users = count``,
   ``answers after the first = sum(n - 1)``, ``users with a repeat = count(n >= 2)``,
   first-attempt accuracy over training rows.

Both are hash aggregates with map-side partial aggregation, so a very
popular item or a very active user never lands whole in one task, and the
result has one row per item (joined back by a size-checked broadcast).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histwise.functions.exprs import odds_weight, ratio


def user_item_pairs(q: DataFrame) -> DataFrame:
    """One row per (user, item): attempts and the first attempt's (val, outcome)."""
    first = F.min_by(F.struct(F.col("val").alias("val"),
                              F.col("answered_correctly").alias("ac")),
                     F.struct("timestamp", "row_id"))
    return q.groupBy("user_id", "content_id").agg(
        F.count(F.lit(1)).alias("n"), first.alias("first"))


def item_summary(q: DataFrame) -> DataFrame:
    """Per-item statistics; ``q`` = question rows with ``val`` (training flag 0)."""
    pairs = user_item_pairs(q)
    s = pairs.groupBy("content_id").agg(
        F.sum("n").alias("answers"),
        F.count(F.lit(1)).alias("answered_users"),
        F.sum(F.col("n") - 1).alias("answers_after_second_time"),
        F.sum(F.when(F.col("n") >= 2, 1).otherwise(0)).cast("long")
         .alias("answered_users_after_second_time"),
        F.avg(F.when(F.col("first.val") == 0, F.col("first.ac"))).alias("mean_content_accuracy"),
    )
    return s.select(
        "content_id", "answers", "answered_users",
        ratio(F.col("answers"), F.col("answered_users")).alias("answers_per_user"),
        "answers_after_second_time", "answered_users_after_second_time",
        ratio(F.col("answers_after_second_time"), F.col("answers"))
         .alias("answers_rate_after_second_time"),
        ratio(F.col("answered_users_after_second_time"), F.col("answered_users"))
         .alias("answered_user_rate_after_second_time"),
        F.coalesce(ratio(F.col("answers_after_second_time"),
                         F.col("answered_users_after_second_time")), F.lit(0.0))
         .alias("answers_per_user_after_second_time"),
        "mean_content_accuracy",
        odds_weight(F.col("mean_content_accuracy")).alias("weight"),
    )


def conditional_mean(lagged: DataFrame, min_support: int = 100) -> DataFrame:
    """Mean outcome of (previous outcome, previous item, item) among training rows whose
    previous row is a training row of the same part; groups of at least ``min_support`` rows
    (A5, A6, P10). ``lagged`` carries ``prev_*`` columns."""
    return (lagged
            .where((F.col("val") == 0) & (F.col("prev_val") == 0) & (F.col("part") == F.col("prev_part")))
            .groupBy("prev_answered_correctly", "prev_content_id", "content_id")
            .agg(F.avg("answered_correctly").alias("mean_content_accuracy"),
                 F.count(F.lit(1)).alias("size"))
            .where(F.col("size") >= min_support))
