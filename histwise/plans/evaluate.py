"""Evaluate declared window needs over the question rows, skew-aware.

Cold users (at most ``SkewPolicy.max_rows_per_key`` rows) take the plain
path: one hash exchange on ``user_id`` and Spark window operators. Hot users
take the blocked path of :mod:`histwise.operators.skew`. Both paths add the
same columns with the same types, and the two halves are unioned by name.

Lecture flags (F11) need lecture rows in the same history: lecture rows are
first reduced to one mark per (user, timestamp) (map-side combined), then
merged into the question stream. Both paths order marks before the questions
of the same timestamp and take a running MAX, which equals the RANGE frame
(same timestamp = peer) of the definition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histwise.functions.exprs import flag
from histwise.operators import skew
from histwise.operators import windows as W
from histwise.sources.testdata import LECTURE_TYPES

USER = ("user_id",)
N_PARTS = 7
# Evaluation order of key families: later families may lag columns of earlier ones.
FAMILY_ORDER = (("user_id",), ("user_id", "part"), ("user_id", "content_id"))

LECTURE_FLAGS = (["is_lecture"] + [f"is_lecture_part_{p}" for p in range(1, N_PARTS + 1)]
                 + [f"is_lecture_type_of_{t.replace(' ', '_')}" for t in LECTURE_TYPES])
SEEN = [f"_seen_{n}" for n in LECTURE_FLAGS]
MARK_ORDER = ("timestamp", "_is_q", "row_id")


def lecture_marks(train_full: DataFrame) -> DataFrame:
    """Lecture rows reduced to one row per (user, timestamp) with the 12 flags (max)."""
    lec = train_full.where(F.col("content_type_id") == 1)
    exprs = [F.lit(1)]
    exprs += [flag(F.col("lecture_part") == p) for p in range(1, N_PARTS + 1)]
    exprs += [flag(F.col("lecture_type_of") == t) for t in LECTURE_TYPES]
    return lec.groupBy("user_id", "timestamp").agg(
        *[F.max(e).alias(f"_lf_{n}") for e, n in zip(exprs, LECTURE_FLAGS)])


def _ordered_specs(specs: Sequence[W.Spec]) -> list[W.Spec]:
    merged = {s.key: s for s in W.merge_specs(specs)}
    unknown = [k for k in merged if k not in FAMILY_ORDER]
    return [merged[k] for k in FAMILY_ORDER if k in merged] + [merged[k] for k in unknown]


def _seen_plain(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Lecture flags seen up to and at each question's timestamp.

    Marks carry a NULL ``row_id``, so under the ``(timestamp, row_id)`` order (NULLs
    first) they precede the questions of their timestamp, and a ROWS running MAX equals
    the RANGE frame of the definition for every question row. Ordering like the user
    family's windows lets those reuse this sort: one sort of the stream instead of two.
    """
    both = (rows.withColumn("_is_q", F.lit(True))
                .unionByName(marks.withColumn("_is_q", F.lit(False)), allowMissingColumns=True))
    upto = W.ordered(USER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumns({s: F.max(F.col(f"_lf_{n}")).over(upto)
                             for s, n in zip(SEEN, LECTURE_FLAGS)})
    return both.where(F.col("_is_q")).drop("_is_q", *[f"_lf_{n}" for n in LECTURE_FLAGS])


def plain_path(rows: DataFrame, marks: DataFrame | None, specs: Sequence[W.Spec], bounds: dict | None = None) -> DataFrame:
    f = _seen_plain(rows, marks) if marks is not None else rows
    for spec in specs:
        f, whole, finish = W.exact_spec(f, spec, bounds)
        f = finish(W.evaluate(f, whole))
    return f


def blocked_path(rows: DataFrame, marks: DataFrame | None, specs: Sequence[W.Spec],
                 n_blocks: int, bounds: dict | None = None) -> DataFrame:
    s = rows.withColumn("_is_q", F.lit(True))
    if marks is not None:
        s = s.unionByName(marks.withColumn("_is_q", F.lit(False)), allowMissingColumns=True)
    b = skew.assign_blocks(s, USER, MARK_ORDER, n_blocks)
    if marks is not None:
        b = skew.prefix_max_blocked(b, USER, {s_: F.col(f"_lf_{n}") for s_, n in zip(SEEN, LECTURE_FLAGS)},
                                    MARK_ORDER)
        b = b.where(F.col("_is_q")).drop(*[f"_lf_{n}" for n in LECTURE_FLAGS])
        b = skew.freeze(b)
    b = b.drop("_is_q")
    for i, spec in enumerate(specs):
        b, whole, finish = W.exact_spec(b, spec, bounds)
        b = finish(skew.evaluate_blocked(b, whole))
        # Each step reads its input twice (block totals and the rows); freezing the hot
        # rows between steps keeps every step's plan a fixed size instead of doubling.
        if i < len(specs) - 1:
            b = skew.freeze(b)
    return b.drop("_blk")


def _is_floating(rows: DataFrame, value) -> bool:
    return rows.select(value.alias("v")).dtypes[0][1] in W.FLOATING


def compute_windows(rows: DataFrame, specs: Sequence[W.Spec], marks: DataFrame | None = None,
                    hot: skew.HotSplit | None = None, bounds: dict | None = None) -> DataFrame:
    """Add all window columns of ``specs`` (and lecture flags if ``marks``) to ``rows``.

    ``hot`` (from :func:`skew.hot_keys`) routes the rows of hot users to the blocked path. ``bounds``: smallest
    and largest magnitude of floating values that are summed, by output; others are looked up once, here,
    so that both paths cut them into the same digits.
    """
    specs = _ordered_specs(specs)
    bounds = dict(bounds or {})
    if hot is None:
        return plain_path(rows, marks, specs, bounds)
    for s in specs:
        missing = {n: v for n, v in {**s.sums_before, **{n: v for n, (v, _) in s.slides.items()}}.items() if n not in bounds}
        floating = [n for n in missing if _is_floating(rows, missing[n])]
        bounds.update(zip(floating, W.value_bounds(rows, [missing[n] for n in floating]) if floating else []))
    cold_rows, hot_rows = skew.split(rows, hot.keys, USER)
    cold_marks, hot_marks = (skew.split(marks, hot.keys, USER) if marks is not None
                             else (None, None))
    cold = plain_path(cold_rows, cold_marks, specs, bounds)
    return cold.unionByName(blocked_path(hot_rows, hot_marks, specs, hot.n_blocks, bounds))
