"""The feature registry (X1) and the seventeen feature operators.

A feature declares what it needs and how it finishes:

* ``specs(params)``  window columns over key families (:class:`windows.Spec`),
* ``items`` / ``lectures``  whether item statistics / lecture flags are needed,
* ``finish(ctx, frame, name, **params)``  its output columns ``{Name}_{column}``
  from those helper columns (plain expressions and joins, no windows).

The evaluator computes the union of all window needs once (skew-aware, see
``plans.evaluate``), so the per-feature jobs and the fused matrix job run
the same code and give the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histwise.functions.exprs import change_rate, flag, ratio, seq2vec
from histwise.functions.vectors import cosine, l2_norm
from histwise.operators.windows import Spec
from histwise.plans.context import FeatureContext, previous_spec
from histwise.plans.evaluate import LECTURE_FLAGS, SEEN

USER = ("user_id",)
USER_PART = ("user_id", "part")
USER_ITEM = ("user_id", "content_id")
HISTORY = ("cumlative_user_appearance", "cumlative_user_corrected_answers", "mean_user_accuracy")
N_SEQ = 10


def _no_specs(**_):
    return []


@dataclass(frozen=True)
class Feature:
    name: str
    columns: tuple[str, ...]
    finish: Callable[..., DataFrame]
    specs: Callable[..., list] = _no_specs
    params: dict = field(default_factory=dict)
    items: bool = False
    lectures: bool = False

    def out(self, col: str) -> str:
        return f"{self.name}_{col}"

    def window_specs(self) -> list[Spec]:
        return self.specs(**self.params)

    def apply(self, ctx: FeatureContext, frame: DataFrame) -> DataFrame:
        return self.finish(ctx, frame, self.name, **self.params)


REGISTRY: dict[str, Feature] = {}


def feature(name: str, columns, specs=_no_specs, items=False, lectures=False, **params):
    """Register ``finish(ctx, frame, name, **params)`` as feature ``name``."""
    def wrap(fn):
        REGISTRY[name] = Feature(name, tuple(columns), fn, specs, params, items, lectures)
        return fn
    return wrap


def variant(base: str, name: str, **params) -> Feature:
    """The same operator under another name with other parameters (e.g. width 5)."""
    f = REGISTRY[base]
    return Feature(name, f.columns, f.finish, f.specs, {**f.params, **params}, f.items, f.lectures)


def _history(frame, name, n, s):
    return frame.withColumns({
        f"{name}_cumlative_user_appearance": F.col(n),
        f"{name}_cumlative_user_corrected_answers": F.col(s),
        f"{name}_mean_user_accuracy": ratio(F.col(s), F.col(n))})


def _tag(by) -> str:
    return "u" if tuple(by) == USER else "up"


def _ac():
    return F.col("answered_correctly")


# --- F01-F04: row attributes --------------------------------------------------------------
@feature("Fold", ["val"])
def fold(ctx, frame, name):
    return frame.withColumn(f"{name}_val", F.col("val"))


@feature("Target", ["answered_correctly"])
def target(ctx, frame, name):
    return frame.withColumn(f"{name}_answered_correctly", _ac())


@feature("LabelEncoding", ["part", "prior_question_had_explanation"])
def label_encoding(ctx, frame, name):
    return frame.withColumns({
        f"{name}_part": F.col("part"),
        f"{name}_prior_question_had_explanation": flag(F.col("prior_question_had_explanation"))})


@feature("NumericFeatures", ["prior_question_elapsed_time"])
def numeric_features(ctx, frame, name):
    return frame.withColumn(f"{name}_prior_question_elapsed_time",
                            F.col("prior_question_elapsed_time"))


# --- F05, F09: running history --------------------------------------------------------------
def _running_specs(by):
    t = _tag(by)
    return [Spec(tuple(by), count_before=[f"_{t}_before"],
                 sums_before={f"_{t}_ac_before": _ac().cast("long")})]


@feature("UserCumulativeUserInteractions", HISTORY, specs=_running_specs, by=USER)
def user_cumulative(ctx, frame, name, by):
    t = _tag(by)
    return _history(frame, name, f"_{t}_before", f"_{t}_ac_before")


REGISTRY["UserCumulativeUserInteractionsByPart"] = Feature(
    "UserCumulativeUserInteractionsByPart", HISTORY, user_cumulative, _running_specs,
    {"by": USER_PART})


# --- F14: sliding history ---------------------------------------------------------------------
def _sliding_specs(by, width):
    t = _tag(by)
    return [Spec(tuple(by), slide_counts={f"_{t}_n_w{width}": width},
                 slides={f"_{t}_ac_w{width}": (_ac().cast("long"), width)})]


@feature("UserCumulativeUserInteractionsByPartWindowSize100", HISTORY, specs=_sliding_specs,
         by=USER_PART, width=100)
def user_sliding(ctx, frame, name, by, width):
    t = _tag(by)
    return _history(frame, name, f"_{t}_n_w{width}", f"_{t}_ac_w{width}")


# --- F15, F16: weighted sliding history --------------------------------------------------------
def _weighted_specs(by, width):
    t = _tag(by)
    w = F.col("_i_weight")
    names = f"_{t}_w_w{width}", f"_{t}_wac_w{width}"
    return [Spec(tuple(by), slides={names[0]: (w, width), names[1]: (_ac() * w, width)}, weighted=frozenset(names))]


@feature("UserCumulativeUserInteractionsWeightedWindowSize100", HISTORY, specs=_weighted_specs,
         items=True, by=USER, width=100)
def user_weighted(ctx, frame, name, by, width):
    t = _tag(by)
    return _history(frame, name, f"_{t}_w_w{width}", f"_{t}_wac_w{width}")


REGISTRY["UserCumulativeUserInteractionsByPartWeightedWindowSize100"] = Feature(
    "UserCumulativeUserInteractionsByPartWeightedWindowSize100", HISTORY, user_weighted,
    _weighted_specs, {"by": USER_PART, "width": 100}, items=True)


# --- F06-F08: item statistics -------------------------------------------------------------------
@feature("ContentAverageCorrectedAnswers", ["mean_content_accuracy"], items=True)
def content_accuracy(ctx, frame, name):
    return frame.withColumn(f"{name}_mean_content_accuracy", F.col("_i_mean_content_accuracy"))


@feature("ContentNumberOfAnswers", ["answers", "answered_users", "answers_per_user"], items=True)
def content_answers(ctx, frame, name):
    return frame.withColumns({f"{name}_{c}": F.col(f"_i_{c}")
                              for c in ("answers", "answered_users", "answers_per_user")})


AFTER_SECOND = ("answers_after_second_time", "answered_users_after_second_time",
                "answers_rate_after_second_time", "answered_user_rate_after_second_time",
                "answers_per_user_after_second_time")


@feature("ContentNumberOfAnswersAfterSecondTime", AFTER_SECOND, items=True)
def content_after_second(ctx, frame, name):
    return frame.withColumns({f"{name}_{c}": F.col(f"_i_{c}") for c in AFTER_SECOND})


# --- F10: previous problem ------------------------------------------------------------------------
def _last_solved_specs():
    return [previous_spec(("answered_correctly", "part")),
            Spec(USER, lags={"_prev_acc": ("_i_mean_content_accuracy", 1)})]


@feature("UserLastSolvedProblem", ["prior_answered_correctly", "prior_same_part",
                                   "prior_mean_content_accuracy", "change_rate_mean_content_accuracy"],
         specs=_last_solved_specs, items=True)
def user_last_solved(ctx, frame, name):
    acc = F.col("_i_mean_content_accuracy")
    return frame.withColumns({
        f"{name}_prior_answered_correctly": F.col("prev_answered_correctly"),
        f"{name}_prior_same_part": flag(F.col("part") == F.col("prev_part")),
        f"{name}_prior_mean_content_accuracy": F.col("_prev_acc"),
        f"{name}_change_rate_mean_content_accuracy": change_rate(F.col("_prev_acc"), acc)})


# --- F11: lectures seen so far (up to and including this timestamp) --------------------------------
@feature("UserLecturedAtLeastOnce", LECTURE_FLAGS, lectures=True)
def user_lectured(ctx, frame, name):
    return frame.withColumns({f"{name}_{n}": F.coalesce(F.col(s), F.lit(0))
                              for s, n in zip(SEEN, LECTURE_FLAGS)})


# --- F12: the same item in the past ------------------------------------------------------------------
def _past_specs():
    return [Spec(USER, count_before=["_u_before"]),
            Spec(USER_ITEM, count_incl=["_uc_n"], count_before=["_uc_before"],
                 sums_before={"_uc_ac_before": _ac().cast("long")},
                 lags={"_uc_prev_ts": ("timestamp", 1), "_uc_prev_u_before": ("_u_before", 1),
                       **{f"_uc_lag_{i}": ("answered_correctly", i) for i in range(1, N_SEQ + 1)}})]


@feature("UserAnsweredInThePast", ["number_of_answered_the_sampe_question", "mean_user_accuracy",
                                   "diff_timestamp", "diff_answers", "differential", "seq2vec"],
         specs=_past_specs)
def user_answered_in_past(ctx, frame, name):
    diff_ts = F.col("timestamp") - F.col("_uc_prev_ts")
    diff_ans = F.col("_u_before") - F.col("_uc_prev_u_before") - 1
    lags = [F.col(f"_uc_lag_{i}") for i in range(1, N_SEQ + 1)]
    return frame.withColumns({
        f"{name}_number_of_answered_the_sampe_question": F.col("_uc_n") - 1,
        f"{name}_mean_user_accuracy": ratio(F.col("_uc_ac_before"), F.col("_uc_before")),
        f"{name}_diff_timestamp": diff_ts,
        f"{name}_diff_answers": diff_ans,
        f"{name}_differential": F.when(diff_ans == 0, F.lit(-999.0)).otherwise(ratio(diff_ts, diff_ans)),
        f"{name}_seq2vec": seq2vec(lags)})


# --- F13: similarity to the previous item ----------------------------------------------------------
@feature("UserLastSolvedProblemSimilarity", ["similarity"],
         specs=lambda: [previous_spec(("content_id",))])
def user_similarity(ctx, frame, name):
    # a norm belongs to the item: taken once for each of them and not for each question row
    emb = ctx.inputs.embeddings_side().withColumn("norm", l2_norm(F.col("vec")))
    cur = emb.select(F.col("content_id").alias("_e_cid"), F.col("vec").alias("_vec_cur"), F.col("norm").alias("_norm_cur"))
    prev = emb.select(F.col("content_id").alias("_e_pid"), F.col("vec").alias("_vec_prev"), F.col("norm").alias("_norm_prev"))
    # first rows have no previous item: in a shuffle join they are dealt by row instead of all to one task
    there = F.col("prev_content_id").isNotNull()
    key = F.coalesce(F.col("prev_content_id"), F.xxhash64("row_id"))
    frame = (frame.join(cur, frame.content_id == cur._e_cid, "left").drop("_e_cid")
                  .join(prev, (key == prev._e_pid) & there, "left").drop("_e_pid"))
    norms = F.col("_norm_prev"), F.col("_norm_cur")
    return (frame.withColumn(f"{name}_similarity", cosine(F.col("_vec_prev"), F.col("_vec_cur"), norms=norms))
                 .drop("_vec_cur", "_vec_prev", "_norm_cur", "_norm_prev"))


# --- F17: conditional accuracy given the previous answer --------------------------------------------
@feature("ContentAverageCorrectedAnswersPosterior", ["mean_content_accuracy", "size"],
         specs=lambda min_support: [previous_spec(("content_id", "answered_correctly"))],
         min_support=100)
def content_posterior(ctx, frame, name, min_support):
    agg = ctx.posterior(min_support).select(
        F.col("prev_answered_correctly").alias("_p_ac"), F.col("prev_content_id").alias("_p_cid"),
        F.col("content_id").alias("_p_item"),
        F.col("mean_content_accuracy").alias(f"{name}_mean_content_accuracy"),
        F.col("size").alias(f"{name}_size"))
    cond = ((frame.content_id == agg._p_item) & (F.col("prev_content_id") == agg._p_cid)
            & (F.col("prev_answered_correctly") == agg._p_ac))
    return frame.join(agg, cond, "left").drop("_p_ac", "_p_cid", "_p_item")


MATRIX_FEATURES = (
    "LabelEncoding", "NumericFeatures", "UserCumulativeUserInteractions",
    "ContentAverageCorrectedAnswers", "ContentNumberOfAnswers",
    "ContentNumberOfAnswersAfterSecondTime", "UserCumulativeUserInteractionsByPart",
    "UserLastSolvedProblem", "UserLecturedAtLeastOnce", "UserAnsweredInThePast",
    "UserLastSolvedProblemSimilarity", "UserCumulativeUserInteractionsByPartWindowSize100",
    "UserCumulativeUserInteractionsByPartWeightedWindowSize100",
    "UserCumulativeUserInteractionsWeightedWindowSize100",
    "ContentAverageCorrectedAnswersPosterior",
)


def build_features(ctx: FeatureContext, feats: list[Feature]) -> DataFrame:
    """Question rows + the columns of ``feats``: item join, one window pass, finishing."""
    frame = ctx.base()
    if any(f.items for f in feats):
        frame = ctx.with_items(frame)
    specs = [s for f in feats for s in f.window_specs()]
    lectures = any(f.lectures for f in feats)
    if specs or lectures:
        frame = ctx.windows(frame, specs, lectures)
    for f in feats:
        frame = f.apply(ctx, frame)
    return frame


def feature_frame(ctx: FeatureContext, feat: Feature | str) -> DataFrame:
    """One feature as ``row_id`` + its columns without prefix (M1)."""
    f = REGISTRY[feat] if isinstance(feat, str) else feat
    frame = build_features(ctx, [f])
    return frame.select("row_id", *[F.col(f.out(c)).alias(c) for c in f.columns])
