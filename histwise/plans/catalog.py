"""Registered queries (one per operator of SURVEY §2) and their SQL oracles.

Every query reads the bound test tables of ``sf_dir`` in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histwise.plans import oracle
from histwise.plans.context import FeatureContext
from histwise.plans.features import REGISTRY, build_features, feature_frame, variant
from histwise.session import work_path
from histwise.sources import tables
from histwise.sources.testdata import load_inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, Callable[[], str]] = {}

_CTX: dict = {}


def context(spark: SparkSession, sf_dir: str) -> FeatureContext:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CTX:
        _CTX[key] = FeatureContext(load_inputs(spark, sf_dir))
    return _CTX[key]


def _rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    """Round float sums whose order of addition differs between engines (comparison only)."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def register(key: str, sql: Callable[[], str] | None = None):
    def wrap(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return wrap


def _feature_query(key, feat, sql, rounded=()):
    def run(spark, sf_dir):
        df = feature_frame(context(spark, sf_dir), feat)
        return _rounded(df, rounded) if rounded else df
    register(key, sql)(run)


HIST = ("cumlative_user_appearance", "cumlative_user_corrected_answers", "mean_user_accuracy")

_feature_query("fold", "Fold", oracle.fold)
_feature_query("target", "Target", oracle.target)
_feature_query("label_encoding", "LabelEncoding", oracle.label_encoding)
_feature_query("numeric_features", "NumericFeatures", oracle.numeric_features)
_feature_query("user_cumulative", "UserCumulativeUserInteractions", oracle.user_cumulative)
_feature_query("user_cumulative_by_part", "UserCumulativeUserInteractionsByPart",
               oracle.user_cumulative_by_part)
_feature_query("user_by_part_window_100", "UserCumulativeUserInteractionsByPartWindowSize100",
               lambda: oracle.user_by_part_window(100))
_feature_query("user_by_part_window_5",
               variant("UserCumulativeUserInteractionsByPartWindowSize100",
                       "UserCumulativeUserInteractionsByPartWindowSize5", width=5),
               lambda: oracle.user_by_part_window(5))
_feature_query("user_weighted_window_100", "UserCumulativeUserInteractionsWeightedWindowSize100",
               lambda: oracle.user_weighted_window(100, False), HIST)
_feature_query("user_weighted_window_5",
               variant("UserCumulativeUserInteractionsWeightedWindowSize100",
                       "UserCumulativeUserInteractionsWeightedWindowSize5", width=5),
               lambda: oracle.user_weighted_window(5, False), HIST)
_feature_query("user_by_part_weighted_window_100",
               "UserCumulativeUserInteractionsByPartWeightedWindowSize100",
               lambda: oracle.user_weighted_window(100, True), HIST)
_feature_query("user_by_part_weighted_window_5",
               variant("UserCumulativeUserInteractionsByPartWeightedWindowSize100",
                       "UserCumulativeUserInteractionsByPartWeightedWindowSize5", width=5),
               lambda: oracle.user_weighted_window(5, True), HIST)
_feature_query("content_first_attempt_accuracy", "ContentAverageCorrectedAnswers",
               oracle.content_first_attempt_accuracy)
_feature_query("content_number_of_answers", "ContentNumberOfAnswers",
               oracle.content_number_of_answers)
_feature_query("content_number_after_second", "ContentNumberOfAnswersAfterSecondTime",
               oracle.content_number_after_second)
_feature_query("user_last_solved", "UserLastSolvedProblem", oracle.user_last_solved)
_feature_query("user_lectured_at_least_once", "UserLecturedAtLeastOnce",
               oracle.user_lectured_at_least_once)
_feature_query("user_answered_in_past", "UserAnsweredInThePast", oracle.user_answered_in_past)
_feature_query("similarity", "UserLastSolvedProblemSimilarity", oracle.similarity,
               ("similarity",))
_feature_query("content_posterior_100", "ContentAverageCorrectedAnswersPosterior",
               lambda: oracle.content_posterior(100))
_feature_query("content_posterior_2",
               variant("ContentAverageCorrectedAnswersPosterior",
                       "ContentAverageCorrectedAnswersPosteriorSupport2", min_support=2),
               lambda: oracle.content_posterior(2))


def feature_matrix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histwise.plans.matrix import feature_matrix
    return feature_matrix(context(spark, sf_dir))


# --- composite queries ----------------------------------------------------------------
from histwise.operators import drift, matrix as M, metrics  # noqa: E402
from histwise.operators import windows as W  # noqa: E402
from histwise.operators.model import mean_importances, predict_mean, top_k  # noqa: E402
from histwise.plans import jobs, training  # noqa: E402
from histwise.plans.matrix import FOLD, LABEL, feature_matrix, matrix_columns  # noqa: E402

WEIGHTED = ("UserCumulativeUserInteractionsByPartWeightedWindowSize100",
            "UserCumulativeUserInteractionsWeightedWindowSize100")
ROUNDED = ([f"{n}_{c}" for n in WEIGHTED for c in HIST]
           + ["UserLastSolvedProblemSimilarity_similarity"])
ALL_PARTS = [name for name, _ in oracle.MATRIX_PARTS]


def matrix_cols() -> list[str]:
    return matrix_columns(ALL_PARTS)


def comparable_matrix(spark, sf_dir) -> DataFrame:
    """The fused matrix with order-sensitive float sums rounded to 6 digits."""
    return _rounded(feature_matrix(context(spark, sf_dir)), ROUNDED)


def _oracle_matrix() -> str:
    return oracle.feature_matrix({n: list(REGISTRY[n].columns) for n in ALL_PARTS})


register("feature_matrix", _oracle_matrix)(comparable_matrix)


@register("debug_sample", lambda: oracle.debug_sample(5_000))
def q_debug_sample(spark, sf_dir):
    return M.debug_sample(feature_frame(context(spark, sf_dir), "UserCumulativeUserInteractions"), 5_000)


@register("null_report", lambda: oracle.null_report(_oracle_matrix(), matrix_cols()))
def q_null_report(spark, sf_dir):
    return M.null_report(comparable_matrix(spark, sf_dir), matrix_cols())


@register("column_ranges", lambda: oracle.column_ranges(_oracle_matrix(), matrix_cols()))
def q_column_ranges(spark, sf_dir):
    return M.column_ranges(comparable_matrix(spark, sf_dir), matrix_cols())


@register("fold_balance", oracle.fold_balance)
def q_fold_balance(spark, sf_dir):
    base = context(spark, sf_dir).base()
    return training.fold_balance(base, "val", "answered_correctly")


@register("odds_weight", oracle.odds_weight)
def q_odds_weight(spark, sf_dir):
    it = context(spark, sf_dir).items()
    return it.where(F.col("mean_content_accuracy").isNotNull()).select(
        "content_id", "mean_content_accuracy", "weight")


@register("attempt_number", oracle.attempt_number)
def q_attempt_number(spark, sf_dir):
    ctx = context(spark, sf_dir)
    spec = W.Spec(("user_id", "content_id"), count_incl=["_attempt"])
    return ctx.windows(ctx.base(), [spec]).select("row_id", F.col("_attempt").alias("attempt_no"))


def _two_scores(spark, sf_dir):
    """Item accuracy and running user accuracy as two deterministic per-row scores."""
    ctx = context(spark, sf_dir)
    f = REGISTRY["UserCumulativeUserInteractions"]
    frame = build_features(ctx, [REGISTRY["ContentAverageCorrectedAnswers"], f])
    a = frame.select("row_id", F.col("answered_correctly").alias("label"), "val",
                     F.col("_i_mean_content_accuracy").alias("score"))
    b = frame.select("row_id", F.col("answered_correctly").alias("label"), "val",
                     F.col(f.out("mean_user_accuracy")).alias("score"))
    return a, b


@register("prediction_mean", oracle.prediction_mean)
def q_prediction_mean(spark, sf_dir):
    a, b = _two_scores(spark, sf_dir)
    return predict_mean([a.select("row_id", "score"), b.select("row_id", "score")])


@register("auc_exact", oracle.auc_exact)
def q_auc_exact(spark, sf_dir):
    a, _ = _two_scores(spark, sf_dir)
    return metrics.auc(a.where(F.col("val") == 1))


@register("train_test_union", oracle.train_test_union)
def q_train_test_union(spark, sf_dir):
    ctx = context(spark, sf_dir)
    f = REGISTRY["UserCumulativeUserInteractions"]
    h = build_features(ctx, [f]).select(
        "row_id", "val", "prior_question_elapsed_time",
        F.col(f.out("cumlative_user_appearance")).alias("cumlative_user_appearance"),
        F.col(f.out("mean_user_accuracy")).alias("mean_user_accuracy"))
    trn = h.where(F.col("val") == 0).select("row_id", "cumlative_user_appearance", "mean_user_accuracy")
    tst = h.where(F.col("val") == 1).select("row_id", "cumlative_user_appearance",
                                            "prior_question_elapsed_time")
    return drift.label_union(trn, tst)


@register("top_k", lambda: oracle.top_k(_oracle_matrix(), matrix_cols()))
def q_top_k(spark, sf_dir):
    m = comparable_matrix(spark, sf_dir)
    cols = matrix_cols()
    per_fold = m.groupBy(F.col(FOLD).alias("fold")).agg(
        *[F.count(F.col(c)).cast("double").alias(c) for c in cols])
    long_ = per_fold.unpivot("fold", cols, "feature", "value")
    mean = mean_importances([long_.where(F.col("fold") == i).select("feature", "value") for i in (0, 1)])
    return top_k(mean, 30)


# --- model queries (no SQL oracle: MLlib training) -----------------------------------
_RUNS: dict = {}


def _run(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        ctx = context(spark, sf_dir)
        _RUNS[key] = training.run(ctx, training.RunConfig())
    return _RUNS[key]


@register("gbt_predictions")
def q_gbt_predictions(spark, sf_dir):
    res, _ = _run(spark, sf_dir)
    return res.oof


@register("gbt_importances")
def q_gbt_importances(spark, sf_dir):
    res, _ = _run(spark, sf_dir)
    return res.importances


@register("drift_check")
def q_drift_check(spark, sf_dir):
    import json
    # both sets come from one matrix: written once, it is not computed for each of them
    ctx, path = context(spark, sf_dir), f"{work_path(spark, 'drift')}/matrix"
    tables.publish(feature_matrix(ctx), path, expected=ctx.keys())
    m = tables.read(spark, path, narrow=False)
    feats = matrix_cols()[2:]
    trn, tst = m.where(F.col(FOLD) == 0), m.where(F.col(FOLD) == 1)
    r = drift.adversarial_validation(trn, tst, feats)
    return spark.createDataFrame(
        [(r["train_auc"], r["val_auc"], json.dumps(r["feature_importances"]))],
        "train_auc double, val_auc double, feature_importances string")


@register("narrow_types")
def q_narrow_types(spark, sf_dir):
    """The matrix with narrow types: written once, its ranges taken in that pass, the types applied at read."""
    ctx, path = context(spark, sf_dir), f"{work_path(spark, 'narrow')}/matrix"
    tables.publish(feature_matrix(ctx), path, expected=ctx.keys())
    return tables.read(spark, path)


@register("narrow_columns", lambda: oracle.narrow_columns(_oracle_matrix(), matrix_cols()))
def q_narrow_columns(spark, sf_dir):
    """Column, its narrow type, and its type where fractions may go to 4 bytes."""
    ctx, path = context(spark, sf_dir), f"{work_path(spark, 'narrow')}/matrix"
    m = feature_matrix(ctx)
    about = tables.publish(m, path, expected=ctx.keys())
    plain, short = about.types(), about.types(to_float32=True)
    rows = [(c, plain.get(c, t), short.get(c, t)) for c, t in m.dtypes if c in matrix_cols()]
    return spark.createDataFrame(rows, "column_name string, narrow_type string, narrow_type_float32 string")


@register("assembled_matrix", _oracle_matrix)
def q_assembled_matrix(spark, sf_dir):
    """Every feature by its own job, published, and the stored tables joined side by side."""
    ctx, root = context(spark, sf_dir), work_path(spark, "features")
    for name in ALL_PARTS:
        jobs.build_feature(ctx, name, root)
    return _rounded(jobs.load_matrix(spark, root, ALL_PARTS, narrow=False), ROUNDED)
