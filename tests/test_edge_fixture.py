"""FIXTURES.md §4 edge cases, on the plain path and on the blocked (hot-user) path."""

import math

import pytest

from fixture_log import SEQ12, inputs
from histwise.functions.exprs import SEQ2VEC_WEIGHTS
from histwise.operators.skew import SkewPolicy
from histwise.plans.context import FeatureContext
from histwise.plans.matrix import feature_matrix
from histwise.sources.inputs import DuplicateKeyError

POLICIES = {"plain": None, "blocked": SkewPolicy(max_rows_per_key=2, block_rows=3)}


@pytest.fixture(scope="module", params=list(POLICIES))
def matrix(request, spark):
    ctx = FeatureContext(inputs(spark), policy=POLICIES[request.param])
    if request.param == "blocked":
        assert ctx.hot() is not None and ctx.hot().n_blocks > 1
    return {r["row_id"]: r.asDict() for r in feature_matrix(ctx).collect()}


def col(m, rid, name):
    return m[rid][name]


U = "UserCumulativeUserInteractions_"
P = "UserAnsweredInThePast_"
L = "UserLastSolvedProblem_"
LEC = "UserLecturedAtLeastOnce_"
WU = "UserCumulativeUserInteractionsWeightedWindowSize100_"
SIM = "UserLastSolvedProblemSimilarity_similarity"
WIN = "UserCumulativeUserInteractionsByPartWindowSize100_"


def test_row_count(matrix):
    assert len(matrix) == 6 + 2 + 2 + 3 + 12 + 5 + 102


def test_first_row_of_user(matrix):
    assert col(matrix, 1, U + "cumlative_user_appearance") is None
    assert col(matrix, 1, U + "cumlative_user_corrected_answers") is None
    assert col(matrix, 1, U + "mean_user_accuracy") is None
    assert col(matrix, 1, L + "prior_same_part") == 0
    assert col(matrix, 1, P + "number_of_answered_the_sampe_question") == 0
    assert col(matrix, 1, P + "seq2vec") == 0.0


def test_ties_ordered_by_row_id(matrix):
    assert [col(matrix, r, U + "cumlative_user_appearance") for r in (2, 3, 4)] == [1, 2, 3]
    assert [col(matrix, r, U + "cumlative_user_corrected_answers") for r in (2, 3, 4)] == [1, 1, 2]


def test_lecture_peer_counts(matrix):
    assert col(matrix, 20, LEC + "is_lecture") == 0
    assert col(matrix, 21, LEC + "is_lecture") == 1
    assert col(matrix, 21, LEC + "is_lecture_part_3") == 1
    assert col(matrix, 21, LEC + "is_lecture_part_1") == 0
    assert col(matrix, 21, LEC + "is_lecture_type_of_intention") == 1
    assert col(matrix, 21, LEC + "is_lecture_type_of_concept") == 0


def test_all_right_item_weight_zero(matrix):
    assert col(matrix, 31, WU + "cumlative_user_appearance") == 0.0
    assert col(matrix, 31, WU + "cumlative_user_corrected_answers") == 0.0
    assert col(matrix, 31, WU + "mean_user_accuracy") is None


def test_all_wrong_item_and_val_only_item(matrix):
    assert col(matrix, 40, L + "change_rate_mean_content_accuracy") == -999.0
    assert col(matrix, 42, L + "prior_mean_content_accuracy") is None
    assert col(matrix, 41, "ContentAverageCorrectedAnswers_mean_content_accuracy") is None
    # weight 999 for item 60, NULL for item 70 (ignored by SUM)
    assert col(matrix, 42, WU + "cumlative_user_appearance") == pytest.approx(999.0)
    assert col(matrix, 42, WU + "cumlative_user_corrected_answers") == 0.0


def test_repeats(matrix):
    assert col(matrix, 4, P + "number_of_answered_the_sampe_question") == 1
    assert col(matrix, 4, P + "diff_answers") == 1
    assert col(matrix, 5, P + "diff_answers") == 0
    assert col(matrix, 5, P + "differential") == -999.0
    assert col(matrix, 5, P + "diff_timestamp") == 1000
    assert col(matrix, 6, P + "diff_timestamp") == 3000
    assert col(matrix, 6, P + "diff_answers") is None
    assert col(matrix, 6, P + "differential") is None
    assert col(matrix, 5, P + "seq2vec") == 1.0


def test_seq2vec_last_ten(matrix):
    last = SEQ12[:11][::-1][:10]                       # most recent first, 10 of them
    expected = 0.0
    for w, v in zip(SEQ2VEC_WEIGHTS, last):
        expected = expected + w * v
    assert col(matrix, 61, P + "seq2vec") == pytest.approx(expected, abs=1e-15)
    assert col(matrix, 61, P + "number_of_answered_the_sampe_question") == 11
    assert col(matrix, 61, P + "mean_user_accuracy") == pytest.approx(sum(SEQ12[:11]) / 11)


def test_similarity(matrix):
    assert col(matrix, 70, SIM) is None
    assert col(matrix, 71, SIM) == pytest.approx(1 / math.sqrt(2))
    assert col(matrix, 72, SIM) == -999.0
    # zero previous vector wins over a missing current one (NULL = 0 OR TRUE is TRUE)
    assert col(matrix, 73, SIM) == -999.0
    assert col(matrix, 74, SIM) is None


def test_long_history_frame(matrix):
    assert col(matrix, 1100, WIN + "cumlative_user_appearance") == 100
    assert col(matrix, 1100, WIN + "cumlative_user_corrected_answers") == 1
    assert col(matrix, 1101, WIN + "cumlative_user_appearance") == 100
    assert col(matrix, 1101, WIN + "cumlative_user_corrected_answers") == 0
    assert col(matrix, 1101, U + "cumlative_user_appearance") == 101


def test_duplicate_side_key_fails(spark):
    from fixture_log import QUESTIONS
    ctx = FeatureContext(inputs(spark, QUESTIONS + [(10, 7)]), policy=None)
    with pytest.raises(DuplicateKeyError):
        ctx.base()
