"""Random logs: running and sliding history equal a naive per-user loop, on both paths,
and the result does not depend on how the input rows are ordered or partitioned."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixture_log import TRAIN_SCHEMA
from histwise.operators.skew import SkewPolicy
from histwise.plans.context import FeatureContext
from histwise.plans.features import feature_frame, variant
from histwise.sources.inputs import Inputs

PARTS = {0: 1, 1: 1, 2: 2, 3: 3}        # item 4 has no part (NULL group)

event = st.tuples(st.integers(0, 3), st.integers(0, 6), st.integers(0, 4), st.integers(0, 1))
logs = st.lists(event, min_size=1, max_size=60)


def make_inputs(spark, log, shuffle_seed=None):
    rows = [(i, u, ts * 1000, item, 0, ac, None, None) for i, (u, ts, item, ac) in enumerate(log)]
    if shuffle_seed is not None:
        import random
        random.Random(shuffle_seed).shuffle(rows)
    train = spark.createDataFrame(rows, TRAIN_SCHEMA)
    if shuffle_seed is not None:
        train = train.repartition(5)
    return Inputs(
        train=train,
        questions=spark.createDataFrame(list(PARTS.items()), "question_id long, part int"),
        lectures=spark.createDataFrame([], "lecture_id long, part int, type_of string"),
        val_row_id=spark.createDataFrame([], "row_id long"),
        embeddings=spark.createDataFrame([], "content_id long, vec array<double>"),
        check_keys=False)


def naive(log, by_part, width=None):
    groups = defaultdict(list)
    for i, (u, ts, item, ac) in enumerate(log):
        groups[(u, PARTS.get(item)) if by_part else u].append((ts, i, ac))
    out = {}
    for rows in groups.values():
        rows.sort()
        for k, (_, rid, _) in enumerate(rows):
            prev = rows[max(0, k - width):k] if width else rows[:k]
            n = len(prev) or None
            s = sum(r[2] for r in prev) if prev else None
            out[rid] = (n, s)
    return out


def spark_result(spark, log, feat, policy, shuffle_seed=None):
    ctx = FeatureContext(make_inputs(spark, log, shuffle_seed), policy=policy, materialise=False)
    return {r["row_id"]: (r["cumlative_user_appearance"], r["cumlative_user_corrected_answers"])
            for r in feature_frame(ctx, feat).collect()}


SLOW = settings(max_examples=4, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@SLOW
@given(log=logs)
def test_running_by_user_and_part(spark, log):
    assert spark_result(spark, log, "UserCumulativeUserInteractions", None) == naive(log, False)
    assert spark_result(spark, log, "UserCumulativeUserInteractionsByPart", None) == naive(log, True)


@SLOW
@given(log=logs, width=st.integers(1, 4))
def test_sliding_blocked_equals_naive(spark, log, width):
    f = variant("UserCumulativeUserInteractionsByPartWindowSize100", "W", width=width)
    policy = SkewPolicy(max_rows_per_key=3, block_rows=4)
    assert spark_result(spark, log, f, policy) == naive(log, True, width)
    assert spark_result(spark, log, f, None, shuffle_seed=1) == naive(log, True, width)
