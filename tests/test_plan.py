"""Plan shape of the fused job: one exchange on the question rows for all user windows."""

from paths import SF001
from histwise.plans.context import FeatureContext
from histwise.plans.matrix import feature_matrix
from histwise.sources.testdata import load_inputs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_side_has_one_user_exchange(spark):
    ctx = FeatureContext(load_inputs(spark, SF001))
    plan = _plan(feature_matrix(ctx))
    user_exchanges = [l for l in plan.splitlines()
                      if "Exchange hashpartitioning(user_id" in l and "timestamp" not in l]
    assert len(user_exchanges) == 1, plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns(spark):
    from histwise.plans.features import feature_frame
    ctx = FeatureContext(load_inputs(spark, SF001))
    df = feature_frame(ctx, "Fold")
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    schemas = [l for l in text.splitlines() if l.startswith("ReadSchema") and "event_id" in l]
    assert schemas and all("ts:" not in l and "value:" not in l for l in schemas), schemas


def test_one_sort_per_key_family(spark):
    """Lecture flags share the user family's (timestamp, row_id) sort: three sorts for
    the three key families (user; user, part; user, item), none extra."""
    ctx = FeatureContext(load_inputs(spark, SF001))
    plan = _plan(feature_matrix(ctx))
    sorts = [l for l in plan.splitlines() if l.strip(" :+-").startswith("Sort [")]
    assert len(sorts) == 3, plan


def test_blocked_path_equals_plain_on_full_matrix(spark):
    """Hot users split into blocks give exactly the plain matrix (floating sliding sums
    included: both paths sum the same exact decimals)."""
    from histwise.operators.skew import SkewPolicy
    inputs = load_inputs(spark, SF001)
    plain = feature_matrix(FeatureContext(inputs, policy=None))
    hot_ctx = FeatureContext(inputs, policy=SkewPolicy(max_rows_per_key=5, block_rows=40))
    assert hot_ctx.hot() is not None and hot_ctx.hot().n_blocks > 1
    blocked = feature_matrix(hot_ctx)
    # hot rows are frozen between key families: the plan stays small (it grew
    # exponentially with the number of families before)
    exchanges = [l for l in _plan(blocked).splitlines() if "Exchange " in l]
    assert len(exchanges) < 40, len(exchanges)
    assert plain.count() == blocked.count()
    assert plain.exceptAll(blocked).count() == 0 and blocked.exceptAll(plain).count() == 0


def test_json_is_parsed_once_for_each_row(spark):
    from pyspark.sql import functions as F
    from histwise.sources.testdata import bind_train
    events = spark.range(200).select(
        F.col("id").alias("event_id"), F.lit("2024-01-01 05:06:07.8").cast("timestamp_ntz").alias("ts"), (F.col("id") % 7).alias("user_id"),
        F.when(F.col("id") % 9 == 0, "signup").when(F.col("id") % 11 > 0, "view").alias("event_type"), (F.col("id") * 1.0).alias("value"),
        F.when(F.col("id") % 5 > 0, F.format_string('{"k": %d}', F.col("id") % 13)).alias("props"))
    log = bind_train(events)
    assert _plan(log).count("get_json_object") == 1, _plan(log)
    for r in log.collect():
        i = r["row_id"]
        k = i % 13 if i % 5 else None
        assert r["content_id"] == k
        assert r["answered_correctly"] == (-1 if i % 9 == 0 else int(k is not None and i > 3 * k))


def test_a_norm_is_taken_for_an_item_and_not_for_a_row(spark):
    from histwise.plans.features import feature_frame
    plan = _plan(feature_frame(FeatureContext(load_inputs(spark, SF001)), "UserLastSolvedProblemSimilarity"))
    above = plan[:plan.index("Join")]
    assert "zip_with" in above.lower() and "SQRT" not in above.upper(), above
