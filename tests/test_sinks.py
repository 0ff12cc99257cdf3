import json
import tempfile

from histwise.sources import sinks


def test_feature_round_trip(spark):
    root = tempfile.mkdtemp(prefix="hw-sink-")
    df = spark.createDataFrame([(1, 0.5), (2, None)], "row_id long, F_x double")
    p = sinks.write_feature(df, root, "F", debug=True)
    assert p.endswith("features_debug/F_training")
    back = sinks.read_feature(spark, root, "F", debug=True)
    assert sorted(back.collect()) == sorted(df.collect())
    assert len(sinks.load_features(spark, root, ["F"], debug=True)) == 1


def test_run_record_and_importances(spark):
    out = tempfile.mkdtemp(prefix="hw-run-")
    rec = {"evals_result": {"oof_score": {"auc": 0.75}, "n_data": 10}, "features": ["a", "b"]}
    sinks.write_run_record(spark, rec, out)
    assert sinks.read_run_record(spark, out) == json.loads(json.dumps(rec))
    imp = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "feature string, value double")
    path = sinks.write_importances(imp, out)
    rows = spark.read.option("header", True).csv(path).collect()
    assert [r["feature"] for r in rows] == ["b", "a"]


def test_blob_source(spark):
    d = tempfile.mkdtemp(prefix="hw-blob-")
    with open(f"{d}/x.bin", "wb") as f:
        f.write(b"abc")
    r = sinks.read_blobs(spark, d).first()
    assert bytes(r["content"]) == b"abc"
