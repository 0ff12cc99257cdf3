"""Keyed tables: checks before publishing, narrow types at read, joins without an exchange."""

import tempfile

import pytest
from pyspark.sql import functions as F

from histwise.sources import tables


def rows(spark, n=1000, first=0, **columns):
    return spark.range(first, first + n).select(F.col("id").alias("row_id"), *[c.alias(k) for k, c in columns.items()])


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="hw-tables-")


def test_round_trip_with_description(spark, root):
    df = rows(spark, a=F.when(F.col("id") % 4 > 0, F.col("id") % 128), b=F.col("id") * 1.5, c=F.lit("x"), d=F.col("id") % 2 == 0, e=F.lit(None).cast("long"))
    got = tables.publish(df, f"{root}/t", expected=tables.keys_of(df), sums=["a"])
    assert (got.rows, got.nulls["a"], got.nulls["e"], got.ranges["a"], got.ranges["e"]) == (1000, 250, 1000, (1, 127), (None, None))
    assert got.sums["a"] == df.agg(F.sum("a")).first()[0]
    assert tables.info(spark, f"{root}/t") == got
    back = tables.read(spark, f"{root}/t")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    # a largest value of exactly 127 needs the next type; all NULL and doubles stay
    assert [t for _, t in back.dtypes] == ["bigint", "smallint", "double", "string", "boolean", "bigint"]
    assert dict(tables.read(spark, f"{root}/t", to_float32=True).dtypes)["b"] == "float"
    assert tables.read(spark, f"{root}/t", narrow=False).schema.simpleString() == df.schema.simpleString()


@pytest.mark.parametrize("fault", ["twice", "lost", "other", "null", "fails"])
def test_a_faulty_table_leaves_the_old_one(spark, root, fault):
    good = rows(spark, x=F.lit(1))
    expected = tables.keys_of(good)
    tables.publish(good, f"{root}/t", expected=expected)
    bad = {
        "twice": good.where("row_id <> 7").unionByName(good.where("row_id = 8")),
        "lost": good.where("row_id <> 7"),
        "other": good.withColumn("row_id", F.when(F.col("row_id") == 7, 5000).otherwise(F.col("row_id"))),
        "null": good.withColumn("row_id", F.when(F.col("row_id") != 7, F.col("row_id"))),
        "fails": good.withColumn("x", F.when(F.col("row_id") == 7, F.raise_error(F.lit("stop")).cast("int")).otherwise(2)),
    }[fault].withColumn("x", F.col("x") + 1)
    with pytest.raises(Exception) as e:
        tables.publish(bad, f"{root}/t", expected=expected)
    assert fault == "fails" or isinstance(e.value, tables.TableCheckError)
    assert tables.read(spark, f"{root}/t").agg(F.count("*"), F.min("x"), F.max("x")).first()[:] == (1000, 1, 1)
    assert spark.sql("SHOW TABLES").where("tableName like 'keyed%'").count() == 0
    import os
    assert os.listdir(root) == ["t"]
    tables.publish(good.withColumn("x", F.lit(2)), f"{root}/t", expected=expected)
    assert tables.read(spark, f"{root}/t").agg(F.min("x")).first()[0] == 2


def test_a_copied_row_is_found_without_expectations(spark, root):
    with pytest.raises(tables.TableCheckError, match="3 times"):
        tables.publish(rows(spark, 10).union(rows(spark, 1)).union(rows(spark, 1)), f"{root}/t")


def test_merge_joins_need_no_exchange(spark, root):
    paths = []
    for i in range(5):
        paths.append(f"{root}/t{i}")
        tables.publish(rows(spark, 3000, **{f"x{i}": F.col("id") * i}).orderBy(F.rand(i)), paths[-1], buckets=6)
    m = tables.assemble(spark, paths)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 4 and "Exchange" not in plan, plan
    assert m.agg(F.count("*"), *[F.sum(f"x{i}") for i in range(5)]).first()[:] == (3000, *[i * 3000 * 2999 // 2 for i in range(5)])


def test_assembly_of_other_keys_is_refused(spark, root):
    tables.publish(rows(spark, 100, x=F.lit(1)), f"{root}/a")
    for name, other in (("fewer", rows(spark, 99, y=F.lit(1))), ("moved", rows(spark, 100, 1, y=F.lit(1)))):
        tables.publish(other, f"{root}/{name}")
        with pytest.raises(tables.TableCheckError, match="other keys"):
            tables.assemble(spark, [f"{root}/a", f"{root}/{name}"])


def test_empty_table(spark, root):
    df = rows(spark, 0, x=F.lit(1))
    assert tables.publish(df, f"{root}/t", expected=tables.keys_of(df)).rows == 0
    assert tables.read(spark, f"{root}/t").count() == 0


def test_a_task_gets_no_more_of_a_larger_table():
    for rows in (480_000, 4_800_000, 28_800_000):
        assert -(-rows // tables.buckets_for(rows)) <= 250_000
    assert tables.buckets_for(0) == 1 and tables.buckets_for(10**12) == 100_000  # Spark's limit


def test_rows_for_training_come_in_bounded_parts(spark, root, monkeypatch):
    """A plain scan packs the buckets' files into few tasks."""
    from histwise.plans import training
    monkeypatch.setattr(tables, "BUCKET_ROWS", 100)
    df = rows(spark, 2000, y=F.col("id") % 2, fold=F.col("id") % 10, x=F.col("id") * 1.5)
    data, about = training.stored_matrix(df, ["x"], "y", ["fold"], f"{root}/t", tables.keys_of(df))
    parts = data.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count("*").alias("n")).collect()
    assert about.buckets == 20 and len(parts) == 20 and sum(r["n"] for r in parts) == 2000
    assert sorted(map(str, data.collect())) == sorted(map(str, df.select(data.columns).collect()))


def test_small_tables_stay_in_one_part_and_in_order(spark):
    got = tables.in_parts(rows(spark, 500).orderBy(F.rand(1)), 500, "row_id")
    assert got.rdd.getNumPartitions() == 1 and [r[0] for r in got.collect()] == list(range(500))


def test_many_stored_parts_are_read_without_an_exchange(spark, root, monkeypatch):
    """A table of many parts for each core is read as it is stored, not dealt out and sorted once more."""
    from histwise.plans import training
    df = rows(spark, 2000, y=F.col("id") % 2, fold=F.col("id") % 10, x=F.col("id") * 1.5)
    monkeypatch.setattr(tables, "BUCKET_ROWS", 25)
    data, about = training.stored_matrix(df, ["x"], "y", ["fold"], f"{root}/t", tables.keys_of(df))
    plan = data._jdf.queryExecution().executedPlan().toString()
    assert about.buckets == 80 and "Exchange" not in plan and "Sort" not in plan, plan
    assert data.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted(map(str, data.collect())) == sorted(map(str, df.select(data.columns).collect()))
