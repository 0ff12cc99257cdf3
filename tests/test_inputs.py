"""Side tables: measured size decides broadcast, duplicate keys fail early."""

import pytest
from pyspark.sql import functions as F

from histwise.sources.inputs import (DuplicateKeyError, bounded_broadcast, checked_side,
                                     row_bytes)


def _is_broadcast(df):
    return "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()


def test_row_bytes_counts_strings_and_arrays(spark):
    df = spark.createDataFrame([(1, "abcd", [1.0, 2.0, 3.0]), (2, None, None)],
                               "k long, s string, v array<double>")
    got = [r["b"] for r in df.select(row_bytes(df.schema).alias("b")).orderBy("k").collect()]
    assert got == [8 + (4 + 8) + (3 * 8 + 16), 8 + 8 + 16]


def test_broadcast_only_under_both_bounds(spark):
    df = spark.range(100).withColumn("s", F.lit("x" * 100))
    assert _is_broadcast(bounded_broadcast(df))
    assert not _is_broadcast(bounded_broadcast(df, max_rows=99))
    assert not _is_broadcast(bounded_broadcast(df, max_bytes=100 * 100))
    assert _is_broadcast(checked_side(df, "id", "t"))
    assert not _is_broadcast(checked_side(df, "id", "t", max_bytes=1000))


def test_duplicate_side_key_fails(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "k long, v int")
    with pytest.raises(DuplicateKeyError):
        checked_side(df, "k", "dup")


def test_sizing_scales_with_input():
    from histwise.session import TARGET_PARTITION_BYTES, sized_conf
    small = sized_conf(10 * 1024 * 1024, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = sized_conf(100 * 1024 ** 4, cores=8000)          # 100 TiB on 8000 cores
    parts = int(big["spark.sql.shuffle.partitions"])
    size = int(big["spark.sql.adaptive.advisoryPartitionSizeInBytes"].rstrip("m")) * 1024 ** 2
    assert parts <= 50_000 and size >= TARGET_PARTITION_BYTES   # fewer, larger partitions at this size
    assert parts * size >= 3 * 100 * 1024 ** 4
    assert big["spark.sql.files.maxPartitionBytes"] == "256m"


def test_input_bytes_reads_metadata(spark):
    import os
    from paths import SF001
    from histwise.session import input_bytes
    p = f"{SF001}/events.parquet"
    expected = (os.path.getsize(p) if os.path.isfile(p) else
                sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(p) for f in fs))
    assert input_bytes(spark, p) == expected
