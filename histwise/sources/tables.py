"""Keyed tables on storage: checked while written, published by rename, joined without a shuffle.

``publish`` writes a table into a staging folder next to its place. The rows are dealt by a hash of the
key into buckets and sorted there, so copies of a key are neighbours in one task: the same pass
that writes the rows counts them, proves that no key occurs twice or is NULL, and takes a checksum
of the keys and the NULLs and range of every column (``observe``). Only a table that holds what its
caller expects takes the place of the old one; else the old one stays as it is.

``read`` gives a published table as a bucketed scan, with the narrow types that its ranges allow.
``assemble`` joins tables of one key side by side. Their descriptions say that they have the same
number of rows, unique keys and the same checksum, hence the same keys; with the same buckets the
merge joins need no exchange, whatever the number of tables.

A table is a folder with ``data`` (parquet, one file a bucket) and ``info`` (its description).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histwise.operators.matrix import narrowed_type, numeric_columns

#: Rows of a bucket, and so of a task that writes, joins or reads tables: joining all feature tables sorts this many rows of each.
BUCKET_ROWS = 200_000
#: Rows that are worth a task of their own.
PART_ROWS = 25_000
#: Parts a core from which on a table's own buckets or splits serve as parts.
STORED_PARTS = 8
#: Spark's own limit (spark.sql.sources.bucketing.maxBuckets); tables beyond it have larger buckets.
MAX_BUCKETS = 100_000


class TableCheckError(AssertionError):
    """The rows that were written are not those of the table that was to be published."""


@dataclass(frozen=True)
class Keys:
    """The keys that a table must hold: their number and checksum."""

    rows: int
    checksum: int | None = None


@dataclass(frozen=True)
class Info:
    """Description of a published table. ``ranges``: column -> (smallest, largest), of numbers only."""

    key: str
    buckets: int
    rows: int
    checksum: int
    nulls: dict
    ranges: dict
    sums: dict
    schema: dict

    def types(self, to_float32: bool = False) -> dict[str, str]:
        """Column -> narrower type, for the columns whose range allows one (M2)."""
        schema = T.StructType.fromJson(self.schema)
        found = {c: narrowed_type(schema[c].dataType, lo, hi, to_float32) for c, (lo, hi) in self.ranges.items() if c != self.key}
        return {c: t for c, t in found.items() if t and t != schema[c].dataType.simpleString()}


def checksum(key: str):
    return F.coalesce(F.bit_xor(F.xxhash64(key)), F.lit(0).cast("long"))


def keys_of(df: DataFrame, key: str = "row_id") -> Keys:
    """Number and checksum of the keys of ``df``, in one pass over that column."""
    r = df.agg(F.count(F.lit(1)).alias("rows"), checksum(key).alias("checksum")).first()
    return Keys(r["rows"], r["checksum"])


def buckets_for(rows: int) -> int:
    return min(MAX_BUCKETS, max(1, -(-rows // BUCKET_ROWS)))


def in_parts(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """The ``rows`` rows of ``df``, a stored table, in parts for repeated passes: at most ``BUCKET_ROWS`` each, and one
    for each core unless that leaves less than ``PART_ROWS``. In a part they are in order, so a lost part comes back the
    same. From ``STORED_PARTS`` of them a core the rows stay as they are stored, without an exchange: a part of kept rows
    is then a bucket, of plain files a split of at most ``spark.sql.files.maxPartitionBytes``, and comes back as it is there."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(buckets_for(rows), min(cores, -(-rows // PART_ROWS)))
    if parts >= STORED_PARTS * cores:
        return df
    # by a hash of its own: an exchange like the table's buckets is dropped, and then the buckets are packed
    return df.repartition(parts, F.xxhash64(*by)).sortWithinPartitions(*by)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put the folder ``staged`` in the place of ``path``; an old folder there is kept until the new one has it."""
    fs, new = _file_system(spark, staged)
    place, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.old-{uuid.uuid4().hex}"))
    if fs.exists(place) and not fs.rename(place, old):
        raise OSError(f"{path} cannot be moved aside")
    fs.mkdirs(place.getParent())
    if not fs.rename(new, place):
        if fs.exists(old):
            fs.rename(old, place)
        raise OSError(f"{staged} cannot be moved to {path}")
    if fs.exists(old):
        fs.delete(old, True)


def discard(spark: SparkSession, path: str) -> None:
    fs, place = _file_system(spark, path)
    if fs.exists(place):
        fs.delete(place, True)


def _write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Bucketed files at ``path``. Spark buckets through a catalog table; its entry goes again, the files stay."""
    name = f"keyed_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")


def publish(df: DataFrame, path: str, key: str = "row_id", expected: Keys | None = None, buckets: int | None = None,
            sums: Sequence[str] = ()) -> Info:
    """Write ``df`` as the table at ``path``, if it has one row for each of the ``expected`` keys.

    One pass over ``df``; ``buckets`` follow from the expected rows, or else from the session's shuffle partitions. ``sums``: columns whose total the description keeps. Raises ``TableCheckError`` and
    leaves what was at ``path`` if a key is NULL or occurs twice or the keys are not the expected ones."""
    spark = df.sparkSession
    n = buckets or (buckets_for(expected.rows) if expected else int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbers = numeric_columns(df)
    dealt = df.repartition(n, key).withColumn("_copy", F.row_number().over(Window.partitionBy(key).orderBy(key)))
    value = {c: F.col(c).cast("int") if df.schema[c].dataType.simpleString() == "boolean" else F.col(c) for c in numbers}
    seen = Observation(f"table_{uuid.uuid4().hex}")
    dealt = dealt.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.max("_copy"), F.lit(0)).alias("copies"), checksum(key).alias("checksum"),
        *[F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(f"nulls_{c}") for c in df.columns],
        *[F.min(value[c]).alias(f"min_{c}") for c in numbers], *[F.max(value[c]).alias(f"max_{c}") for c in numbers],
        *[F.sum(F.col(c)).alias(f"sum_{c}") for c in sums])
    staged = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    try:
        _write_bucketed(dealt.drop("_copy"), f"{staged}/data", key, n)
        got = seen.get
        info = Info(key, n, got["rows"], got["checksum"], {c: got[f"nulls_{c}"] for c in df.columns},
                    {c: (got[f"min_{c}"], got[f"max_{c}"]) for c in numbers}, {c: got[f"sum_{c}"] or 0 for c in sums},
                    json.loads(df.schema.json()))
        if info.nulls[key]:
            raise TableCheckError(f"{path}: {info.nulls[key]} rows without {key}")
        if got["copies"] > 1:
            raise TableCheckError(f"{path}: a {key} occurs {got['copies']} times")
        if expected and info.rows != expected.rows:
            raise TableCheckError(f"{path}: {info.rows} rows, {expected.rows} expected")
        if expected and expected.checksum not in (None, info.checksum):
            raise TableCheckError(f"{path}: other keys than expected")
        line = json.dumps(asdict(info), default=str)
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{staged}/info")
        swap(spark, staged, path.rstrip("/"))
    finally:
        discard(spark, staged)
    return info


def info(spark: SparkSession, path: str) -> Info:
    d = json.loads("".join(r["value"] for r in spark.read.text(f"{path.rstrip('/')}/info").collect()))
    return Info(**{**d, "ranges": {c: tuple(r) for c, r in d["ranges"].items()}})


def read(spark: SparkSession, path: str, narrow: bool = True, to_float32: bool = False) -> DataFrame:
    """A published table as a bucketed scan; ``narrow`` gives its columns the smallest types of their ranges."""
    about, data = info(spark, path), f"{path.rstrip('/')}/data"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(about.schema))
    name = f"keyed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{about.key}`) SORTED BY (`{about.key}`) "
              f"INTO {about.buckets} BUCKETS LOCATION '{data}'")
    out = spark.table(name)
    types = about.types(to_float32) if narrow else {}
    out = out.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in out.columns])
    spark.sql(f"DROP TABLE {name}")  # the plan holds the files' place; the entry is not needed
    return out


def assemble(spark: SparkSession, paths: Sequence[str], narrow: bool = True, to_float32: bool = False) -> DataFrame:
    """Published tables of the same keys side by side (M3, J7). Their descriptions prove the 1:1 match."""
    if not paths:
        raise ValueError("no tables")
    about = [info(spark, p) for p in paths]
    for p, a in zip(paths, about):
        if (a.key, a.rows, a.checksum) != (about[0].key, about[0].rows, about[0].checksum):
            raise TableCheckError(f"{p} holds other keys than {paths[0]}")
    out = read(spark, paths[0], narrow, to_float32)
    for p in paths[1:]:
        out = out.join(read(spark, p, narrow, to_float32).hint("merge"), about[0].key)
    return out
