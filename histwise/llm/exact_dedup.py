"""Exact duplicates by stateful streaming over stored documents.

A stream reads the stored files and keeps, for each digest (SHA-256 of the whole text), a row
of state without expiry in disk-backed (RocksDB) state: the number of rows, and the stable
identifier and content locator (file, row in the file) of the row that stays. Partial
aggregation before the shuffle leaves one row per digest and task, so a text that a third of
all rows share is no hot key. The state itself, kept in the shared checkpoint folder, is read
back as a table; a later run on the same checkpoint goes on from it with new files only.

A digest that hits more than once is checked on the full bytes: the texts of such rows are
grouped by themselves (again combined before the shuffle), so texts that share a digest but
differ would be classes of their own.

Only DataFrame operations are used; the stream ends in Spark's no-op sink.

Inputs: null counts as an empty text; texts are equal when identical; of equal texts the row with
the largest doc_id stays (null is smallest); rows that repeat it are marked kept as well, since
they carry the same id; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histwise.llm.common import shared_path, stored, text_or_empty

# Spark's settings for disk-backed state that keeps within a bound of memory on each executor.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Files of small stores are not allocated ahead: a store per partition would fill the disk.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


#: Shares into which the rows of one digest are dealt for the check.
SALTS = 16


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def update_state(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Take the files under ``path`` that ``checkpoint`` has not seen into the state."""
    files = spark.read.parquet(path)
    reader = spark.readStream.schema(files.select("doc_id", "text").schema)
    folder, _, name = path.rstrip("/").rpartition("/")
    if all(f.rpartition("/")[2] == name for f in files.inputFiles()):  # one file: a stream reads folders
        stream = reader.option("pathGlobFilter", name).parquet(folder)
    else:
        stream = reader.parquet(path)
    rows = stream.select(
        F.sha2(text_or_empty(), 256).alias("digest"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    state = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("stays"), F.count("*").alias("n"))
    (state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
     .option("checkpointLocation", checkpoint).start().awaitTermination())


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """digest, doc_id and locator (file, row) of the row that stays, and the number of rows."""
    state = spark.read.format("statestore").load(checkpoint)
    fields = state.schema["value"].dataType.names
    return state.select(
        F.col("key").getField("digest").alias("digest"), F.col("value").getField(fields[0]).alias("stays"), F.col("value").getField(fields[1]).alias("n")
    ).select("digest", F.col("stays.doc_id").alias("keep_id"), F.col("stays.file").alias("file"), F.col("stays.row").alias("row"), "n")


def deduplicate(spark: SparkSession, path: str, checkpoint: str | None = None) -> DataFrame:
    """One row per stored document: doc_id, keep_id, group_size, kept, digest, and the locator
    (file, row) of the row that stays."""
    checkpoint = checkpoint or shared_path(spark, "exact-dedup")
    with settings(spark, STATE):
        update_state(spark, path, checkpoint)
        state = stored(read_state(spark, checkpoint), "exact-state")
    texts = spark.read.parquet(path).select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t")).withColumn("digest", F.sha2("t", 256))
    # Full bytes on hits: classes by the text itself. The salt deals a frequent text over tasks,
    # each of which leaves one row of it for the second shuffle.
    hits = state.where("n > 1").select("digest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    equal = stored(texts.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(hits, ["digest", "salt"], "left_semi")
                   .groupBy("digest", "t").agg(F.max("doc_id").alias("own_id"), F.count("*").alias("own_n")), "exact-classes")
    split = equal.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select(F.col("digest").alias("d"))
    rows = texts.select("doc_id", "digest")
    if split.isEmpty():  # no digest stands for two texts: the state has the classes
        whole = rows.join(state, "digest")
    else:
        one = state.join(split, state["digest"] == split["d"], "left_anti")
        several = texts.join(split, texts["digest"] == split["d"], "left_semi").join(equal, ["digest", "t"])
        whole = rows.join(one, "digest").unionByName(several.select(
            "doc_id", "digest", F.col("own_id").alias("keep_id"), F.col("own_n").alias("n"), F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("row")))
    return whole.select("doc_id", "keep_id", F.col("n").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest", "file", "row")


def contract(spark: SparkSession, path: str) -> DataFrame:
    return deduplicate(spark, path).select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
