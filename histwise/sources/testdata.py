"""Binding of the driver's generic test tables to the interaction-log inputs.

The test tables hold no answer log, so one is derived from ``events``,
``part`` and ``embeddings`` with fixed rules (the same expressions are
written in DuckDB in ``histwise.plans.oracle``):

* ``k``            = integer ``props.k`` (0..99), the item id
* ``row_id``       = ``event_id``;  ``user_id`` = ``user_id``
* ``timestamp``    = epoch milliseconds of ``ts`` floored to the hour (ties on purpose)
* ``content_type_id`` = 1 for ``signup`` events (lectures), else 0
* ``answered_correctly`` = -1 on lectures, else 1 if ``value > 3*k`` else 0
* ``prior_question_elapsed_time`` = milliseconds of ``ts`` within its hour, NULL on masked rows
* ``prior_question_had_explanation`` = ``event_type = 'view'``, NULL on masked rows
* masked rows      = ``(event_id // 10) % 10 = 0``, so that no fold can be told by them
* ``questions``    = all of ``part``, ``part = 1 + p_size % 7`` (item 0 has no row there)
* ``lectures``     = every item seen on a lecture row, ``part = 1 + k % 7``,
                     ``type_of`` = LECTURE_TYPES[k % 4]
* ``val_row_id``   = ``event_id`` with ``event_id % 10 = 7``
* ``embeddings``   = ``embeddings.embedding``, whole, as doubles, ``vec_id`` = item
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histwise.sources.inputs import Inputs

# The four lecture kinds, in the reference's order.
LECTURE_TYPES = ["concept", "solving question", "intention", "starter"]
HOUR_MS = 3_600_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("long")


def bind_train(events: DataFrame) -> DataFrame:
    # a step of its own, so that the JSON is parsed once for each row and not once for each use
    events = events.withColumn("_k", _k())
    k = F.col("_k")
    # epoch ms of the wall-clock value; independent of the session time zone
    ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")
    is_lecture = F.col("event_type") == "signup"
    masked = F.expr("event_id div 10") % 10 == 0
    return events.select(
        F.col("event_id").alias("row_id"),
        F.col("user_id"),
        (ms - ms % HOUR_MS).cast("long").alias("timestamp"),
        k.alias("content_id"),
        F.when(is_lecture, 1).otherwise(0).alias("content_type_id"),
        F.when(is_lecture, -1).when(F.col("value") > k * 3, 1).otherwise(0)
         .alias("answered_correctly"),
        F.when(masked, F.lit(None)).otherwise(ms % HOUR_MS)
         .cast("double").alias("prior_question_elapsed_time"),
        F.when(masked, F.lit(None)).otherwise(F.col("event_type") == "view")
         .cast("boolean").alias("prior_question_had_explanation"),
    )


def bind_questions(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("question_id"), (F.col("p_size") % 7 + 1).cast("int").alias("part"))


def bind_lectures(train: DataFrame) -> DataFrame:
    ids = train.where(F.col("content_type_id") == 1).select(
        F.col("content_id").alias("lecture_id")).distinct()
    kinds = F.array(*[F.lit(t) for t in LECTURE_TYPES])
    return ids.select(
        "lecture_id",
        (F.col("lecture_id") % 7 + 1).cast("int").alias("part"),
        F.element_at(kinds, (F.col("lecture_id") % 4 + 1).cast("int")).alias("type_of"),
    )


def bind_val(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_id") % 10 == 7).select(F.col("event_id").alias("row_id"))


def bind_embeddings(emb: DataFrame) -> DataFrame:
    vec = F.transform("embedding", lambda x: x.cast("double"))
    return emb.select(F.col("vec_id").alias("content_id"), vec.alias("vec"))


def load_inputs(spark: SparkSession, sf_dir: str, check_keys: bool = True) -> Inputs:
    events = read_table(spark, sf_dir, "events")
    train = bind_train(events)
    return Inputs(
        train=train,
        questions=bind_questions(read_table(spark, sf_dir, "part")),
        lectures=bind_lectures(train),
        val_row_id=bind_val(events),
        embeddings=bind_embeddings(read_table(spark, sf_dir, "embeddings")),
        check_keys=check_keys,
    )
