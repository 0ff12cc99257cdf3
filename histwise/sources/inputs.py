"""Input tables of an interaction log and the two tables derived from them.

``train``       row_id, user_id, timestamp (long ms), content_id, content_type_id
                (0 question / 1 lecture), answered_correctly,
                prior_question_elapsed_time, prior_question_had_explanation
``questions``   question_id, part
``lectures``    lecture_id, part, type_of
``val_row_id``  row_id of the hold-out rows
``embeddings``  content_id, vec (array<double>)

Side tables are joined through :func:`bounded_broadcast`: they are
broadcast only after their rows and bytes have been measured (one job),
otherwise the planner (and AQE at runtime) picks a shuffle join.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side table we broadcast after measuring it: rows and in-memory bytes.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024

TRAIN_COLUMNS = (
    "row_id", "user_id", "timestamp", "content_id", "content_type_id",
    "answered_correctly", "prior_question_elapsed_time",
    "prior_question_had_explanation",
)


# In-memory widths (bytes) of Spark's fixed-size types.
FIXED_WIDTH = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4,
               T.FloatType: 4, T.DateType: 4, T.LongType: 8, T.DoubleType: 8,
               T.TimestampType: 8, T.TimestampNTZType: 8}
OTHER_WIDTH = 64


def type_width(t: T.DataType) -> int:
    if isinstance(t, T.DecimalType):
        return 8 if t.precision <= 18 else 16
    if isinstance(t, T.StructType):
        return sum(type_width(f.dataType) for f in t.fields)
    return FIXED_WIDTH.get(type(t), OTHER_WIDTH)


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of one row, measured per row: fixed widths, string/binary lengths and
    array lengths times the element width (other nested types at a fixed estimate)."""
    total = F.lit(0).cast("long")
    for f in schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            size = F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif isinstance(t, T.ArrayType):
            n = F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
            size = n * type_width(t.elementType) + 16
        else:
            size = F.lit(type_width(t))
        total = total + size.cast("long")
    return total


def fits_broadcast(rows: int | None, nbytes: int | None, max_rows: int = MAX_BROADCAST_ROWS,
                   max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    return (rows or 0) <= max_rows and (nbytes or 0) <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` if it has at most ``max_rows`` rows and ``max_bytes`` bytes
    (measured in one aggregate job), else leave the join strategy to the planner."""
    r = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df.schema)).alias("bytes")).first()
    return F.broadcast(df) if fits_broadcast(r["rows"], r["bytes"], max_rows, max_bytes) else df


class DuplicateKeyError(ValueError):
    pass


def checked_side(df: DataFrame, key: str, what: str, check: bool = True,
                 max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Side table with a unique key: one job gives its rows, bytes and the uniqueness
    check; broadcast under both bounds, otherwise left to the planner."""
    if not check:
        return bounded_broadcast(df, max_rows, max_bytes)
    stats = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_c"), F.sum(row_bytes(df.schema)).alias("_b"))
               .agg(F.sum("_c").alias("rows"), F.max("_c").alias("dup"), F.sum("_b").alias("bytes"))
               .first())
    if (stats["dup"] or 0) > 1:
        raise DuplicateKeyError(f"{what}: key {key} is not unique")
    return F.broadcast(df) if fits_broadcast(stats["rows"], stats["bytes"], max_rows, max_bytes) else df


@dataclass
class Inputs:
    """The five input tables plus memoised derived tables."""

    train: DataFrame
    questions: DataFrame
    lectures: DataFrame
    val_row_id: DataFrame
    embeddings: DataFrame
    check_keys: bool = True
    _cache: dict = field(default_factory=dict, repr=False)

    @classmethod
    def from_folder(cls, spark: SparkSession, path: str) -> "Inputs":
        """The five tables as parquet under ``path``, each named after its field."""
        names = ("train", "questions", "lectures", "val_row_id", "embeddings")
        return cls(*[spark.read.parquet(f"{path.rstrip('/')}/{n}.parquet") for n in names])

    @property
    def spark(self):
        return self.train.sparkSession

    def _memo(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    # -- side tables, size-checked ------------------------------------------------
    def questions_side(self) -> DataFrame:
        def build():
            q = self.questions.select(F.col("question_id").cast("long"), F.col("part").cast("int"))
            return checked_side(q, "question_id", "questions", self.check_keys)
        return self._memo("questions_side", build)

    def lectures_side(self) -> DataFrame:
        def build():
            lec = self.lectures.select(
                F.col("lecture_id").cast("long"),
                F.col("part").cast("int").alias("lecture_part"),
                F.col("type_of").alias("lecture_type_of"))
            return checked_side(lec, "lecture_id", "lectures", self.check_keys)
        return self._memo("lectures_side", build)

    def val_side(self) -> DataFrame:
        def build():
            v = self.val_row_id.select(F.col("row_id").cast("long"), F.lit(1).alias("_in_val"))
            return checked_side(v, "row_id", "val_row_id", self.check_keys)
        return self._memo("val_side", build)

    def embeddings_side(self) -> DataFrame:
        def build():
            e = self.embeddings.select(F.col("content_id").cast("long"), F.col("vec"))
            return checked_side(e, "content_id", "embeddings", self.check_keys)
        return self._memo("embeddings_side", build)

    # -- scans (S1) ---------------------------------------------------------------
    def question_rows(self, *cols: str) -> DataFrame:
        """``train`` restricted to question rows, projected to ``cols``."""
        df = self.train.where(F.col("content_type_id") == 0)
        return df.select(*cols) if cols else df

    # -- derived tables -----------------------------------------------------------
    def train_questions(self) -> DataFrame:
        """Question rows + ``part`` + ``val`` flag (FIXTURES §1)."""
        def build():
            q = self.question_rows("row_id", "user_id", "timestamp", "content_id",
                                   "answered_correctly")
            q = q.join(self.questions_side(), q.content_id == F.col("question_id"), "left") \
                 .drop("question_id")
            q = with_val_flag(q, self.val_side())
            return q
        return self._memo("train_questions", build)

    def train_full(self) -> DataFrame:
        """All rows (questions and lectures) + lecture attributes (NULL on questions)."""
        def build():
            t = self.train.select("row_id", "user_id", "timestamp", "content_id", "content_type_id")
            lec = self.lectures_side()
            cond = (F.col("content_type_id") == 1) & (F.col("content_id") == F.col("lecture_id"))
            return t.join(lec, cond, "left").drop("lecture_id")
        return self._memo("train_full", build)


def with_val_flag(df: DataFrame, val_side: DataFrame, out: str = "val") -> DataFrame:
    """Left join against the hold-out list; 1 if found, else 0."""
    return (df.join(val_side, "row_id", "left")
              .withColumn(out, F.when(F.col("_in_val").isNotNull(), 1).otherwise(0))
              .drop("_in_val"))
