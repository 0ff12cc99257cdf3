"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of ``docs``; where a stage changes a text, ``n_chars`` follows it. A
stage's own columns carry a prefix and are dropped, so further columns with any name pass.

Inputs: null text counts as empty and stays null where a stage leaves it alone; repeated rows pass
through the filters like others, until near-dedup keeps one; an empty table gives empty stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histwise.llm import line_dedup, packing, pii, simhash, toxicity
from histwise.llm.catalog import VOCABULARY
from histwise.llm.common import OWN, ready, stored, table

#: Documents of this score or more go.
TOXIC = 0.5


def with_text(docs: DataFrame, like: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the columns of ``like``, the text replaced."""
    new = {"text": text, "n_chars": F.length(text).cast(like.schema["n_chars"].dataType) if "n_chars" in like.columns else None}
    return docs.select([new[c].alias(c) if new.get(c) is not None else docs[c] for c in like.columns])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic."""
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col(f"{OWN}toxicity.score") < TOXIC).drop(f"{OWN}toxicity")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that at least ten documents share; every document stays."""
    lines = line_dedup.dedup_lines(docs)
    return with_text(lines, docs, F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col(f"{OWN}lines.kept")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: its smallest doc_id; of the class's rows that repeat
    this id any one, of a class without ids any one row."""
    ready(spark)
    found = stored(simhash.near_duplicates(docs.select("doc_id", "text")), "near-duplicates")
    least = F.col("doc_id") == F.col("component_id")
    ids = found.where("doc_id is not null").groupBy(F.col("doc_id").alias(f"{OWN}id")).agg((F.count("*") > 1).alias(f"{OWN}repeated"), F.max(least).alias(f"{OWN}least"))
    kept = docs.join(ids.where(f"{OWN}least").drop(f"{OWN}least"), docs["doc_id"].cast("long") == F.col(f"{OWN}id"))
    single = kept.where(~F.col(f"{OWN}repeated")).drop(f"{OWN}id", f"{OWN}repeated")
    # rows that repeat an id may be of several classes: the text tells which
    best = found.where(least).groupBy(F.col("root").alias(f"{OWN}root")).agg(F.min("doc_id").alias(f"{OWN}best"), F.min("fp").alias(f"{OWN}code"))
    several = kept.where(f"{OWN}repeated").withColumn(f"{OWN}fp", simhash.coded(spark)(F.coalesce(F.col("text"), F.lit(""))))
    several = several.join(best, (F.col(f"{OWN}id") == F.col(f"{OWN}best")) & (F.col(f"{OWN}fp") == F.col(f"{OWN}code")))
    several = several.dropDuplicates([f"{OWN}root"]).drop(*(f"{OWN}{c}" for c in ("id", "repeated", "fp", "root", "best", "code")))
    nameless = docs.where("doc_id is null")
    nameless = nameless.withColumn(f"{OWN}fp", simhash.coded(spark)(F.coalesce(F.col("text"), F.lit(""))))
    lone = found.where("doc_id is null and component_id is null").select(F.col("fp").alias(f"{OWN}lone")).distinct()
    nameless = nameless.join(lone, nameless[f"{OWN}fp"] == lone[f"{OWN}lone"]).dropDuplicates([f"{OWN}fp"]).drop(f"{OWN}fp", f"{OWN}lone")
    return single.unionByName(several).unionByName(nameless)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked; every document stays."""
    masked = pii.redact(docs)
    return with_text(masked, docs, F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col(f"{OWN}masked")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    ready(spark)
    packed = packing.pack(docs, VOCABULARY)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Training, components and BPE ids are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
