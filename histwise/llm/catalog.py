"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histwise.llm import bpe, chat, collocations, exact_dedup, html_text, line_dedup, packing, pii, repair, simhash, topk, toxicity, warc
from histwise.llm.common import table

#: The vocabulary of the contract's queries, a file on every node.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), VOCABULARY)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.contract(table(spark, sf_dir, "documents"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.contract(table(spark, sf_dir, "pages"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.contract(table(spark, sf_dir, "embeddings"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.contract(table(spark, sf_dir, "conversations"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.contract(spark, f"{sf_dir}/documents.parquet")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.contract(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.contract(table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.contract(table(spark, sf_dir, "pages"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.contract(table(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.contract(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_packing, op2_simhash, op3_html, op4_topk, op5_chat, op6_bpe, op7_line_dedup, op8_exact_dedup, op9_toxicity, op10_pii, op11_warc, op12_repair, op13_collocations)}

ORACLES = {"op4_topk": topk.SQL, "op5_chat": chat.SQL, "op7_line_dedup": line_dedup.SQL, "op8_exact_dedup": exact_dedup.SQL, "op11_warc": warc.SQL, "op13_collocations": collocations.SQL}
