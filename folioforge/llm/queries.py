"""The queries of the training-data operators, by name, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, compaction, dac, html_text, packing, rpforest, simhash, substring, toxicity, wand
from .common import shared_dir


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rpforest.near_groups(spark, _read(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, _read(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(spark, _read(spark, sf_dir, "documents")).select("doc_id", "group_id", "keep")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.dedup(spark, _read(spark, sf_dir, "documents"))
    spans = F.transform("removed", lambda x: F.concat_ws("-", x["begin"], x["end"]))
    return out.select("doc_id", "text", F.array_join(spans, " ").alias("removed"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fitted(spark, docs, sf_dir)).select("doc_id", "tox_score", "tox_hits", "toxic")


def op7_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wand.top_k(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.encode_texts(spark, _read(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = f"{shared_dir(spark)}/folioforge/store-{uuid.uuid4().hex}"
    return compaction.arrivals(spark, _read(spark, sf_dir, "documents"), store)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(spark, _read(spark, sf_dir, "documents"), keep_text=False)
    return out.select("doc_id", "n_tokens", "tokens", "round_trip")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_packing": op2_packing,
    "op3_simhash": op3_simhash,
    "op4_html": op4_html,
    "op5_substring": op5_substring,
    "op6_toxicity": op6_toxicity,
    "op7_bm25": op7_bm25,
    "op8_token_codes": op8_token_codes,
    "op9_sharding": op9_sharding,
    "op10_bpe": op10_bpe,
}

ORACLE_SQL: dict[str, str] = {"op5_substring": substring.SQL, "op7_bm25": wand.SQL, "op9_sharding": compaction.SQL}
