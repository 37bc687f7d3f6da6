"""A training corpus from raw documents: toxic documents go, one document of each
near-duplicate group stays, repeated passages are cut, and what is left is packed.

Each stage takes (spark, docs, sf_dir); ``run`` writes its result as Parquet to
the shared folder, and the next stage reads it from there.

In all stages: ``doc_id`` is an integer column.  Rows with a NULL ``doc_id`` pass
through the first three and aren't packed; a NULL, empty or wordless text is never
toxic, a near-duplicate or a repeat, and takes no room.  Of rows that repeat
``doc_id`` and text the second stage keeps one.  Texts are taken whole, however
long; an empty table gives an empty one.  Other columns, whatever their names, keep
their values up to the last stage, but for ``n_chars``, which follows the text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import packing, simhash, substring, toxicity
from folioforge.llm.common import discard, settled


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the lexicon doesn't reject."""
    return toxicity.clean(docs, toxicity.fitted(spark, docs, sf_dir))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_duplicates(spark, docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages that an earlier one has; ``n_chars``
    follows the text.  A document of which nothing is left stays as ''."""
    out = substring.dedup(spark, docs, offsets=False)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of related documents."""
    return packing.pack(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_near_duplicates),
    ("substring_dedup", without_repeats),
    ("packing", packed),
]

#: SimHash groups and the packing walk can't be expressed in SQL; the stages are
#: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.  What a stage has written is
    deleted as soon as the next one's result is."""
    docs, old = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        docs, path = settled(spark, partial(stage, spark, docs, sf_dir), name)
        discard(spark, old)
        old = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
