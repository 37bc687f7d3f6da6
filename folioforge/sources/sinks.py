"""Sinks and resumption: result tables that a run replaces, rows still to do, and
the split of results and errors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pending(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key isn't done."""
    return wanted.join(done.select(keys).distinct(), keys, "left_anti")


def upsert_run(df: DataFrame, path: str, keys: tuple[str, ...] = ("run_sha", "parser")) -> None:
    """Write the rows of one or more runs; what the table has of those runs is
    replaced, and other runs stay.  Each run is a partition, overwritten as one."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_results(df: DataFrame, path: str, run: str | None = None) -> None:
    """Rows as JSON lines, NULL fields left out.  With a ``run``, the rows of that
    run are replaced, so one that is done again doubles nothing; without, they are
    added."""
    if run is None:
        df.write.mode("append").json(path)
    else:
        df.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").json(path)


def write_manifest(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_cases(df: DataFrame, path: str) -> None:
    """Drill-down rows by mode, metric and corpus."""
    df.write.mode("overwrite").partitionBy("mode", "metric", "corpus").json(path)


def split_errors(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(results, errors) of a stage whose rows carry an error or NULL."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def run_record(results: DataFrame, errors: DataFrame, **facts: str) -> DataFrame:
    """One row about a run: the given facts, records and errors."""
    n = results.agg(F.count("*").alias("n_records")).crossJoin(errors.agg(F.count("*").alias("n_errors")))
    return n.select(*(F.lit(v).alias(k) for k, v in facts.items()), "n_records", "n_errors")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (``spark.checkpoint.dir``);
    only where a local session names none, in the machine's temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        named = tempfile.mkdtemp(prefix="folioforge-")
        atexit.register(shutil.rmtree, named, True)
    return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def export(df: DataFrame, path: str, kind: str) -> None:
    """The rows as ``csv`` with a header, ``json`` lines, ``parquet``, or ``text``
    (one column of Markdown or other text)."""
    w = df.write.mode("overwrite")
    {"csv": lambda: w.csv(path, header=True, escape='"'), "json": lambda: w.json(path), "parquet": lambda: w.parquet(path), "text": lambda: w.text(path)}[kind]()
