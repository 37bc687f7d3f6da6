"""Table sources: manifests as CSV or Parquet, result rows as JSON lines, files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "record_id string, pdf_path string, xml_path string"


def manifest_csv(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, pdf_path, xml_path) of a CSV file with a header; other columns
    stay as strings."""
    df = spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False)
    missing = [c for c in MANIFEST.replace(" string", "").split(", ") if c not in df.columns]
    if missing:
        raise ValueError(f"the manifest has no {', '.join(missing)}")
    return df


def manifest_parquet(spark: SparkSession, path: str, id_col: str = "id", pdf: str = "pdf", xml: str = "xml") -> DataFrame:
    """(record_id, pdf binary, xml string): documents and gold in one table.  Rows
    without an id or either of both are left out; binary XML is read as UTF-8 and bytes that aren't are dropped."""
    df = spark.read.parquet(path).select(F.col(id_col).cast("string").alias("record_id"), F.col(pdf).alias("pdf"), F.col(xml).alias("xml"))
    text = F.col("xml").cast("string")
    if dict(df.dtypes)["xml"] == "binary":
        text = F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit(""))
    return df.where("record_id is not null and pdf is not null and xml is not null").withColumn("xml", text)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped and fields that are
    missing are NULL."""
    return spark.read.schema(schema).json(path)


def binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(record_id, content): files by their name without the suffix."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return df.select(F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "").alias("record_id"), "content")


def sampled_manifest(pdfs: DataFrame, golds: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """(record_id, pdf_path, xml_path): ``n`` of the documents (record_id, path) that
    have a gold record (record_id, path), chosen by a hash of their id."""
    both = pdfs.select("record_id", F.col("path").alias("pdf_path")).join(golds.select("record_id", F.col("path").alias("xml_path")), "record_id")
    return both.orderBy(F.xxhash64("record_id", F.lit(seed)), "record_id").limit(n)


def parser_label(record: Column, hint: Column, usual: str = "grobid") -> Column:
    """The parser of a result: as its record says, or else as its name hints."""
    return F.coalesce(F.nullif(record, F.lit("")), F.nullif(hint, F.lit("")), F.lit(usual))


def parser_of_artifact(name: Column, known: tuple[str, ...] = ("grobid", "sciencebeam")) -> Column:
    """The last part of a name if it is a parser's."""
    last = F.element_at(F.split(name, "-"), -1)
    return F.when(last.isin(*known), last)
