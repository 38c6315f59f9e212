"""Hit tables, run metadata, report pages and benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe import schemas


def hit_table(spark: SparkSession, paths) -> DataFrame:
    """A tab-separated hit table of twelve columns without a header."""
    return spark.read.schema(schemas.HITS).csv(paths, sep="\t")


def run_metadata(spark: SparkSession, base: str, folder: str = "task_*", depth: int = 3, strict: bool = False) -> DataFrame:
    """Metadata of runs up to a depth of folders, with the path; unreadable files have a null
    assemblies_downloaded and their text in _corrupt, or fail the job if strict."""
    pattern = "{" + ",".join("*/" * n + folder for n in range(depth)) + "}"
    reader = spark.read.schema(schemas.METADATA).option("multiLine", "true").option("mode", "FAILFAST" if strict else "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
    return reader.json(f"{base}/{pattern}/metadata.json").select("*", F.col("_metadata.file_path").alias("path"))


def downloaded(metadata: DataFrame) -> DataFrame:
    """(accession, source): a row per downloaded assembly, the source being its two last folders."""
    source = F.regexp_extract("path", r"([^/]+/[^/]+)/[^/]+$", 1)
    return metadata.select(F.explode("assemblies_downloaded").alias("accession"), source.alias("source"))


def skipped(metadata: DataFrame) -> DataFrame:
    return metadata.filter("_corrupt IS NOT NULL AND assemblies_downloaded IS NULL").select("path")


def report_pages(pages: DataFrame, most: int | None = None) -> DataFrame:
    """(page, pos, accession) of pages (page, reports): the first `most` of all, nulls dropped."""
    rows = pages.select("page", F.posexplode("reports").alias("pos", "report")).select("page", "pos", F.col("report.accession").alias("accession")).filter("accession IS NOT NULL")
    return rows.orderBy("page", "pos").limit(most) if most is not None else rows


def read_pages(spark: SparkSession, paths) -> DataFrame:
    """Pages kept as JSON files, numbered by file name."""
    pages = spark.read.schema(schemas.REPORT_PAGE).option("multiLine", "true").json(paths)
    return pages.select(F.col("_metadata.file_name").alias("page"), "reports", "next_page_token")


def benchmark_rates(runs: DataFrame) -> DataFrame:
    """Residues and proteins a second of each stage."""
    columns = [
        (F.col(n) / F.nullif(F.col(f"time_{stage}_s"), F.lit(0.0))).alias(f"{short}_per_s_{stage}")
        for stage in ("createdb", "search", "total") for n, short in (("total_residues", "residues"), ("num_proteins", "proteins"))
    ]
    return runs.select("*", *columns)
