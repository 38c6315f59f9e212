"""The driver's tables as sequences, hits, work queue and metadata. Whole tables, whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions.text import natural_number
from helixframe.operators.workqueue import split_by
from helixframe.schemas import ALPHABET

CHUNK_SIZE = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _letters(text):
    return F.upper(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{ALPHABET}{ALPHABET.lower()}]+", ""))


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq_id, pos, seq): the letters of each document's whole text."""
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("S"), F.col("doc_id")).alias("seq_id"), F.col("doc_id").alias("pos"), _letters(F.col("text")).alias("seq"))


def structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of labelled documents; those of low quality lack their first letter."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("pos"), "quality")
    return sequences(spark, sf_dir).join(labels, "pos").select("seq_id", "pos", F.when(F.col("quality") == 1, F.col("seq")).otherwise(F.expr("substr(seq, 2)")).alias("seq"))


def family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(family, seq_id, pos, seq): the passages of `benchmark` as one family."""
    return table(spark, sf_dir, "benchmark").select(F.lit("all").alias("family"), F.concat(F.lit("B"), F.col("item_id")).alias("seq_id"), F.col("item_id").alias("pos"), _letters(F.col("text")).alias("seq"))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_suppkey")).alias("query"),
        F.concat(F.lit("P"), F.col("l_partkey") % 100).alias("target"),
        F.round(F.col("l_discount") * 10, 1).alias("fident"),
        F.col("l_quantity").cast("int").alias("alnlen"),
        F.pow(F.lit(10.0), -F.col("l_extendedprice") / 1000).alias("evalue"),
        (F.col("l_extendedprice") / 100).alias("bits"),
        "l_orderkey",
        "l_linenumber",
    )


def accessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(accession, pos, source) of all orders, in key order."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("accession"), F.col("o_orderkey").alias("pos"), F.concat(F.lit("C"), F.col("o_custkey")).alias("source"))


def done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("accession"))


def chunk_files(spark: SparkSession, sf_dir: str, size: int = CHUNK_SIZE) -> DataFrame:
    """(file, file_number, pos, accession): the orders in files of a fixed size."""
    split = split_by(accessions(spark, sf_dir), size, "pos")
    name = F.format_string("chunk_%02d.txt", F.col("chunk") + 1)
    return split.select(name.alias("file"), natural_number(name).alias("file_number"), "pos", "accession")
