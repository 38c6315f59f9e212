"""Line-based files: accession lists, chunk directories, completed lists, FASTA.

FASTA is read by the text source with a record separator, so records are split across tasks by the
file reader and parsed by built-in functions. Files with CRLF ends and wrapped lines are read alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions.text import natural_number

def _name() -> Column:
    return F.col("_metadata.file_name")


def _lines(spark: SparkSession, paths) -> DataFrame:
    """(file, pos, value): pos orders the lines of a file, by block start and place in the block."""
    lines = spark.read.text(paths).select(_name().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"), "value")
    return lines.select("file", F.struct("block", "nth").alias("pos"), "value")


def accessions(spark: SparkSession, paths) -> DataFrame:
    """(file, pos, accession): trimmed lines but blank ones and comments, order and repeats kept."""
    value = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    return _lines(spark, paths).withColumn("accession", value).filter((F.col("accession") != "") & ~F.col("accession").startswith("#")).select("file", "pos", "accession")


def raw_accessions(spark: SparkSession, paths) -> DataFrame:
    """As accessions, but kept lines are not trimmed."""
    return _lines(spark, paths).filter(~F.col("value").rlike(r"^\s*$") & ~F.col("value").rlike(r"^\s*#")).select("file", "pos", F.col("value").alias("accession"))


def chunk_directory(spark: SparkSession, path: str) -> DataFrame:
    """(file, file_number, pos, accession), distinct accessions of a file; order files by their
    last number, then by name."""
    lines = accessions(spark, path)
    return lines.groupBy("file", "accession").agg(F.min("pos").alias("pos")).select("file", natural_number(F.col("file")).alias("file_number"), "pos", "accession")


def completed(spark: SparkSession, paths) -> DataFrame:
    """Distinct first words of the lines."""
    return spark.read.text(paths).select(F.split(F.trim("value"), r"\s+")[0].alias("accession")).filter("accession <> ''").distinct()


def _mark_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds whether a record is the first of its file: one whose file part starts at 0 and differs
    from that of the record before."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pc.binary_join_element_wise(batch.column("file"), pc.cast(batch.column("block"), pa.string()), ":")
        shifted = pa.concat_arrays([pa.array([before], pa.string()), part.slice(0, len(part) - 1)])
        new = pc.fill_null(pc.not_equal(part, shifted), True)
        before = part[-1].as_py()
        yield batch.append_column("first", pc.and_(new, pc.equal(batch.column("block"), 0)))


def fasta(spark: SparkSession, paths) -> DataFrame:
    """(assembly, pos, seq_id, header, seq): one row per record, repeats kept. The id is the first
    word of the header, sequences are joined and upper-cased; text before the first header goes.
    Nothing is shuffled: the first record of a file is told by its neighbour in the same task."""
    raw = spark.read.option("lineSep", "\n>").text(paths).select(_name().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"), "value")
    marked = raw.mapInArrow(_mark_first, "file string, block long, nth long, value string, first boolean")
    record = marked.filter(~F.col("first") | F.col("value").startswith(">")).withColumn("value", F.when(F.col("first"), F.expr("substr(value, 2)")).otherwise(F.col("value")))
    header = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "")
    return record.select(
        F.regexp_replace("file", r"\.[^.]*$", "").alias("assembly"), F.struct("block", "nth").alias("pos"), F.regexp_extract(header, r"^\s*(\S*)", 1).alias("seq_id"), header.alias("header"), F.upper(body).alias("seq")
    )


def last_of_each(records: DataFrame) -> DataFrame:
    """One row per id as a keyed index has it: the last sequence, at the first position."""
    return records.groupBy("seq_id").agg(F.max_by("seq", F.struct("assembly", "pos")).alias("seq"), F.min(F.struct("assembly", "pos")).alias("pos"))


def fasta_count(spark: SparkSession, paths) -> DataFrame:
    """Header lines by file."""
    return spark.read.text(paths).select(_name().alias("file"), "value").groupBy("file").agg(F.count(F.when(F.col("value").startswith(">"), 1)).alias("records"))


def available_accessions(spark: SparkSession, folder: str, suffix: str = ".faa") -> DataFrame:
    """Stems of the files of a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder).select("path")
    return files.select(F.regexp_extract("path", rf"([^/]+)\{suffix}$", 1).alias("accession"))


def nested_accessions(spark: SparkSession, folder: str, entry: str = "protein.faa") -> DataFrame:
    """(accession, path) of a tree of accession folders, as a flat list."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", entry).load(folder).select("path")
    return files.select(F.regexp_extract("path", rf"(GC[FA]_[^/]+)/(?:.*/)?{entry}$", 1).alias("accession"), "path").filter("accession <> ''")


def first_found(wanted: DataFrame, found: list[DataFrame]) -> DataFrame:
    """(accession, path, priority) of wanted accessions: the path of the first listing that has it,
    null where none does (those are to be downloaded)."""
    listed = None
    for priority, listing in enumerate(found):
        own = listing.select("accession", "path", F.lit(priority).alias("priority"))
        listed = own if listed is None else listed.unionByName(own)
    best = listed.groupBy("accession").agg(F.min_by("path", "priority").alias("path"), F.min("priority").alias("priority"))
    return wanted.join(best, "accession", "left")
