"""A feed of finished work: run metadata as it arrives, each accession once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from helixframe import schemas


#: An age that no file has: the reader leaves out files that are older than the newest by more.
EVER = "36500d"


def completed_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000, delay: str | None = None) -> DataFrame:
    """(accession, source, seen): every downloaded accession of new metadata files, the first time
    it is seen, in whatever order the files arrive. State is one key an accession. With a delay, state
    is bounded instead: a file whose time is that far behind the newest is dropped if it comes in a
    later trigger, and a repeat after it is taken for new."""
    age = {"maxFileAge": EVER} if delay is None else {}
    raw = spark.readStream.schema(schemas.METADATA).options(**age).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "metadata*.json").option("maxFilesPerTrigger", files_per_trigger).json(folder)
    rows = raw.select(F.explode("assemblies_downloaded").alias("accession"), F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("source"), F.col("_metadata.file_modification_time").alias("seen"))
    return rows.dropDuplicates(["accession"]) if delay is None else rows.withWatermark("seen", delay).dropDuplicatesWithinWatermark(["accession"])


def write_completed(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Appends to a table exactly once, and ends when all files there are have been read."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
