"""Writers. Each takes a DataFrame and a folder and writes in parallel; nothing is changed in place."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.functions.text import rgb


def fasta_lines(seqs: DataFrame, header: Column | None = None) -> DataFrame:
    """(value): two lines a record, the header being the id alone unless given."""
    title = F.concat(F.lit(">"), F.col("seq_id")) if header is None else header
    return seqs.select(F.concat(title, F.lit("\n"), F.col("seq")).alias("value"))


def write_fasta(seqs: DataFrame, folder: str, header: Column | None = None, **options: str) -> None:
    """Options go to the writer, such as compression='gzip'."""
    fasta_lines(seqs, header).write.options(**options).text(folder)


def write_raw(lines: DataFrame, folder: str) -> None:
    """Lines (value) as they are: full headers stay."""
    lines.select("value").write.text(folder)


def write_hit_fasta(records: DataFrame, folder: str) -> None:
    records.select(F.concat("header", F.lit("\n"), "seq").alias("value")).write.text(folder)


def write_metadata(runs: DataFrame, folder: str) -> None:
    runs.write.json(folder)


def write_files(lines: DataFrame, folder: str, *order: str) -> None:
    """(file, value) as one plain file for each name, lines in an order; all of them or none.

    Tasks write to a place beside the folder, which Spark's own commit makes whole or leaves empty. There
    the one file of each name gets its name, and then all are published: by renaming the place, if the
    folder does not exist yet, else file by file, taking back what was moved if one can't be. Whatever
    fails, the place is removed. A file that is there already is an error, nothing is overwritten."""
    spark = lines.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join(parts))
    target = folder.rstrip("/")
    files, work = path(target).getFileSystem(conf), f"{target}.writing-{uuid.uuid4().hex}"

    def moved(source, there) -> None:
        if files.exists(there) or not files.rename(source, there):
            raise OSError(f"{there} cannot be written")

    try:
        ordered = lines.select("file", "value", *(F.col(c).alias(f"_{i}") for i, c in enumerate(order))).repartition("file").sortWithinPartitions("file", *(f"_{i}" for i in range(len(order))))
        ordered.select("file", "value").write.partitionBy("file").text(f"{work}/parts")
        files.mkdirs(path(work, "named"))
        names = []
        for found in files.globStatus(path(work, "parts", "file=*", "part-*")):
            names.append(jvm.java.net.URLDecoder.decode(found.getPath().getParent().getName(), "UTF-8").split("=", 1)[1])
            moved(found.getPath(), path(work, "named", names[-1]))
        if not files.exists(path(target)):
            return moved(path(work, "named"), path(target))
        done: list[str] = []
        try:
            for name in names:
                moved(path(work, "named", name), path(target, name))
                done.append(name)
        except Exception:
            for name in done:
                files.delete(path(target, name), False)
            raise
    finally:
        files.delete(path(work), True)


def write_chunks(assigned: DataFrame, folder: str) -> None:
    """(chunk, nth, accession) as chunk_01.txt and on, a line each, in the order of nth."""
    write_files(assigned.select(F.format_string("chunk_%02d.txt", F.col("chunk") + 1).alias("file"), "nth", F.col("accession").alias("value")), folder, "nth")


def write_index(accessions: DataFrame, folder: str) -> None:
    """(accession, source) as lines."""
    accessions.select(F.concat_ws(" ", "accession", "source").alias("value")).write.text(folder)


def write_table(table: DataFrame, folder: str, sep: str = ",", header: bool = True) -> None:
    table.write.csv(folder, sep=sep, header=header)


def write_embeddings(vectors: DataFrame, folder: str, width: int, column: str = "embedding") -> None:
    """One column per dimension, numbered from 0."""
    vectors.select(*[F.col(column)[i].alias(str(i)) for i in range(width)]).write.csv(folder, header=True)


def viewer_bins(scores: DataFrame) -> DataFrame:
    """(bin, residues, colour) of (resi, score): residues counted from 1 by score in hundredths."""
    bins = scores.groupBy(F.round("score", 2).alias("bin")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.col("resi") + 1)), lambda r: r.cast("string")), "+").alias("residues"))
    return bins.withColumn("colour", rgb(F.col("bin")))


def viewer_script(bins: DataFrame, blocks: DataFrame) -> DataFrame:
    """(line_no, value): commands that colour a structure by bins and mark blocks (start, end)."""
    name = F.format_string("cons_%03d", F.floor(F.col("bin") * 100).cast("int"))
    colours = bins.select(F.struct(F.lit(0).alias("part"), F.col("bin").alias("key")).alias("order"), F.concat(
        F.format_string('cmd.set_color("%s", [%.3f, %.3f, %.3f])', name, "colour.r", "colour.g", "colour.b"), F.format_string("\ncolor %s, resi %s", name, F.col("residues"))).alias("value"))
    marks = blocks.select(F.struct(F.lit(1).alias("part"), F.col("start").cast("double").alias("key")).alias("order"), F.format_string("select block_%d, resi %d-%d\nshow sticks, block_%d", F.col("start"), F.col("start") + 1, F.col("end") + 1, F.col("start")).alias("value"))
    return colours.unionByName(marks)
