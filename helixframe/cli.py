"""Command line: overview, lookup and similar over a results folder; work-queue commands.

    python -m helixframe.cli overview RESULTS
    python -m helixframe.cli similar RESULTS P7 --evalue 0.01 --max-hits 50 --output-fasta out/
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe import session, sinks
from helixframe.functions.text import letters
from helixframe.operators import composition, distance, hits, workqueue
from helixframe.sources import remote, tables, text
from helixframe.storage import scratch


class Results:
    """A results folder: a hit table, a structure FASTA, a residue FASTA and metadata."""

    def __init__(self, spark: SparkSession, folder: str, hit_file: str = "results.tsv", structure_file: str = "structures.fasta", residue_file: str = "combined_aa.fasta"):
        self.spark, self.folder, self.files = spark, folder.rstrip("/"), (hit_file, structure_file, residue_file)

    def hits(self) -> DataFrame:
        return tables.hit_table(self.spark, f"{self.folder}/{self.files[0]}")

    def structures(self) -> DataFrame:
        return text.last_of_each(text.fasta(self.spark, f"{self.folder}/{self.files[1]}"))

    def residues(self) -> DataFrame:
        return text.last_of_each(text.fasta(self.spark, f"{self.folder}/{self.files[2]}"))


def overview(results: Results) -> dict[str, DataFrame]:
    seqs, table = results.structures(), results.hits()
    return {
        "lengths": composition.length_summary(seqs),
        "flags": composition.complexity_flags(seqs),
        "letters": composition.letter_usage(seqs).orderBy(F.desc("n"), "ch"),
        "totals": hits.totals(table),
        "evalues": hits.evalue_thresholds(table),
        "identity": hits.identity_buckets(table),
        "busiest": hits.busiest_queries(table),
    }


def lookup(results: Results, seq_id: str) -> dict[str, DataFrame]:
    """The sequences of an id and its composition; without a match, ids that hold it."""
    found = composition.lookup(results.structures(), results.residues(), seq_id)
    own = found.select(F.explode(letters(F.col("structure"))).alias("ch")).groupBy("ch").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "ch")
    return {"found": found, "letters": own, "did_you_mean": composition.similar_ids(results.structures(), seq_id)}


def similar(results: Results, seq_id: str, evalue: float = 0.01, most: int = 50) -> dict[str, DataFrame]:
    return {"status": hits.query_status(results.hits(), results.structures(), seq_id), "hits": hits.top_hits(results.hits(), seq_id, evalue, most)}


def collect(spark: SparkSession, base: str, out: str) -> DataFrame:
    """The index of downloaded accessions and those that occur again, written under out."""
    rows = tables.downloaded(tables.run_metadata(spark, base)).select("accession", "source", F.col("source").alias("pos"))
    counted = workqueue.frequencies(rows)
    sinks.write_index(counted.select("accession", F.col("first_source").alias("source")).orderBy("accession"), f"{out}/all_accessions")
    sinks.write_table(counted.filter("n > 1").select("accession", "n").orderBy("accession"), f"{out}/duplicate_accessions", sep="\t", header=False)
    return counted


def progress(spark: SparkSession, chunks: str, done: str) -> dict[str, DataFrame]:
    files, completed = text.chunk_directory(spark, chunks), text.completed(spark, done)
    by_file = workqueue.chunk_progress(files, completed)
    numbered = by_file.join(files.select("file", "file_number").distinct(), "file")
    return {"overall": workqueue.overall(by_file, files, completed), "runs": workqueue.progress_runs(numbered, "file_number", "file"), "histogram": workqueue.progress_histogram(by_file)}


def split(spark: SparkSession, source: str, chunks: int, out: str) -> DataFrame:
    assigned = workqueue.split_into(text.accessions(spark, source), chunks, "file", "pos")
    sinks.write_chunks(assigned, out)
    return assigned.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).orderBy("chunk")


def chunk_remaining(spark: SparkSession, genomes: str, base: str, size: int, out: str) -> DataFrame:
    left = workqueue.remaining(text.available_accessions(spark, genomes), tables.downloaded(tables.run_metadata(spark, base)))
    assigned = workqueue.split_by(left, size, "accession")
    sinks.write_chunks(assigned, out)
    return assigned.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).orderBy("chunk")


def remove_done(spark: SparkSession, chunks: str, done: str, out: str | None) -> DataFrame:
    """The report of a removal; with out, the files that are left are written there."""
    files, completed = text.chunk_directory(spark, chunks), text.completed(spark, done)
    if out:
        kept = workqueue.remove_completed(files, completed)
        sinks.write_files(kept.select("file", "pos", F.col("accession").alias("value")), out, "pos")
    return workqueue.removal_report(files, completed).orderBy("file")


def rechunk(spark: SparkSession, chunks: str, size: int, out: str) -> DataFrame:
    """Files joined in order, repeats dropped, cut anew."""
    first = workqueue.first_occurrences(text.chunk_directory(spark, chunks), "file_number", "file", "pos")
    assigned = workqueue.split_by(first, size, "file_number", "file", "pos")
    sinks.write_chunks(assigned, out)
    return assigned.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).orderBy("chunk")


def fetch_accessions(spark: SparkSession, url: str, limit: str, out: str) -> DataFrame:
    """The accessions of a report service, page after page, as one file in the order of the pages."""

    class Pages(remote.ReportPages):
        fetch = staticmethod(remote.page_fetch(url))

    spark.dataSource.register(Pages)
    found = spark.read.format(Pages.name()).option("limit", limit).load()
    sinks.write_files(found.select(F.lit("accessions.txt").alias("file"), "page", "pos", F.col("accession").alias("value")), out, "page", "pos")
    return text.accessions(spark, f"{out}/accessions.txt").agg(F.count(F.lit(1)).alias("n"))


def download(spark: SparkSession, source: str, url: str, out: str, kind: str = "package", with_key: bool = False) -> DataFrame:
    """Fetches what a list of accessions lacks in a folder: a file each, and the report of all calls."""
    suffix, decode = {"package": (".faa", remote.package_entry), "fasta": (".faa", remote.plain_text), "structure": (".pdb", remote.plain_text)}[kind]
    wanted, there = text.accessions(spark, source), text.available_accessions(spark, out, suffix)
    got = scratch(remote.download(wanted, there, remote.http_fetch(url), with_key, decode=decode), "downloads")
    sinks.write_files(got.filter("content IS NOT NULL").select(F.concat("accession", F.lit(suffix)).alias("file"), F.col("content").alias("value")), out)
    return got.select("accession", F.col("content").isNotNull().alias("written"), "error").orderBy("accession")


def search(spark: SparkSession, queries: str, targets: str | None, out: str, best: int | None = None, evalue: float = 10.0) -> DataFrame:
    """Writes the hit table of FASTA files against others, or against themselves, without a header; the
    number of queries and hits."""
    asked = text.last_of_each(text.fasta(spark, queries))
    found = scratch(distance.search(asked, targets and text.last_of_each(text.fasta(spark, targets)), best, evalue=evalue), "hits")
    sinks.write_table(found.orderBy("query", "evalue", "target"), out, sep="\t", header=False)
    return found.agg(F.countDistinct("query").alias("queries"), F.count(F.lit(1)).alias("hits"))


def validate(results: Results) -> dict[str, DataFrame]:
    seqs = results.structures()
    return {"pairs": composition.validate_pairs(results.residues(), seqs), "dominant": composition.dominant_letter(seqs), "bad": composition.bad_letters(seqs)}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="helixframe")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("overview", "validate"):
        sub.add_parser(name).add_argument("results")
    p = sub.add_parser("lookup")
    p.add_argument("results")
    p.add_argument("seq_id")
    p = sub.add_parser("similar")
    p.add_argument("results")
    p.add_argument("seq_id")
    p.add_argument("--evalue", type=float, default=0.01)
    p.add_argument("--max-hits", type=int, default=50)
    p.add_argument("--output-fasta")
    p = sub.add_parser("collect")
    p.add_argument("base")
    p.add_argument("--output-dir", required=True)
    p = sub.add_parser("progress")
    p.add_argument("chunks")
    p.add_argument("done")
    p = sub.add_parser("split")
    p.add_argument("file")
    p.add_argument("-n", type=int, default=12)
    p.add_argument("-o", "--output-dir", default="chunks")
    p = sub.add_parser("chunk-remaining")
    p.add_argument("--genomes-dir", required=True)
    p.add_argument("--results-dir", required=True)
    p.add_argument("--chunk-size", type=int, default=50)
    p.add_argument("--output-dir", default="chunks")
    p = sub.add_parser("remove-done")
    p.add_argument("chunks")
    p.add_argument("done")
    p.add_argument("--output-dir", help="left out: a dry run")
    p = sub.add_parser("fetch-accessions")
    p.add_argument("url")
    p.add_argument("--limit", default="all")
    p.add_argument("--output-dir", required=True)
    p = sub.add_parser("download")
    p.add_argument("file")
    p.add_argument("url", help="with {} where an accession goes")
    p.add_argument("--kind", choices=("package", "fasta", "structure"), default="package")
    p.add_argument("--with-key", action="store_true")
    p.add_argument("--output-dir", required=True)
    p = sub.add_parser("search")
    p.add_argument("queries", help="FASTA files")
    p.add_argument("--targets", help="FASTA files; left out: the queries against themselves")
    p.add_argument("--best", type=int, help="targets of a query that are aligned at most")
    p.add_argument("--evalue", type=float, default=10.0)
    p.add_argument("--output-dir", required=True)
    p = sub.add_parser("rechunk")
    p.add_argument("chunks")
    p.add_argument("--chunk-size", type=int, default=20)
    p.add_argument("--output-dir", default="chunks")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = spark or session.build()
    shown: DataFrame | dict[str, DataFrame]
    if a.command == "overview":
        shown = overview(Results(spark, a.results))
    elif a.command == "validate":
        shown = validate(Results(spark, a.results))
    elif a.command == "lookup":
        shown = lookup(Results(spark, a.results), a.seq_id)
    elif a.command == "similar":
        results = Results(spark, a.results)
        shown = similar(results, a.seq_id, a.evalue, a.max_hits)
        if a.output_fasta:
            sinks.write_hit_fasta(hits.export_records(shown["hits"], results.residues()), a.output_fasta)
    elif a.command == "collect":
        shown = collect(spark, a.base, a.output_dir)
    elif a.command == "progress":
        shown = progress(spark, a.chunks, a.done)
    elif a.command == "split":
        shown = split(spark, a.file, a.n, a.output_dir)
    elif a.command == "chunk-remaining":
        shown = chunk_remaining(spark, a.genomes_dir, a.results_dir, a.chunk_size, a.output_dir)
    elif a.command == "fetch-accessions":
        shown = fetch_accessions(spark, a.url, a.limit, a.output_dir)
    elif a.command == "download":
        shown = download(spark, a.file, a.url, a.output_dir, a.kind, a.with_key)
    elif a.command == "search":
        shown = search(spark, a.queries, a.targets, a.output_dir, a.best, a.evalue)
    elif a.command == "remove-done":
        shown = remove_done(spark, a.chunks, a.done, a.output_dir)
    else:
        shown = rechunk(spark, a.chunks, a.chunk_size, a.output_dir)
    for name, frame in (shown if isinstance(shown, dict) else {a.command: shown}).items():
        print(f"== {name}")
        frame.show(50, truncate=100)


if __name__ == "__main__":
    main()
