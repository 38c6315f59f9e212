"""Exact deduplication as a log-structured merge index, in DataFrame operations only.

log        a narrow row per document: digest of the whole text, a second hash, its length
memtable   a bounded share of the log's rows; equal keys collapse to one entry with the number of
           rows and the smallest (or largest) of them, first in each task, so that a text that fills
           a third of the table is one row per task
flush      a memtable's entries become a run: a table in `tablets` buckets by key, each a sorted file,
           and a filter, a bitmap over the run's keys
compaction two runs of a level are merged to one of the next, of double size: as all runs have the
           same sorted buckets, this is a merge join bucket by bucket, without an exchange
hits       texts met more than once: entries with several rows, and those that the filters of other
           runs let through, merged on reading. Keys that every filter clears are never looked at
verify     rows of hits are grouped by their whole bytes; a key that stands for different texts is
           told apart by the texts themselves

An index takes further tables at any time: `add` flushes and compacts, what is there stays.

Cases: null text counts as empty; rows with a null id take part, and stay only if no other row of
the group has an id; repeated rows (the same id twice) count in the size of the group, and one of
them stays; very long texts are hashed whole, and travel only if they are hits; an empty table gives
an empty result; extra columns, also ones named like those of the index, pass through `deduplicate`
untouched and are never read by `classify`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm._common import Filter, maybe_in, membership_filter, small_side
from helixframe.storage import release, scratch, scratch_path

KEY = ["digest", "second", "bytes"]
#: Rows of a memtable by bucket.
MEMTABLE_ROWS = 1_000_000
_ENTRY = ["rows", "keep_none", "keep_id", "keep_batch", "keep_row"]


def sha256_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _text(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


class Run(NamedTuple):
    """A sorted run: a bucketed table of entries and the filter of its keys."""

    name: str
    path: str
    filter: Filter


class Source(NamedTuple):
    docs: DataFrame
    id_col: str
    text_col: str


class Index:
    """Runs of entries (key, rows, keep_*) by level, and the log of the rows that went in."""

    def __init__(self, spark: SparkSession, keep: str = "smallest", digest: Callable[[Column], Column] = sha256_digest, second: Callable[[Column], Column] = F.xxhash64, memtable_rows: int = MEMTABLE_ROWS):
        self.spark, self.digest, self.second, self.memtable_rows = spark, digest, second, memtable_rows
        self.best, self.better = {"smallest": (F.min, F.least), "largest": (F.max, F.greatest)}[keep]
        self.none = {"smallest": lambda c: c.isNull(), "largest": lambda c: c.isNotNull()}[keep]  # in either order an id goes before none
        self.tablets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[Run | None] = []  # a run of each size, or none
        self.logs: list[DataFrame] = []
        self.sources: list[Source] = []

    def keyed(self, text: Column) -> list[Column]:
        return [self.digest(text).alias("digest"), self.second(text).alias("second"), F.octet_length(text).alias("bytes")]

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Logs the rows, flushes them by memtables and compacts what is full."""
        batch = len(self.logs)
        rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.lit(batch).alias("batch"), F.monotonically_increasing_id().alias("row"), *self.keyed(_text(text_col)))
        log = scratch(rows, "lsm-log")
        self.logs.append(log)
        self.sources.append(Source(docs, id_col, text_col))
        count, last = log.agg(F.count(F.lit(1)), F.max(F.shiftright("row", 33))).first()
        # A memtable is a range of the log's partitions: its rows are read from their own files only.
        tables = -(-count // (self.memtable_rows * self.tablets))
        bounds = sorted({(last + 1) * m // tables for m in range(tables + 1)}) if count else []
        for low, high in zip(bounds, bounds[1:], strict=False):
            one = F.struct(self.none(F.col("doc_id")).alias("keep_none"), F.col("doc_id").alias("keep_id"), F.col("batch").alias("keep_batch"), F.col("row").alias("keep_row"))
            memtable = log.filter((F.col("row") >= low << 33) & (F.col("row") < high << 33)).groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"), self.best(one).alias("keep"))
            self._place(self._flush(memtable.select(*KEY, "rows", "keep.*")))

    def _flush(self, entries: DataFrame) -> Run:
        name, path = f"lsm_{uuid.uuid4().hex}", scratch_path(self.spark, "lsm-run")
        entries.write.option("path", path).bucketBy(self.tablets, *KEY).sortBy(*KEY).saveAsTable(name)
        known = membership_filter(self.spark.table(name), F.struct(*KEY))
        return Run(name, path, Filter(scratch(known.bitmap, "lsm-filter"), known.size))

    def _place(self, run: Run) -> None:
        for level, there in enumerate(self.levels):
            if there is None:
                self.levels[level] = run
                return
            merged = self._flush(self.merge(self.spark.table(there.name), self.spark.table(run.name)))
            for old in (there, run):
                self.spark.sql(f"DROP TABLE {old.name}")
                release(old.path, old.filter.bitmap)
            self.levels[level], run = None, merged
        self.levels.append(run)

    def runs(self) -> list[Run]:
        return [run for run in self.levels if run]

    def merge(self, one: DataFrame, other: DataFrame) -> DataFrame:
        """The entries of two tables of entries, one for each key."""
        side = lambda t, x: t.select(*KEY, F.struct("rows", F.struct(*_ENTRY[1:]).alias("keep")).alias(x))
        met = side(one, "one").join(side(other, "other"), KEY, "full_outer")
        rows = F.coalesce("one.rows", F.lit(0)) + F.coalesce("other.rows", F.lit(0))
        return met.select(*KEY, rows.alias("rows"), self.better("one.keep", "other.keep").alias("keep")).select(*KEY, "rows", "keep.*")

    def entries(self) -> DataFrame:
        """The entry of every key, merged on reading."""
        return reduce(self.merge, (self.spark.table(r.name) for r in self.runs()))

    def hits(self) -> DataFrame | None:
        """Entries of keys with several rows; None for an index without a run."""
        runs, parts = self.runs(), []
        for run in runs:
            rows = self.spark.table(run.name).withColumn("_other", F.lit(False))
            for other in runs:
                if other is not run:
                    rows = maybe_in(rows, F.struct(*KEY), other.filter).withColumn("_other", F.col("_other") | F.col("_maybe")).drop("_maybe")
            parts.append(rows.filter("rows > 1 OR _other").select(*KEY, *_ENTRY))
        return reduce(self.merge, parts).filter("rows > 1") if parts else None

    def log(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.logs)

    def collisions(self, hits: DataFrame, known: Filter) -> DataFrame:
        """Keys of hits that stand for more than one text, by the whole bytes of all rows."""
        every = reduce(DataFrame.unionByName, (s.docs.select(_text(s.text_col).alias("text")) for s in self.sources)).select("text", *self.keyed(F.col("text")))
        maybe = maybe_in(every, F.struct(*KEY), known).filter("_maybe")
        different = maybe.groupBy(*KEY, "text").agg(F.lit(1).alias("one")).groupBy(*KEY).agg(F.sum("one").alias("texts")).filter("texts > 1")
        return different.join(small_side(hits.select(*KEY)), KEY, "left_semi").select(*KEY)

    def told_apart(self, collided: DataFrame) -> DataFrame:
        """(doc_id, batch, text, nth, key) of the rows of collided keys, few as these are."""
        parts = []
        for batch, source in enumerate(self.sources):
            text = _text(source.text_col)
            parts.append(source.docs.select(F.col(f"`{source.id_col}`").cast("long").alias("doc_id"), F.lit(batch).alias("batch"), text.alias("text"), *self.keyed(text)))
        rows = reduce(DataFrame.unionByName, parts).join(small_side(collided), KEY, "left_semi")
        return scratch(rows.withColumn("nth", F.monotonically_increasing_id()), "lsm-collided")

    def verified(self) -> tuple[DataFrame, DataFrame]:
        """(hits, their keys that stand for different texts)."""
        found = self.hits()
        if found is None:
            found = self.spark.createDataFrame([], "digest string, second long, bytes int, rows long, keep_none boolean, keep_id long, keep_batch int, keep_row long")
        hits = scratch(found, "lsm-hits")
        return hits, scratch(self.collisions(hits, membership_filter(hits, F.struct(*KEY))), "lsm-collisions")

    def texts(self, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows, groups) of keys that are told apart by text: the rows (doc_id, batch, text, nth, key)
        of all tables, and by key and text their number and the best."""
        rows = self.told_apart(keys)
        one = F.struct(self.none(F.col("doc_id")).alias("none"), "doc_id", "batch", "nth")
        return rows, rows.groupBy(*KEY, "text").agg(F.count(F.lit(1)).alias("group_size"), self.best(one).alias("best"))

    def classify(self) -> DataFrame:
        """(doc_id, batch, keep_id, group_size, kept, digest): one row per row that was added."""
        hits, collided = self.verified()
        alone = F.col("rows").isNull()
        same = (F.col("batch") == F.col("keep_batch")) & (F.col("row") == F.col("keep_row"))
        keyed = self.log().join(small_side(hits), KEY, "left").select(
            "doc_id",
            "batch",
            F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"),
            (alone | same).alias("kept"),
            *KEY,
        )
        if collided.isEmpty():
            return keyed.drop("second", "bytes")
        apart, groups = self.texts(collided)
        texts = apart.join(groups, [*KEY, "text"]).select("doc_id", "batch", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("nth") == F.col("best.nth")).alias("kept"), "digest")
        return keyed.join(small_side(collided), KEY, "left_anti").drop("second", "bytes").unionByName(texts)

    def deduplicate(self) -> DataFrame:
        """The rows of the last table added that stay over all tables, with all their columns. Texts
        that the filter clears of being met again pass without a shuffle."""
        source, batch = self.sources[-1], len(self.sources) - 1
        hits, collided = self.verified()
        # Keys whose kept id does not name one row: it occurs again, or the key has different texts.
        kept = self.logs[-1].join(small_side(hits), KEY).filter((F.col("keep_batch") == batch) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
        vague = scratch(kept.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*KEY).unionByName(collided).distinct(), "lsm-vague")
        names, text = source.docs.columns, _text(source.text_col)
        packed = source.docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), F.col(f"`{source.id_col}`").cast("long").alias("_id"), text.alias("_text"), *self.keyed(text))
        marked = maybe_in(packed, F.struct(*KEY), membership_filter(hits, F.struct(*KEY)))
        clear = marked.filter(~F.col("_maybe")).select("_row")
        again = small_side(hits.select(*KEY, "keep_id", "keep_batch"))
        unclear = marked.filter("_maybe").join(again, KEY, "left").join(small_side(vague.withColumn("_vague", F.lit(True))), KEY, "left")
        stays = F.col("keep_batch").isNull() | (F.col("_vague").isNull() & (F.col("keep_batch") == batch) & F.col("_id").eqNullSafe(F.col("keep_id")))
        rows = clear.unionByName(unclear.filter(stays).select("_row"))
        if not vague.isEmpty():
            groups = unclear.filter("_vague").groupBy(*KEY, "_text").agg(self._first("_id").alias("_row"))
            if batch:
                _, best = self.texts(vague)
                groups = groups.join(best.filter(F.col("best.batch") == batch).withColumnRenamed("text", "_text"), [*KEY, "_text"], "left_semi")
            rows = rows.unionByName(groups.select("_row"))
        return rows.select(*[F.col("_row").getField(n).alias(n) for n in names])

    def _first(self, id_col: str) -> Column:
        by = F.min_by if self.best is F.min else F.max_by
        return by("_row", F.struct(self.none(F.col(id_col)), F.col(id_col)))


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> Index:
    """A new index of a table; settings are those of Index."""
    made = Index(docs.sparkSession, **settings)
    made.add(docs, id_col, text_col)
    return made


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest): one row per row of docs."""
    return index(docs, id_col, text_col, **settings).classify().drop("batch")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    return index(docs, id_col, text_col, **settings).deduplicate()
