"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is mapped to the bit counts of its 32 two-bit segments. Each bit that differs moves
one count by at most one, so the Manhattan distance of two embeddings is a lower bound of the
Hamming distance. A range join of radius 3 over 32 dimensions is cut in two halves of 16: if the
whole distance is at most 3, one half is within 1. Each half is a grid of cells one count wide;
the cells within distance 1 are the home cell and its direct neighbours. Two cells at distance 1
have count sums of different parity, so only fingerprints of even sum visit neighbours. Pairs that meet
in a cell are within the bound in that half; whether they are links is told bit by bit.

Links are found between different fingerprints (copies share one), and components by alternating
large-star and small-star steps, all as DataFrames.

Cases: null and empty texts have fingerprint zero and link like any other; rows with a null id get
their fingerprint and the component of the ids they share it with (null if there are none);
repeated rows are returned as often as they occur; very long texts are hashed whole, in blocks of
shingles; an empty table gives an empty result; other columns are never looked at.

`near_copies` is for corpora: it links texts by the share of their word shingles. A SimHash distance
gives no bound on that share, so fingerprint links are only its first candidates. The others come
from a complete filter. All texts put their shingles in one order, the frequent last; two texts of
the wanted similarity have one of their first few in common, as each differs from the other in
fewer. A candidate is then held against its parity sketch: a text's shingles are dealt by hash to
bits, each the parity of what it got, so the bits that differ are never more than the shingles that
do. What is left, hardly more than the links, is verified on the whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm._common import chunks, column_rows, keep_rows_not_in, key_id, maybe_in, membership_filter, narrow, record_batch, resident, row_key, small_side
from helixframe.llm.components import connected_components
from helixframe.storage import release, scratch

#: Bits that may differ between linked fingerprints; the split in two halves holds for 3.
RADIUS = 3
SHINGLE = 3
SEED = 42
_BLOCK = 1 << 15  # shingles whose bits are counted at once
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
#: Words of a shingle and share of common shingles from which texts are near copies.
WIDTH, SIMILARITY = 5, 0.8
#: Most frequent shingles that the common order puts last (a broadcast of 16 bytes each), and the
#: shingles in which a task looks for repeated ones at once. Both cost time only, never links.
FREQUENT, _LOOK = 1 << 18, 1 << 21
#: Turns in which the rows of a bucket are held against one of them, before all of different components are.
STARS = 2
#: Rows of a bucket up to which its pairs are told wherever they meet; in larger ones each in one bucket.
FEW_ROWS = 16
_COUNTS = 0x55555555  # the low bit of each two-bit segment of a half


def _hashes(words: list[bytes], width: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of more than `width` words, in blocks."""
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: len(words) - width] + 1)).tolist()
    stops = ends[width - 1 :].tolist()
    for low in range(0, len(starts), _BLOCK):
        part = zip(starts[low : low + _BLOCK], stops[low : low + _BLOCK], strict=True)
        yield np.fromiter((digest(joined[a:b], seed) for a, b in part), np.uint64, min(_BLOCK, len(starts) - low))


def _majority(blocks: Iterator[np.ndarray], total: int) -> int:
    ones = np.zeros(64, np.int64)
    for hashes in blocks:
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of the word shingles, repeats included; zero without a word."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    return _majority(_hashes(words, width, seed), len(words) - width + 1)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    resident("simhash", tuple)  # lets go of what other operators kept
    for batch in batches:
        for rows in chunks(column_rows(batch, ["doc_id", "text"]), 4096):
            out = [(doc_id, x - (1 << 64) if (x := fingerprint(text)) >> 63 else x) for doc_id, text in rows]
            yield record_batch(out, _SCHEMA)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per document, fp as a signed 64-bit number."""
    texts = narrow(docs, doc_id=F.col(id_col).cast("long"), text=F.col(text_col))
    return texts.mapInArrow(_fingerprints, "doc_id long, fp long")


def links(prints: DataFrame) -> DataFrame:
    """(a, b): pairs of different fingerprints (column fp, each once) at RADIUS bits or fewer."""
    halves = prints.selectExpr(
        "fp", "explode(array(struct(0 AS half, shiftrightunsigned(fp, 32) AS bits), struct(1 AS half, fp & 4294967295L AS bits))) AS h"
    ).selectExpr("fp", "h.half", "h.bits", f"h.bits - (shiftright(h.bits, 1) & {_COUNTS}L) AS cell")
    neighbours = """filter(flatten(transform(sequence(0, 15), s -> array(
        if((shiftrightunsigned(cell, 2 * s) & 3L) < 2, cell + shiftleft(1L, 2 * s), -1L),
        if((shiftrightunsigned(cell, 2 * s) & 3L) > 0, cell - shiftleft(1L, 2 * s), -1L)))), x -> x >= 0)"""
    visits = halves.selectExpr("fp AS a", "half", f"explode(if(bit_count(bits) % 2 = 0, concat(array(cell), {neighbours}), array(cell))) AS at", "cell AS home")
    homes = halves.selectExpr("fp AS b", "half AS half_b", "cell AS cell_b")
    met = visits.join(homes, (F.col("half") == F.col("half_b")) & (F.col("at") == F.col("cell_b")) & ((F.col("at") != F.col("home")) | (F.col("a") < F.col("b"))) & (F.expr(f"bit_count(a ^ b) <= {RADIUS}")))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per document: 16 hexadecimal digits, and the
    smallest id that links reach, the row's own included."""
    prints = scratch(fingerprints(docs, id_col, text_col), "simhash-prints")
    classes = scratch(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    roots = connected_components(links(classes.select("fp"))).select(F.col("node").alias("fp"), "root")
    rooted = classes.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(firsts, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def all_shingles(text: str | None, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """Hashes of the word shingles, repeats included; a text of fewer words is one, none without a word."""
    words = (text or "").encode("utf-8").lower().split()
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else [], np.uint64)
    return np.concatenate(list(_hashes(words, width, seed)))


def shingles(text: str | None, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """Sorted hashes of the different word shingles."""
    return np.unique(all_shingles(text, width, seed))


class Order:
    """The common order of shingles: those that are not known as frequent by their hash, then the
    frequent by their count."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        by_hash = np.argsort(hashes)
        self.hashes, self.counts = hashes[by_hash], counts[by_hash]

    def first(self, own: np.ndarray, many: int) -> np.ndarray:
        """The first of sorted different shingles."""
        ranks = np.zeros(len(own), np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
            ranks = np.where(self.hashes[at] == own, self.counts[at], 0)
        return own[np.lexsort((own, ranks))[:many]]


def marks(own: np.ndarray, order: Order, similarity: float = SIMILARITY) -> np.ndarray:
    """Sets of this similarity or more share a mark: they have at least that share of either's
    shingles in common, so neither's first few can all be missing from the other."""
    n = len(own)
    return order.first(own, n - ceil(similarity * n - 1e-9) + 1) if n else np.zeros(1, np.uint64)


def parity_sketch(own: np.ndarray) -> np.ndarray:
    """Two to four bits for each shingle, a power of two of words: each the parity of the shingles that
    fall on it. The halves of a sketch, by exclusive or, are the sketch of half the size."""
    words = 1 << max(0, ceil(len(own) / 32) - 1).bit_length()
    sums = np.bincount((own % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(sums.astype(np.uint8), bitorder="little").view("<i8")


def _repeated(width: int):
    """Shingles that more than one of the texts looked at together has, with how many."""
    schema = pa.schema([("hash", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident("simhash-order", tuple)
        held: list[np.ndarray] = []
        size = 0

        def found() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            many = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(hashes[many].view(np.int64)), pa.array(counts[many].astype(np.int64))], schema=schema)

        for batch in batches:
            for (text,) in column_rows(batch, ["text"]):
                held.append(shingles(text, width))
                size += len(held[-1])
                if size >= _LOOK:
                    yield found()
                    held, size = [], 0
        yield found()

    return run


def common_order(texts: DataFrame, width: int = WIDTH, most: int = FREQUENT) -> Order:
    """The order for the texts of a column text: the `most` frequent of what tasks found repeated."""
    counted = texts.select("text").mapInArrow(_repeated(width), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).filter("n > 2")
    top = counted.orderBy(F.desc("n"), "hash").limit(most).toArrow()
    return Order(top.column("hash").to_numpy().view(np.uint64), top.column("n").to_numpy())


_SIGNS = "node long, key string, n int, fp long, sketch array<long>, marks array<long>"


def _signs(order, similarity: float, width: int):
    schema = pa.schema([("node", pa.int64()), ("key", pa.string()), ("n", pa.int32()), ("fp", pa.int64()), ("sketch", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident("simhash", tuple)
        node, common = TaskContext.get().partitionId() << 33, order.value
        for batch in batches:
            for rows in chunks(column_rows(batch, ["key", "text"]), 512):
                out = []
                for key, text in rows:
                    every = all_shingles(text, width)
                    own = np.unique(every)
                    fp = _majority((every[low : low + _BLOCK] for low in range(0, len(every), _BLOCK)), len(every))
                    out.append((node, key, len(own), fp - (1 << 64) if fp >> 63 else fp, parity_sketch(own), marks(own, common, similarity).view(np.int64)))
                    node += 1
                yield record_batch(out, schema)

    return run


def _alike(similarity: float, width: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident("simhash", tuple)
        last, own = None, None
        for batch in batches:
            out = []
            for a, b, text_a, text_b in column_rows(batch, ["a", "b", "text_a", "text_b"]):
                if last != text_a or own is None:
                    last, own = text_a, shingles(text_a, width)
                other = shingles(text_b, width)
                common = len(np.intersect1d(own, other, assume_unique=True))
                if common >= similarity * (len(own) + len(other) - common) - 1e-9:
                    out.append((a, b))
            yield record_batch(out, schema)

    return run


def _sketches_allow(similarity: float) -> Column:
    """Whether sets of n_a and n_b shingles with sketches sketch_a and sketch_b may be as similar."""
    half = "transform(sequence(1, size({0}) div 2), i -> {0}[i - 1] ^ {0}[i - 1 + size({0}) div 2])"
    folded = lambda x, y: f"if(size({x}) > size({y}), {half.format(x)}, {x})"
    differ = f"aggregate(zip_with({folded('sketch_a', 'sketch_b')}, {folded('sketch_b', 'sketch_a')}, (x, y) -> bit_count(x ^ y)), 0, (sum, x) -> sum + x)"
    return F.expr(f"least(n_a, n_b) >= {similarity} * greatest(n_a, n_b) - 1e-9") & (F.expr(differ) <= (1 - similarity) / (1 + similarity) * (F.col("n_a") + F.col("n_b")) + 1e-9)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, width: int = WIDTH, frequent: int = FREQUENT) -> DataFrame:
    """(key, kept): the row_key of each row that links join to another, and that of the row of its
    component with the smallest id, a null id last. Links are all pairs of texts whose sets of
    `width`-word shingles have at least `similarity` of their union in common."""
    keyed = narrow(docs, key=row_key(F.col(id_col), F.col(text_col)), text=F.col(text_col))
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(common_order(keyed, width, frequent))
    signs = scratch(keyed.mapInArrow(_signs(order, similarity, width), _SIGNS), "near-signs")
    pair = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    # Rows of one text are linked without a look at it, and one of them stands for all.
    digest = F.split_part("key", F.lit(":"), F.lit(2))
    texts = signs.select("node", digest.alias("digest"))
    again = scratch(texts.groupBy("digest").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("digest", "lead"), "near-again")
    same = scratch(texts.join(small_side(again), "digest").filter("node <> lead").select(*pair("node", "lead")), "near-same")
    alone = signs
    if not same.isEmpty():
        alone = scratch(keep_rows_not_in(signs, F.col("node"), same.select("b"), "b"), "near-alone")

    each = alone.select("node", "n", F.explode("marks").alias("mark"))
    leads = scratch(each.groupBy("mark").agg(F.min("node").alias("lead"), F.max("node").alias("last")).filter("lead <> last").select("mark", "lead"), "near-leads")
    maybe = maybe_in(each, F.col("mark"), membership_filter(leads, F.col("mark"))).filter("_maybe").drop("_maybe")
    met = scratch(maybe.join(small_side(leads), "mark"), "near-met")
    # Many marks have the same rows, as those of one passage: one of them stands for all.
    alike = [F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64("node", F.lit(1))), F.min("node"), F.max("node"), F.count(F.lit(1))]
    sets = met.groupBy("mark").agg(*[x.alias(f"set{i}") for i, x in enumerate(alike)]).groupBy(*[f"set{i}" for i in range(len(alike))]).agg(F.min("mark").alias("mark")).select("mark")
    shared = scratch(met.join(small_side(scratch(sets, "near-sets")), "mark", "left_semi"), "near-shared")
    release(leads, met)

    prints = alone.select("node", "fp")
    firsts = scratch(prints.groupBy("fp").agg(F.min("node").alias("first")), "near-classes")
    twins = prints.join(firsts, "fp").filter("node <> first").select(*pair("node", "first"))
    close = links(firsts.select("fp")).join(firsts.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a").join(firsts.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b").select(*pair("x", "y"))

    def verified(pairs: DataFrame) -> DataFrame:
        """The links among pairs: first by sketches, then by the whole texts of what these allow."""
        side = lambda x: signs.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
        likely = scratch(pairs.join(side("a"), "a").join(side("b"), "b").filter(_sketches_allow(similarity)).select("a", "b"), "near-likely")
        nodes = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        settled = scratch(nodes, "near-nodes")
        keys = scratch(signs.select("node", "key").join(small_side(settled), "node"), "near-keys")
        some = maybe_in(keyed, F.col("key"), membership_filter(keys, F.col("key"))).filter("_maybe").drop("_maybe")
        wanted = scratch(some.dropDuplicates(["key"]).join(small_side(keys), "key").select("node", "text"), "near-texts")
        both = likely.join(wanted.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(wanted.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        found = scratch(both.select("a", "b", "text_a", "text_b").mapInArrow(_alike(similarity, width), "a long, b long"), "near-links")
        release(likely, settled, keys, wanted)
        return found

    # First each bucket's rows with its first one: large groups become one component.
    tried = scratch(shared.select(*pair("node", "lead")).unionByName(twins).unionByName(close).filter("a <> b").distinct(), "near-pairs")
    edges = verified(tried)

    def apart() -> DataFrame:
        """The rows of buckets that hold rows of different components, with these."""
        placed = shared.join(connected_components(edges), "node", "left").select("mark", "node", "n", F.coalesce("root", "node").alias("root"))
        mixed = placed.groupBy("mark").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("rows")).filter("low <> high").select("mark", "rows")
        return scratch(placed.join(mixed, "mark"), "near-open")

    # Then with others in turn, the same for all buckets that hold them.
    for turn in range(STARS):
        open_ = apart()
        leads = open_.groupBy("mark").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("at"), "node", "root")).alias("lead"))
        pairs = open_.join(leads, "mark").filter(F.col("root") != F.col("lead.root")).select(*pair(F.col("node"), F.col("lead.node"))).distinct()
        new = scratch(pairs.join(tried, ["a", "b"], "left_anti"), "near-pairs")
        release(open_)
        tried, edges = tried.unionByName(new), edges.unionByName(verified(new))

    # Last all of a bucket, alike in size, whose rows are still of different components; of a large
    # bucket, those that sketches allow, each pair in the first of the large buckets that it shares.
    level = F.floor(F.log(F.greatest("n", F.lit(1))) / -log(similarity) + 1e-9).cast("int")
    last = apart().withColumn("level", level)

    def met_in(rows: DataFrame, more: list[str], also: Column) -> DataFrame:
        columns = lambda x: [F.col("node").alias(x), *(F.col(n).alias(f"{n}_{x}") for n in ("n", "root", *more))]
        left = rows.select("mark", F.explode(F.array(F.col("level"), F.col("level") + 1)).alias("level"), F.col("level").alias("own"), *columns("a"))
        right = rows.select(F.col("mark").alias("there"), F.col("level").alias("level_b"), *columns("b"))
        once = (F.col("own") < F.col("level_b")) | (F.col("a") < F.col("b"))
        sizes = F.expr(f"least(n_a, n_b) >= {similarity} * greatest(n_a, n_b) - 1e-9")
        return left.join(right, (F.col("mark") == F.col("there")) & (F.col("level") == F.col("level_b")) & (F.col("root_a") != F.col("root_b")) & once & sizes & also).select(*pair("a", "b"))

    large = last.filter(F.col("rows") > FEW_ROWS)
    of_row = large.groupBy("node").agg(F.collect_set("mark").alias("marks")).join(signs.select("node", "sketch"), "node")
    here = F.array_min(F.array_intersect("marks_a", "marks_b")) == F.col("mark")
    told = met_in(last.filter(F.col("rows") <= FEW_ROWS), [], F.lit(True)).unionByName(met_in(large.join(of_row, "node"), ["sketch", "marks"], _sketches_allow(similarity) & here))
    rest = told.distinct().join(tried, ["a", "b"], "left_anti")
    more = verified(scratch(rest, "near-rest"))
    ends = connected_components(edges.unionByName(more).unionByName(same))
    named = scratch(ends.join(signs.select("node", "key"), "node"), "near-named")
    number = key_id(F.col("key"))
    kept = named.groupBy("root").agg(F.min_by("key", F.struct(number.isNull().alias("none"), number.alias("number"), F.col("key"))).alias("kept"))
    return named.join(kept, "root").select("key", "kept").distinct()
