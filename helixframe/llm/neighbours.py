"""Approximate nearest neighbours over learned partitions.

On a bounded sample a neighbour graph is built and cut into balanced parts (spectral bisection with
median splits, so parts differ by one vector at most). A small softmax classifier learns the parts
of a vector's neighbours. It puts every vector of the table into its most probable part and routes
a query to its several most probable parts, whose vectors are then compared exactly. The number of
parts grows with the square root of the table as far as the sample can tell parts apart; how many
are probed is measured: as few as find `RECALL` of the neighbours of sampled vectors that the
classifier was not fitted on.

Equal vectors are one entry with their smallest k + 1 ids: no list of k neighbours can hold more of
them. A part is as many blocks as its size asks for. Each vector goes to one block; the queries, the
smaller side, go to all blocks of their parts and stream past the block that a task holds.

Cases: rows whose vector is null or zero, or holds a null or non-finite number, take no part, nor do
rows with a null id; vectors of several lengths are searched apart, as an inner product asks for one
length, and all but the most frequent length without an index; repeated rows (same id, same vector)
count once; an id with several vectors is a row for each of them, no row of a query's id is among its
neighbours, and a query id with several vectors has a list for each; ties go to the smaller id; with few vectors all are compared; an empty table gives an
empty result; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.llm._common import record_batch, small_side
from helixframe.storage import scratch

#: Bound of the sample that the index is fitted on, and its share that only measures the recall.
SAMPLE_ROWS, MEASURED = 4096, 8
#: Sampled vectors that a part needs, neighbours in the graph, and the recall that probes must reach.
PART_ROWS, GRAPH_NEIGHBOURS, RECALL = 32, 16, 0.96
CANDIDATE_BLOCK, QUERY_BLOCK = 32768, 256
_STEPS, _RATE = 300, 0.5


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Symmetric 0/1 adjacency of the k largest inner products."""
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    near = np.argpartition(-sims, min(k, len(x) - 1) - 1, axis=1)[:, :k]
    graph = np.zeros(sims.shape, np.float32)
    np.put_along_axis(graph, near, 1, axis=1)
    return np.maximum(graph, graph.T)


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """Recursive bisection: nodes ordered by the second eigenvector, cut at the middle."""
    label = np.zeros(len(graph), np.int64)

    def split(nodes: np.ndarray, count: int, first: int) -> None:
        if count == 1 or len(nodes) < 2:
            label[nodes] = first
            return
        scaled = graph[np.ix_(nodes, nodes)]
        degree = np.maximum(scaled.sum(axis=1, dtype=np.float64), 1e-9)
        scaled *= (1 / np.sqrt(degree)).astype(np.float32)[:, None]
        scaled *= (1 / np.sqrt(degree)).astype(np.float32)[None, :]
        steady = np.sqrt(degree) / np.linalg.norm(np.sqrt(degree))
        v = np.random.default_rng(first + count).standard_normal(len(nodes))
        for _ in range(60):
            v = scaled @ v + v
            v -= steady * (steady @ v)
            v /= np.linalg.norm(v) + 1e-30
        order = nodes[np.argsort(v / np.sqrt(degree), kind="stable")]
        half = count // 2
        at = len(order) * half // count
        split(order[:at], half, first)
        split(order[at:], count - half, first + half)

    split(np.arange(len(graph)), parts, 0)
    return label


class Router:
    """Softmax over parts, linear in the scaled vector and its bias."""

    def __init__(self, weights: np.ndarray, width: int):
        self.weights, self.width = weights, width

    def logits(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        return np.hstack([unit, np.ones((len(x), 1))]) @ self.weights

    def order(self, x: np.ndarray, most: int) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :most]


def fit(x: np.ndarray, parts: int, k: int = GRAPH_NEIGHBOURS) -> Router:
    """Learns the share of each part among a vector's neighbours and itself."""
    width = x.shape[1]
    parts = max(1, min(parts, len(x) // PART_ROWS))
    if parts == 1:
        return Router(np.zeros((width + 1, 1)), width)
    graph = neighbour_graph(x, k)
    label = balanced_parts(graph, parts)
    one = np.eye(parts)[label]
    target = graph.astype(np.float64) @ one + k * one
    target /= target.sum(axis=1, keepdims=True)
    unit = np.hstack([x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300), np.ones((len(x), 1))])
    weights, speed = np.zeros((width + 1, parts)), np.zeros((width + 1, parts))
    for _ in range(_STEPS):
        z = unit @ weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed - _RATE * 10 * (unit.T @ (p - target) / len(x) + 1e-6 * weights)
        weights += speed
    return Router(weights, width)


def probes_for(router: Router, known: np.ndarray, unseen: np.ndarray, k: int, recall: float) -> int:
    """The fewest probes that find this share of the k nearest known vectors of the unseen ones."""
    parts = router.weights.shape[1]
    if parts == 1 or not len(unseen):
        return parts
    home = router.order(known, 1)[:, 0]
    route = np.argsort(router.order(unseen, parts), axis=1)  # the place of each part on a vector's route
    sims = unseen @ known.T
    near = np.argpartition(-sims, min(k, len(known)) - 1, axis=1)[:, :k]
    places = np.sort(np.take_along_axis(route, home[near], axis=1), axis=None)
    return int(places[min(len(places), int(np.ceil(recall * len(places)))) - 1]) + 1


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector, h, g) of rows that take part, vectors in double precision; h and g are two
    hashes that stand for the vector."""
    bad = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    clean = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")).filter("vec_id IS NOT NULL AND vector IS NOT NULL")
    # -0.0 and 0.0 are one number
    plain = clean.filter(~bad & F.exists("vector", lambda v: v != 0)).withColumn("vector", F.transform("vector", lambda v: v + F.lit(0.0)))
    return plain.withColumns({"h": F.xxhash64("vector"), "g": F.xxhash64(F.lit(1), "vector")})


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _routed(held, most: int, names: list[str]):
    """The named columns with parts: the most probable ones of a vector, or for a length without an
    index the part that stands for the length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = held.value
        for batch in batches:
            vectors = batch.column("vector")
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
            parts = [[-int(n)] for n in lengths]
            own = np.flatnonzero(lengths == router.width)
            if len(own):
                for i, route in zip(own.tolist(), router.order(_matrix(vectors.take(pa.array(own))), most).tolist(), strict=True):
                    parts[i] = route
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(parts, pa.list_(pa.int32()))], names=[*names, "parts"])

    return run


def _best(x: np.ndarray, first: np.ndarray, alone: np.ndarray, ids: list[list[int]], q: np.ndarray, own: list, keep: int) -> Iterator[list[tuple[float, int]]]:
    """For each query the `keep` best (-score, id) among a block's vectors, without the query's own
    id if it is told."""
    sims, most = q @ x.T, min(keep, len(x))
    for row, mine in zip(sims, own, strict=True):
        if mine is not None:
            row[alone & (first == mine)] = -np.inf  # entries of no other id
    # All within rounding of the last of the best: ties are for the exact order.
    slack = 1e-12 * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
    floors = np.partition(sims, len(x) - most, axis=1)[:, len(x) - most] - slack
    for row, s, floor, mine in zip(q, sims, floors, own, strict=True):
        near = np.flatnonzero((s >= floor) & (s > -np.inf))
        exact = (x[near] * row).sum(axis=1)
        # Of equal scores, the entries with the smallest first ids hold the smallest ids.
        at = np.lexsort((first[near], -exact))[:keep]
        yield sorted((-score, i) for score, e in zip(exact[at].tolist(), near[at].tolist(), strict=True) for i in ids[e] if i != mine)[:keep]


#: What names a query: the two hashes of its vector, and its id if that is to be left out while comparing.
QUERY = ("qh", "qg", "own")


def _compared(keep: int):
    schema = pa.schema([("qh", pa.int64()), ("qg", pa.int64()), ("own", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, x = None, [], None
        first = alone = ids = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(n).to_numpy() for n in ("part", "cb", "query")])
            bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for low, high in zip(bounds, bounds[1:], strict=False):
                part = batch.slice(low, high - low)
                if (here := tuple(keys[low, :2])) != block:
                    block, held, x = here, [], None
                if not keys[low, 2]:
                    held.append((_matrix(part.column("vector")), part.column("ids").to_pylist()))
                    continue
                if x is None:
                    x = np.concatenate([v for v, _ in held])
                    ids = [i for _, own in held for i in own]
                    first, alone, held = np.array([i[0] for i in ids]), np.array([len(i) == 1 for i in ids]), []
                for at in range(0, part.num_rows, QUERY_BLOCK):
                    some = part.slice(at, QUERY_BLOCK)
                    names, out = list(zip(*(some.column(n).to_pylist() for n in QUERY), strict=True)), []
                    for name, best in zip(names, _best(x, first, alone, ids, _matrix(some.column("vector")), [n[2] for n in names], keep), strict=True):
                        out += [(*name, i, -score) for score, i in best]
                    yield record_batch(out, schema)

    return run


def search(rows: DataFrame, is_query: Callable[[Column], Column], k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", parts: int | None = None, probes: int | None = None, recall: float = RECALL, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that is_query (a function of the id column)
    marks, its k nearest other rows by inner product. parts and probes follow the table and the
    wanted recall unless they are given."""
    spark = rows.sparkSession
    vectors = scratch(usable(rows, id_col, vector_col), "ann-vectors")
    ids = vectors.select("h", "g", "vec_id").distinct()
    nth = F.row_number().over(W.partitionBy("h", "g").orderBy("vec_id"))
    least = ids.withColumn("nth", nth).filter(F.col("nth") <= k + 1).groupBy("h", "g").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = scratch(vectors.groupBy("h", "g").agg(F.first("vector").alias("vector")).join(least, ["h", "g"]), "ann-entries")
    count = entries.count()
    sample = entries.orderBy("h", "g").limit(sample_rows).select("vector").toArrow().column("vector").to_pylist()
    widths = np.array([len(v) for v in sample] or [1])
    width = int(np.bincount(widths).argmax())
    x = np.array([v for v in sample if len(v) == width], float).reshape(-1, width)
    known, unseen = x[len(x) // MEASURED :], x[: len(x) // MEASURED]
    router = fit(known, parts or max(1, int(count**0.5))) if len(x) else Router(np.zeros((width + 1, 1)), width)
    probes = min(probes or probes_for(router, known, unseen, k, recall), router.weights.shape[1])
    held = spark.sparkContext.broadcast(router)

    names = ["h", "g", "vector", "ids"]
    ddl = "h long, g long, vector array<double>, ids array<long>, parts array<int>"
    indexed = scratch(entries.select(*names).mapInArrow(_routed(held, 1, names), ddl).withColumn("part", F.col("parts")[0]).drop("parts"), "ann-index")
    # Equal vectors ask once. Ids with several vectors ask for themselves, as their other vectors must
    # not take the places of neighbours.
    rows = ids.filter(is_query(F.col("vec_id")))
    several = rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("vec_id", F.col("vec_id").alias("own"))
    asked = scratch(rows.join(several, "vec_id", "left").select("h", "g", "vec_id", "own"), "ann-asked")
    names = scratch(asked.select("h", "g", "own").distinct(), "ann-names")
    asking = entries.join(small_side(names), ["h", "g"]).select(F.col("h").alias("qh"), F.col("g").alias("qg"), "own", "vector")
    routed = asking.mapInArrow(_routed(held, probes, [*QUERY, "vector"]), "qh long, qg long, own long, vector array<double>, parts array<int>").select(*QUERY, "vector", F.explode("parts").alias("part"))
    sizes = scratch(indexed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / CANDIDATE_BLOCK).cast("int").alias("blocks")), "ann-sizes")
    none = F.lit(None).cast("long")
    left = indexed.join(small_side(sizes), "part").select("part", F.pmod(F.col("h"), F.col("blocks")).cast("int").alias("cb"), F.lit(0).alias("query"), "vector", "ids", *[none.alias(n) for n in QUERY])
    right = routed.join(small_side(sizes), "part").select("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("cb"), F.lit(1).alias("query"), "vector", F.lit(None).cast("array<long>").alias("ids"), *QUERY)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // CANDIDATE_BLOCK))
    met = left.unionByName(right).repartition(tasks, "part", "cb").sortWithinPartitions("part", "cb", "query").mapInArrow(_compared(k + 1), "qh long, qg long, own long, vec_id long, score double")

    order = [F.desc("score"), F.asc("vec_id")]
    best = met.withColumn("nth", F.row_number().over(W.partitionBy(*QUERY).orderBy(*order))).filter(F.col("nth") <= k + 1)
    queries = asked.select(F.col("vec_id").alias("query_id"), F.col("h").alias("h_q"), F.col("g").alias("g_q"), F.col("own").alias("own_q"))
    same = (F.col("qh") == F.col("h_q")) & (F.col("qg") == F.col("g_q")) & F.col("own").eqNullSafe(F.col("own_q"))
    answers = queries.join(best.select(*QUERY, "vec_id", "score"), same).filter("query_id <> vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(W.partitionBy("query_id", "h_q", "g_q").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
