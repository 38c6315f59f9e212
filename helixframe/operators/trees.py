"""Alignments and trees of families of sequences.

A clustering of a small family is one task, that of a large one goes by rounds over all tasks; what is
read off a tree takes its merges, some numbers a sequence. Alignments go by rounds of tree pieces, and
sites of an alignment are scored in blocks, each with the merges. Neighbour joining alone is one task a
family, whose size is that of a sample."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.functions.text import fit_length, letters
from helixframe.kernels import linkage, trees
from helixframe.operators import agglomerate, progressive
from helixframe.schemas import ALPHABET, KMER

#: Sites that a sampled likelihood has, about, and sites that are scored together.
SITES, SITE_BLOCK = 200, 64


def profile_distances(seqs: list[str], k: int = KMER) -> np.ndarray:
    """Jensen-Shannon divergences of k-mer profiles, to twelve decimals so that equal profiles tie; 1 for
    sequences shorter than k, 0 on the diagonal."""
    grams = [[s[i : i + k] for i in range(len(s) - k + 1)] for s in seqs]
    known = {g: n for n, g in enumerate(sorted(set().union(*grams)))} if grams else {}
    p = np.zeros((len(seqs), max(1, len(known))))
    for row, own in zip(p, grams, strict=True):
        np.add.at(row, [known[g] for g in own], 1 / max(1, len(own)))
    out = np.zeros((len(seqs), len(seqs)))
    for i in range(len(seqs)):
        m = (p[i] + p[i + 1 :]) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            a, b = np.where(p[i] > 0, p[i] * np.log2(p[i] / m), 0), np.where(p[i + 1 :] > 0, p[i + 1 :] * np.log2(p[i + 1 :] / m), 0)
        out[i, i + 1 :] = np.maximum(0, (a + b).sum(axis=1) / 2)
        for j in range(i + 1, len(seqs)):
            if not grams[i] or not grams[j]:
                out[i, j] = 1.0
    return np.round(out + out.T, 12)


def _ordered(frame: pd.DataFrame) -> tuple[list[str], list[str]]:
    frame = frame.sort_values(["pos", "seq_id"])
    return frame["seq_id"].tolist(), frame["seq"].tolist()


def _per_family(seqs: DataFrame, function, schema: str) -> DataFrame:
    """seqs has family, pos, seq_id, seq."""
    return seqs.select("family", "pos", "seq_id", "seq").groupBy("family").applyInPandas(function, schema)


def in_order(seqs: DataFrame) -> DataFrame:
    """(family, seq_id, row, seq): the sequences of each family counted from 0, by position and id."""
    nth = F.row_number().over(W.partitionBy("family").orderBy("pos", "seq_id")) - 1
    return seqs.select("family", "seq_id", nth.cast("long").alias("row"), "seq")


def distance_rows(ordered: DataFrame, k: int = KMER) -> DataFrame:
    """(node, row): the divergence of each sequence (row, seq) of a family to all, as profile_distances
    has them. Only words that two sequences share are joined; the rest of a row is 1."""
    total = F.length("seq") - k + 1
    grams = ordered.select("row", F.explode(F.regexp_extract_all("seq", F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))).alias("kmer")).groupBy("row", "kmer").agg(F.count(F.lit(1)).alias("n"))
    p = grams.join(ordered.select("row", total.alias("total")), "row").select("row", "kmer", (F.col("n") / F.col("total")).alias("p"))
    mean = (F.col("p") + F.col("q")) / 2
    part = F.col("p") * F.log2(F.col("p") / mean) + F.col("q") * F.log2(F.col("q") / mean) - F.col("p") - F.col("q")
    met = p.join(p.select(F.col("row").alias("other"), "kmer", F.col("p").alias("q")), "kmer").filter("row < other")
    pairs = met.groupBy("row", "other").agg(F.round(F.greatest(F.lit(0.0), 1 + F.sum(part) / 2), 12).alias("d"))
    both = pairs.select("row", F.struct("other", "d").alias("x")).unionByName(pairs.select(F.col("other").alias("row"), F.struct(F.col("row").alias("other"), "d").alias("x")))
    held = ordered.select("row").join(both.groupBy("row").agg(F.collect_list("x").alias("xs")), "row", "left")
    n = ordered.count()

    def filled(frames):
        for frame in frames:
            rows = []
            for node, xs in zip(frame["row"], frame["xs"], strict=True):
                row = np.ones(n)
                row[node] = 0
                for x in xs if xs is not None else ():
                    row[x["other"]] = x["d"]
                rows.append(row)
            yield pd.DataFrame({"node": frame["row"], "row": rows})

    return held.mapInPandas(filled, "node long, row array<double>")


_MERGES = "family string, step long, left long, right long, distance double, size long"


def merge_table(seqs: DataFrame, method: str = "average", last: int = agglomerate.LAST) -> DataFrame:
    """(family, step, left, right, distance, size) of the clustering by k-mer divergence. Families of up
    to `last` sequences are a task each; larger ones are clustered one after the other, each by rounds
    over all tasks."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        _, rows = _ordered(frame)
        out = pd.DataFrame(linkage.linkage(profile_distances(rows), method), columns=["left", "right", "distance", "size"])
        out.insert(0, "step", range(len(out)))
        out.insert(0, "family", frame["family"].iloc[0])
        return out.astype({"left": int, "right": int, "size": int})

    large = [r.family for r in seqs.groupBy("family").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > last).select("family").collect()]
    out = _per_family(seqs.filter(~F.col("family").isin(large)) if large else seqs, run, _MERGES)
    for family in large:
        own = in_order(seqs.filter(F.col("family") == family))
        merges = agglomerate.agglomerate(distance_rows(own), method, last)
        out = out.unionByName(seqs.sparkSession.createDataFrame([(family, k, int(a), int(b), float(g), int(n)) for k, (a, b, g, n) in enumerate(merges)], _MERGES))
    return out


def _of_merges(seqs: DataFrame, method: str, function, schema: str, last: int) -> DataFrame:
    """What a function of (family, ids, merges) makes of each family: some numbers and the id of a
    sequence lie together, their letters do not."""
    ids = in_order(seqs).select("family", "row", "seq_id", *[F.lit(None).cast(t).alias(c) for c, t in (("left", "long"), ("right", "long"), ("distance", "double"), ("size", "long"))])
    merges = merge_table(seqs, method, last).select("family", F.col("step").alias("row"), F.lit(None).cast("string").alias("seq_id"), "left", "right", "distance", "size")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row")
        tree = frame[frame["seq_id"].isna()]
        return function(frame["family"].iloc[0], frame["seq_id"].dropna().tolist(), tree[["left", "right", "distance", "size"]].to_numpy(float))

    return ids.unionByName(merges).groupBy("family").applyInPandas(run, schema)


def newick(seqs: DataFrame, method: str = "nj", last: int = agglomerate.LAST) -> DataFrame:
    """(family, newick) by neighbour joining (a family is one task), or of a clustering ('average',
    'weighted')."""
    schema = "family string, newick string"
    if method != "nj":
        return _of_merges(seqs, method, lambda family, ids, merges: pd.DataFrame({"family": [family], "newick": [linkage.newick(merges, [i[:15] for i in ids])]}), schema, last)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        ids, rows = _ordered(frame)
        return pd.DataFrame({"family": [frame["family"].iloc[0]], "newick": [trees.neighbour_joining(profile_distances(rows), [i[:15] for i in ids])]})

    return _per_family(seqs, run, schema)


def align_family(seqs: DataFrame) -> DataFrame:
    """(family, seq_id, row, aligned): the progressive alignment along the average-linkage tree."""
    return progressive.align_families(in_order(seqs), merge_table(seqs))


def padded(ordered: DataFrame) -> DataFrame:
    """(family, row, aligned, width): every sequence cut or padded with gaps to its family's median length."""
    median = ordered.groupBy("family").agg(F.floor(F.median(F.length("seq"))).cast("int").alias("width"))
    return ordered.join(median, "family").select("family", "row", fit_length(F.col("seq"), F.col("width")).alias("aligned"), "width")


def site_scores(aligned: DataFrame, merges: DataFrame, about: int | None = SITES, block: int = SITE_BLOCK) -> DataFrame:
    """(family, site, changes, log_likelihood) of aligned rows (family, row, aligned, width) on a tree
    (family, step, left, right, distance): sites are dealt to tasks in blocks, each with the tree's
    merges. With `about`, the likelihood is that of every n-th site, about so many, and null for the
    others; without it, of all."""
    number = F.coalesce(F.nullif(F.instr(F.lit(ALPHABET + "-"), F.col("ch")), F.lit(0)) - 1, F.lit(len(ALPHABET) + 1))
    step = F.greatest(F.lit(1), F.floor(F.col("width") / about)) if about else F.lit(1)
    cells = aligned.select("family", "row", F.posexplode(letters(F.col("aligned"))).alias("site", "ch"), step.cast("int").alias("step"))
    cells = cells.select("family", F.floor(F.col("site") / block).cast("int").alias("block"), "site", "row", number.cast("int").alias("state"), (F.col("site") % F.col("step") == 0).alias("wanted"))
    blocks = aligned.groupBy("family").agg(F.first("width").alias("width")).filter("width > 0").select("family", F.explode(F.sequence(F.lit(0), F.floor((F.col("width") - 1) / block).cast("int"))).alias("block"))
    tree = merges.select("family", "step", "left", "right", "distance").join(blocks, "family")

    def run(own: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        states = own.pivot(index="row", columns="site", values="state").sort_index()
        sites = states.columns.to_numpy()
        numbers, order = states.to_numpy(np.int64), tree.sort_values("step")
        table = np.column_stack([order[["left", "right", "distance"]].to_numpy(float), np.zeros(len(order))])
        wanted = own.groupby("site")["wanted"].first().loc[sites].to_numpy(bool)
        lnl = np.full(len(sites), np.nan)
        if wanted.any():
            lnl[wanted] = trees.log_likelihood(table, np.where(numbers < len(ALPHABET), numbers, -1)[:, wanted])
        out = pd.DataFrame({"family": own["family"].iloc[0], "site": sites, "changes": trees.parsimony(table, np.int64(1) << numbers)})
        return out.assign(log_likelihood=pd.Series(lnl, dtype=object).where(~np.isnan(lnl), None))

    return cells.groupBy("family", "block").cogroup(tree.groupBy("family", "block")).applyInPandas(run, "family string, site int, changes long, log_likelihood double")


def tree_scores(seqs: DataFrame, about: int | None = SITES, last: int = agglomerate.LAST) -> DataFrame:
    """(family, topology, parsimony, log_likelihood, best_parsimony, best_likelihood) over padded
    sequences; a parsimony tie goes to UPGMA, a likelihood tie to WPGMA. The likelihood of sampled sites
    is scaled to all."""
    ordered = in_order(seqs)
    flat = padded(ordered)
    parts = []
    for topology, method in (("UPGMA", "average"), ("WPGMA", "weighted")):
        sums = site_scores(flat, merge_table(seqs, method, last), about).groupBy("family").agg(
            F.sum("changes").alias("parsimony"), F.coalesce(F.sum("log_likelihood") * F.count(F.lit(1)) / F.count("log_likelihood"), F.lit(0.0)).alias("log_likelihood")
        )
        none = {"parsimony": F.coalesce("parsimony", F.lit(0)), "log_likelihood": F.coalesce("log_likelihood", F.lit(0.0))}
        parts.append(seqs.select("family").distinct().join(sums, "family", "left").withColumns(none).select("family", F.lit(topology).alias("topology"), "parsimony", "log_likelihood"))
    scored = parts[0].unionByName(parts[1])
    best = scored.groupBy("family").agg(F.min_by("topology", F.struct("parsimony", "topology")).alias("p"), F.max_by("topology", F.struct("log_likelihood", "topology")).alias("l"))
    return scored.join(best, "family").select("family", "topology", "parsimony", "log_likelihood", (F.col("topology") == F.col("p")).alias("best_parsimony"), (F.col("topology") == F.col("l")).alias("best_likelihood"))


def tree_splits(seqs: DataFrame, method: str, last: int = agglomerate.LAST) -> DataFrame:
    """(family, leaves, split): non-trivial bipartitions of a clustering."""

    def found(family: str, ids: list[str], merges: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"family": family, "leaves": len(ids), "split": [",".join(map(str, s)) for s in sorted(linkage.splits(merges, len(ids)))]})

    return _of_merges(seqs, method, found, "family string, leaves int, split string", last)


def robinson_foulds(one: DataFrame, other: DataFrame) -> DataFrame:
    """(family, distance, normalised, shared, only_one, only_other) of two split tables."""
    a = one.select("family", "split", "leaves", F.lit(1).alias("in_one"))
    b = other.select("family", "split", F.col("leaves").alias("leaves_b"), F.lit(1).alias("in_other"))
    both = a.join(b, ["family", "split"], "full_outer").withColumn("leaves", F.coalesce("leaves", "leaves_b"))
    hit_a, hit_b = F.col("in_one").isNotNull(), F.col("in_other").isNotNull()
    n = lambda c: F.count(F.when(c, 1))
    sums = both.groupBy("family").agg(F.max("leaves").alias("leaves"), n(hit_a & hit_b).alias("shared"), n(hit_a & ~hit_b).alias("only_one"), n(hit_b & ~hit_a).alias("only_other"))
    distance = F.col("only_one") + F.col("only_other")
    most = F.greatest(2 * (F.col("leaves") - 3), F.lit(0))
    return sums.select("family", distance.alias("distance"), F.when(most > 0, distance / most).otherwise(F.lit(0.0)).alias("normalised"), "shared", "only_one", "only_other")


def site_parsimony(seqs: DataFrame, merges: list[tuple[int, int]]) -> DataFrame:
    """(site, changes) of aligned rows (row, aligned) on a given tree, sites in parallel and inside
    code generation: states are bit masks and the tree is folded by an aggregate."""
    cells = seqs.select("row", F.posexplode(F.split("aligned", "")).alias("site", "ch")).filter("ch <> ''")
    number = F.instr(F.lit(ALPHABET + "-"), F.col("ch")) - 1
    mask = cells.withColumn("mask", F.call_function("shiftleft", F.lit(1).cast("long"), number.cast("int")))
    columns = mask.groupBy("site").agg(F.transform(F.sort_array(F.collect_list(F.struct("row", "mask"))), lambda x: x["mask"]).alias("leaves"))
    tree = F.array(*[F.struct(F.lit(a).alias("l"), F.lit(b).alias("r")) for a, b in merges])
    start = F.struct(F.col("leaves").alias("nodes"), F.lit(0).alias("cost"))

    def step(acc, m):
        a, b = F.get(acc["nodes"], m["l"]), F.get(acc["nodes"], m["r"])
        both = a.bitwiseAND(b)
        return F.struct(F.concat(acc["nodes"], F.array(F.when(both != 0, both).otherwise(a.bitwiseOR(b)))).alias("nodes"), (acc["cost"] + F.when(both == 0, 1).otherwise(0)).alias("cost"))

    return columns.select("site", F.aggregate(tree, start, step, lambda acc: acc["cost"]).alias("changes"))


def jukes_cantor(times: DataFrame, states: int = 20) -> DataFrame:
    """(t, p_same, p_diff): chances of the same and of one other state after t."""
    fade = F.exp(-F.lit(float(states)) * F.col("t") / (states - 1))
    still = F.col("t") <= 0
    return times.select("t", F.when(still, 1.0).otherwise(1.0 / states + (states - 1.0) / states * fade).alias("p_same"), F.when(still, 0.0).otherwise((1.0 - fade) / states).alias("p_diff"))
