"""The registered queries of the sequence, hit, alignment and work-queue operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe import adapters, sinks, translate
from helixframe.functions import text
from helixframe.operators import composition, conservation, distance, hits, kmers, principal, reduce, trees, workqueue
from helixframe.plans import oracles
from helixframe.schemas import CLUSTERS, EVALUE_CEILING, EVALUE_FLOOR, SAMPLE
from helixframe.sources import tables
from helixframe.storage import scratch

QUERY, EVALUE, DOMINANT = "P7", 1e-10, 0.2
#: The driver's passages are no homologues: their columns count as conserved under this entropy.
BLOCK_ENTROPY = 3.4
TIES = ("l_orderkey", "l_linenumber")


def _rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


def _log10(column: str = "evalue") -> Column:
    return F.round(text.log_evalue(F.col(column)), 6)


def _top(s: SparkSession, d: str) -> DataFrame:
    return hits.top_hits(adapters.hits(s, d), QUERY, EVALUE, 50, TIES)


def hits_similar_topk(s, d):
    return _top(s, d).select("target", "fident", "alnlen", _log10().alias("log10_evalue"), "bits")


def hits_query_status(s, d):
    h, q = adapters.hits(s, d), adapters.sequences(s, d)
    return hits.query_status(h, q, QUERY).unionByName(hits.query_status(h, q, "S7")).unionByName(hits.query_status(h, q, "none"))


def _histogram(values: DataFrame, bins: int) -> DataFrame:
    return _rounded(composition.histogram(values, "x", bins), "lo", "hi")


def hits_evalue_hist(s, d):
    return _histogram(hits.without_self(adapters.hits(s, d)).select((-_log10()).alias("x")), 80)


def hits_export_fasta(s, d):
    named = adapters.sequences(s, d).select(F.concat(F.lit("P"), F.col("pos")).alias("seq_id"), "seq")
    line = F.concat(F.format_string(">%s fident=%.3f\n", "target", "fident"), F.col("seq"))
    return hits.export_records(_top(s, d), named).select("target", F.md5(line).alias("record"))


def seq_bad_chars(s, d):
    raw = adapters.table(s, d, "documents").select(F.concat(F.lit("D"), F.col("doc_id")).alias("seq_id"), F.coalesce("text", F.lit("")).alias("seq"))
    return composition.bad_letters(raw)


def seq_lookup(s, d):
    found = composition.lookup(adapters.structures(s, d), adapters.sequences(s, d), "S0")
    return found.withColumns({n: F.md5(n) for n in ("structure", "aa")})


def seq_sample(s, d):
    return composition.sample(adapters.sequences(s, d), SAMPLE["composition"]).select("seq_id", "pos", F.length("seq").alias("len"))


def aa_normalise(s, d):
    return adapters.table(s, d, "documents").select("doc_id", F.md5(text.normalise_residues(F.coalesce("text", F.lit("")))).alias("normalised"))


def aa_prompt(s, d):
    seq = F.col("seq")
    tag = F.split(text.tag_by_case(seq), " ")[0]
    return adapters.sequences(s, d).select("seq_id", F.md5(text.translation_prompt(seq)).alias("prompt"), F.md5(text.decoded(seq)).alias("decoded"), tag.alias("tag"), text.short_label(F.col("seq_id")).alias("label"))


def uniprot_extract(s, d):
    """Names in every form, made of the customers' keys."""
    key = F.col("c_custkey")
    own = F.concat(F.lit("P"), F.lpad((key % 100_000).cast("string"), 5, "0"))
    forms = [F.concat(F.lit("sp|"), own, F.lit("|"), "c_mktsegment"), F.concat(F.lit("AF-"), own, F.lit("-F1")), own, F.concat(F.lit("WP_"), key.cast("string"), F.lit(".1"))]
    name = F.col("c_name")
    for k, form in enumerate(forms):
        name = F.when(key % 5 == k, form).otherwise(name)
    return adapters.table(s, d, "customer").select("c_custkey", name.alias("name")).select("c_custkey", "name", text.protein_accession(F.col("name")).alias("accession"))


def kmer_counts(s, d):
    return kmers.totals(adapters.sequences(s, d))


def kmer_features(s, d):
    seqs = adapters.sequences(s, d)
    return _rounded(kmers.feature_counts(seqs), "mean_features").crossJoin(F.broadcast(kmers.too_short(seqs)))  # one row each


def kmer_jsd(s, d):
    return _rounded(kmers.divergence(composition.sample(adapters.sequences(s, d), SAMPLE["distance"])), "jsd")


def seq_composition_heatmap(s, d):
    return _rounded(composition.composition_cells(adapters.sequences(s, d), SAMPLE["composition"]), "value")


def kmer_jsd_heatmap(s, d):
    sampled = composition.sample(adapters.sequences(s, d), SAMPLE["distance"]).filter(F.length("seq") >= 3)
    return _rounded(composition.matrix_cells(kmers.divergence(sampled), sampled, "jsd"), "value")


def dist_evalue(s, d):
    h = adapters.hits(s, d)
    return kmers.evalue_scores(h.select(F.col("query").alias("seq_id")), h, EVALUE_CEILING, EVALUE_FLOOR, places=6)


def dist_nw(s, d):
    return _rounded(distance.alignment_distances(adapters.family(s, d)), "distance")


def nw_alignments(s, d):
    f = adapters.family(s, d).select("pos", "seq_id", "seq")
    pairs = f.join(f.select((F.col("pos") - 1).alias("pos"), F.col("seq_id").alias("id_b"), F.col("seq").alias("seq_b")), "pos")
    return pairs.select("seq_id", "id_b", distance.nw_alignment("seq", "seq_b").alias("x")).select("seq_id", "id_b", "x.a", "x.b")


def jukes_cantor(s, d):
    times = adapters.table(s, d, "lineitem").select(F.col("l_discount").alias("t")).distinct()
    return _rounded(trees.jukes_cantor(times), "p_same", "p_diff", places=9)


def search_all_vs_all(s, d):
    return _rounded(distance.search(adapters.family(s, d)), "fident", "evalue", "bits")


def _assigned(s, d):
    return workqueue.split_into(adapters.accessions(s, d), 12, "pos").select("accession", "chunk")


def chunk_fixed(s, d):
    chunk = F.col("chunk")
    return workqueue.split_by(adapters.accessions(s, d), adapters.CHUNK_SIZE, "pos").select("accession", "chunk", F.format_string("chunk_%02d.txt", chunk + 1).alias("file"))


def _customers(s, d):
    return adapters.table(s, d, "orders").select(F.concat(F.lit("C"), F.col("o_custkey")).alias("accession"), F.col("o_orderkey").alias("pos"), F.col("o_orderpriority").alias("source"))


def _progress(s, d):
    return workqueue.chunk_progress(adapters.chunk_files(s, d), adapters.done(s, d))


def chunk_overall(s, d):
    return _rounded(workqueue.overall(_progress(s, d), adapters.chunk_files(s, d), adapters.done(s, d)), "pct")


def chunk_progress_runs(s, d):
    numbered = _progress(s, d).withColumn("file_number", text.natural_number(F.col("file")))
    return _rounded(workqueue.progress_runs(numbered, "file_number", "file"), "pct")


def sweep_settings(s, d):
    """Every setting of the short lists that the tables' columns hold."""
    column = lambda table, name, value: adapters.table(s, d, table).select(F.expr(value).cast("long").alias(name)).distinct()
    return workqueue.sweep(column("lineitem", "threads", "l_linenumber"), column("part", "split_length", "50 * p_size"), column("region", "rep", "r_regionkey + 1"))


def benchmark_rates(s, d):
    runs = adapters.table(s, d, "lineitem").groupBy(F.col("l_suppkey").alias("accession")).agg(F.count(F.lit(1)).alias("num_proteins"), F.sum("l_quantity").alias("total_residues"), F.sum("l_extendedprice").alias("time_total_s"))
    runs = runs.withColumns({f"time_{n}_s": F.col("time_total_s") for n in ("createdb", "search")})
    rates = tables.benchmark_rates(runs)
    return _rounded(rates.select("accession", F.col("proteins_per_s_total").alias("proteins_per_s"), F.col("residues_per_s_total").alias("residues_per_s")), "proteins_per_s", "residues_per_s")


def genomes_by_residues(s, d):
    seqs = adapters.sequences(s, d).join(adapters.table(s, d, "documents").select(F.col("doc_id").alias("pos"), F.col("source").alias("assembly")), "pos")
    stats = composition.fasta_stats(seqs, "assembly")
    return workqueue.numbered(stats, "residues", "assembly").select("assembly", "proteins", "residues", (F.col("nth") + 1).alias("rank"))


def rest_pages_limit(s, d):
    o = adapters.table(s, d, "orders")
    report = F.struct(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("accession"))
    pages = o.groupBy(F.floor(F.col("o_orderkey") / 100).alias("page")).agg(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", report.alias("r")))), lambda x: x["r"]).alias("reports"))
    return tables.report_pages(pages, 250)


def meta_explode(s, d):
    parsed = adapters.table(s, d, "events").select("event_id", F.from_json("props", "k long").alias("p"))
    return parsed.groupBy(F.col("p.k").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


def embedding_mean_pool(s, d):
    pooled = reduce.mean_pool(adapters.table(s, d, "embeddings"), "label")
    return _rounded(pooled.select("label", F.posexplode("embedding").alias("pos", "mean")), "mean")


def _msa(s, d):
    return conservation.pad_to_median(adapters.family(s, d))


def _columns(s, d):
    bg = conservation.background(composition.global_composition(adapters.sequences(s, d)))
    profile = conservation.column_profile(_msa(s, d), bg)
    # Settled, as a row a column is little and what it is made of is all documents.
    return scratch(conservation.smooth(conservation.smooth(profile, "h"), "kl"), "columns")


def _blocks(s, d):
    return conservation.blocks(_columns(s, d), threshold=BLOCK_ENTROPY)


def msa_block_table(s, d):
    columns = _columns(s, d)
    return conservation.block_table(conservation.blocks(columns, threshold=BLOCK_ENTROPY), columns, _msa(s, d))


def msa_residue_scores(s, d):
    return _rounded(conservation.residue_scores(_msa(s, d), _columns(s, d)), "score")


def viewer_bins(s, d):
    return sinks.viewer_bins(msa_residue_scores(s, d).filter("seq_id = 'B0'")).select("bin", "residues")


def tree_rf(s, d):
    f = adapters.family(s, d)
    return _rounded(trees.robinson_foulds(trees.tree_splits(f, "average"), trees.tree_splits(f, "weighted")), "normalised")


def tree_fitch(s, d):
    """Changes by site on the padded family, on a caterpillar tree."""
    n = adapters.family(s, d).count()
    return trees.site_parsimony(_msa(s, d), [(0, 1)] + [(n + i - 1, i + 1) for i in range(1, n - 1)])


def _reduced(s, d):
    seqs = composition.sample(adapters.sequences(s, d), SAMPLE["reduction"]).filter(F.length("seq") >= 3)
    return seqs, principal.components(kmers.vectors(seqs), seqs)


def pca_scree(s, d):
    return _rounded(reduce.scree(s.createDataFrame(_reduced(s, d)[1][1])), "share", "cumulative")


def ward_clusters(s, d):
    return reduce.clusters(_reduced(s, d)[1][0], CLUSTERS)


def average_clusters(s, d):
    return reduce.clusters(_reduced(s, d)[1][0], CLUSTERS, "average")


def dendrogram_last_merges(s, d):
    scores = _reduced(s, d)[1][0]
    ward, average = (reduce.last_merges(scores, method).withColumn("method", F.lit(method)) for method in ("ward", "average"))
    return _rounded(ward.unionByName(average), "distance")


def cluster_summary(s, d):
    seqs, (scores, _) = _reduced(s, d)
    summary = reduce.cluster_summary(reduce.clusters(scores, CLUSTERS), seqs, composition.entropy(seqs))
    return _rounded(summary, "mean_len", "std_len", "mean_entropy")


def translate_letters(s, d):
    return translate.translate(adapters.sequences(s, d), translate.Letters, longest=1000).select("seq_id", F.md5("seq").alias("translated"))


def tsne_map(s, d):
    scores = _reduced(s, d)[1][0].orderBy("seq_id").collect()  # SAMPLE["reduction"] rows at most
    y = reduce.tsne(np.array([r.scores for r in scores], float).reshape(len(scores), -1), steps=1000)  # as many as the reference runs
    return s.createDataFrame([(r.seq_id, float(a), float(b)) for r, (a, b) in zip(scores, y, strict=True)], "seq_id string, x double, y double")


#: Whole numbers that are 32-bit in Spark's functions and 64-bit in the other engine.
_BLOCK = ("block", "start", "end")
_LONG = {
    "dist_nw": ("score", "longest"), "seq_lookup": ("aa_len", "structure_len"), "seq_sample": ("len",), "seq_validate": ("len", "other_len"), "embedding_mean_pool": ("pos",), "msa_block_table": _BLOCK, "msa_blocks": _BLOCK,
    "msa_residue_scores": ("col",), "tree_fitch": ("site", "changes"), "seq_length_stats": ("min_len", "max_len"), "seq_length_boxplot": ("whisker_low", "whisker_high"),
    "msa_column_entropy": ("col",), "msa_gap_fraction": ("col",), "msa_kl": ("col",), "msa_smooth": ("col",), "msa_consensus": ("col",),
}


def _widened(query, names):
    return query if not names else lambda s, d: query(s, d).withColumns({n: F.col(n).cast("long") for n in names})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        hits_similar_topk, hits_query_status, hits_evalue_hist, hits_export_fasta, seq_bad_chars, seq_lookup, seq_sample, aa_normalise, aa_prompt, uniprot_extract,
        kmer_counts, kmer_features, kmer_jsd, seq_composition_heatmap, kmer_jsd_heatmap, dist_evalue, dist_nw, nw_alignments, jukes_cantor, search_all_vs_all, chunk_fixed, chunk_overall, chunk_progress_runs,
        sweep_settings, benchmark_rates, genomes_by_residues, rest_pages_limit, meta_explode, embedding_mean_pool, msa_block_table, msa_residue_scores, viewer_bins,
        tree_rf, tree_fitch, pca_scree, ward_clusters, average_clusters, dendrogram_last_merges, cluster_summary, translate_letters, tsne_map,
    )
    seqs, h, family = adapters.sequences, adapters.hits, adapters.family
    short = {
        "hits_overview_totals": lambda s, d: hits.totals(h(s, d)),
        "hits_evalue_thresholds": lambda s, d: _rounded(hits.evalue_thresholds(h(s, d)), "pct"),
        "hits_identity_buckets": lambda s, d: _rounded(hits.identity_buckets(h(s, d)), "pct"),
        "hits_per_query_top10": lambda s, d: hits.busiest_queries(h(s, d)),
        "hits_per_query": lambda s, d: hits.hits_per_query(h(s, d)),
        "hits_best_per_pair": lambda s, d: hits.best_per_pair(h(s, d)).select("query", "target", _log10().alias("log10_evalue")),
        "hits_bits_hist": lambda s, d: _histogram(hits.without_self(h(s, d)).select(F.col("bits").alias("x")), 80),
        "hits_fident_hist": lambda s, d: _histogram(hits.without_self(h(s, d)).select(F.col("fident").alias("x")), 50),
        "hits_per_query_hist": lambda s, d: _histogram(hits.hits_per_query(h(s, d)).select(F.col("n").alias("x")), 50),
        "seq_length_stats": lambda s, d: _rounded(composition.length_summary(seqs(s, d)), "mean_len", "std_len"),
        "seq_length_hist": lambda s, d: _histogram(seqs(s, d).select(F.length("seq").alias("x")), 60),
        "seq_length_boxplot": lambda s, d: composition.box(seqs(s, d).select(F.length("seq").alias("x")), "x"),
        "seq_complexity_flags": lambda s, d: composition.complexity_flags(seqs(s, d)),
        "seq_fasta_stats": lambda s, d: composition.fasta_stats(seqs(s, d)),
        "seq_global_composition": lambda s, d: _rounded(composition.global_composition(seqs(s, d)), "pct"),
        "seq_letter_usage": lambda s, d: _rounded(composition.letter_usage(seqs(s, d)), "pct"),
        "seq_composition_matrix": lambda s, d: _rounded(m := composition.composition_matrix(seqs(s, d)), *m.columns[1:]),
        "seq_entropy": lambda s, d: _rounded(composition.entropy(seqs(s, d)), "entropy"),
        "seq_entropy_all_letters": lambda s, d: _rounded(composition.entropy_all_letters(seqs(s, d)), "entropy"),
        "seq_entropy_summary": lambda s, d: _rounded(m := composition.entropy_summary(composition.entropy(seqs(s, d))), *m.columns),
        "seq_entropy_hist": lambda s, d: _histogram(composition.entropy(seqs(s, d)).select(F.round("entropy", 6).alias("x")), 50),
        "seq_validate": lambda s, d: composition.validate_pairs(seqs(s, d), adapters.structures(s, d)).fillna(-1, "other_len"),
        "seq_dominant_char": lambda s, d: _rounded(composition.dominant_letter(seqs(s, d), DOMINANT), "share"),
        "seq_fuzzy_lookup": lambda s, d: composition.similar_ids(seqs(s, d), "7"),
        "kmer_profile": lambda s, d: _rounded(kmers.profile(seqs(s, d)), "freq"),
        "chunk_split": _assigned,
        "chunk_call_batches": lambda s, d: workqueue.call_batches(adapters.accessions(s, d), 50),
        "chunk_dedup_ordered": lambda s, d: workqueue.first_occurrences(_customers(s, d), "pos"),
        "chunk_remaining": lambda s, d: workqueue.remaining(adapters.accessions(s, d), adapters.done(s, d)),
        "chunk_remove_completed": lambda s, d: workqueue.remove_completed(adapters.chunk_files(s, d), adapters.done(s, d)).select("file", "accession"),
        "chunk_removal_report": lambda s, d: workqueue.removal_report(adapters.chunk_files(s, d), adapters.done(s, d)),
        "chunk_progress": lambda s, d: _rounded(_progress(s, d), "pct"),
        "chunk_hist": lambda s, d: workqueue.progress_histogram(_progress(s, d)),
        "accession_dups": lambda s, d: workqueue.frequencies(_customers(s, d)).filter("n > 1"),
        "msa_simple_pad": _msa,
        "msa_column_entropy": lambda s, d: _rounded(_columns(s, d).select("col", "h"), "h"),
        "msa_gap_fraction": lambda s, d: _rounded(_columns(s, d).select("col", "gap_frac"), "gap_frac"),
        "msa_kl": lambda s, d: _rounded(_columns(s, d).select("col", "kl"), "kl"),
        "msa_smooth": lambda s, d: _rounded(_columns(s, d).select("col", "smooth_h", "smooth_kl"), "smooth_h", "smooth_kl"),
        "msa_blocks": _blocks,
        "msa_coverage": lambda s, d: _rounded(conservation.coverage(conservation.blocks(c := _columns(s, d), threshold=BLOCK_ENTROPY), c), "share"),
        "msa_column_summary": lambda s, d: _rounded(conservation.column_summary(_columns(s, d)), "min_h", "max_h", "mean_h", "median_h"),
        "msa_consensus": lambda s, d: conservation.consensus(_msa(s, d)),
        "conservation_colours": lambda s, d: msa_residue_scores(s, d).select("seq_id", "resi", text.hex_colour(F.col("score")).alias("colour")),
        "msa_progressive": lambda s, d: trees.align_family(family(s, d)),
        "tree_nj": lambda s, d: trees.newick(family(s, d), "nj"),
        "tree_upgma": lambda s, d: trees.newick(family(s, d), "average"),
        "tree_wpgma": lambda s, d: trees.newick(family(s, d), "weighted"),
        "tree_merges": lambda s, d: _rounded(trees.merge_table(family(s, d)), "distance"),
        "tree_loglik": lambda s, d: _rounded(trees.tree_scores(family(s, d)), "log_likelihood"),
    }
    return {name: _widened(f, _LONG.get(name, ())) for name, f in ({f.__name__: f for f in own} | short).items()}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql(BLOCK_ENTROPY)
