import http.server
import io
import json
import random
import sys
import threading
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe import cli, session, sinks, translate
from helixframe.functions import text as T
from helixframe.kernels import align, linkage
from helixframe.operators import composition, conservation, distance, hits, kmers, principal, reduce, trees, workqueue
from helixframe.sources import remote, tables
from helixframe.sources import text as sources
from helixframe.streaming import completion


def seqs(spark, *rows):
    return spark.createDataFrame([(f"s{i}", i, s, "f") for i, s in enumerate(rows)], "seq_id string, pos long, seq string, family string")


def values(spark, column, *xs, kind="double"):
    return [r[0] for r in spark.createDataFrame([(x,) for x in xs], f"x {kind}").select(column).collect()]


def test_entropy_goldens(spark):
    rows = {r.seq_id: r.entropy for r in composition.entropy(seqs(spark, "AACC", "AAAC", "ACDEFGHIKLMNPQRSTVWY", "", "AAXX")).collect()}
    assert [rows["s0"], rows["s1"], rows["s2"]] == pytest.approx([1.0, 0.811278, 4.321928], abs=1e-6)
    assert rows["s3"] is None and rows["s4"] == pytest.approx(0.5)
    every = {r.seq_id: r.entropy for r in composition.entropy_all_letters(seqs(spark, "AXAX", "")).collect()}
    assert every == {"s0": pytest.approx(1.0), "s1": 0.0}


def test_divergence_goldens(spark):
    rows = {(r.id_i, r.id_j): r.jsd for r in kmers.divergence(seqs(spark, "ACDE", "ACDE", "AAAA", "CCCC", "ACDEF", "ACDEG", "AC")).collect()}
    assert rows["s0", "s1"] == pytest.approx(0, abs=1e-12) and rows["s2", "s3"] == 1.0 and rows["s4", "s5"] == pytest.approx(1 / 3)
    assert len(rows) == 15  # the short one takes no part
    d = trees.profile_distances(["ACDE", "ACDE", "AAAA", "CCCC", "ACDEF", "ACDEG"])
    assert d[4, 5] == pytest.approx(1 / 3) and d[2, 3] == pytest.approx(1) and np.allclose(d, d.T)


def test_colours_and_buckets(spark):
    assert values(spark, T.hex_colour(F.col("x")), 1.0, 0.75, 0.5, 0.0) == ["0xff0000", "0xff7f7f", "0xffffff", "0x0000ff"]
    assert values(spark, T.percent_bucket(F.col("x")), 100.0, 0.0, 37.0, 99.9) == ["100%", "0%", "30-40%", "90-100%"]
    assert values(spark, T.normalise_residues(F.col("x")), "uzob", None, "", kind="string") == ["XXXX", None, ""]
    assert values(spark, T.tag_by_case(F.col("x")), "PRT", "strct", "", kind="string") == ["<AA2fold> PRT", "<fold2AA> strct", "<fold2AA> "]
    assert values(spark, T.natural_number(F.col("x")), "chunk_100.txt", "a1b22", "none", kind="string") == [100, 22, 0]
    assert values(spark, T.conservation(F.col("x")), 0.0, 5.0) == [1.0, 0.0]


def test_smoothing(spark):
    frame = spark.createDataFrame([(i, 1.0) for i in range(12)], "col int, h double")
    got = [round(r.smooth_h, 6) for r in conservation.smooth(frame, "h").orderBy("col").collect()]
    assert got == [0.5, 0.6, 0.7, 0.8, 0.9, 1, 1, 1, 0.9, 0.8, 0.7, 0.6]
    assert all(r.smooth_h == 1 for r in conservation.smooth(frame, "h", shrink=True).collect())


def test_blocks_and_profile(spark):
    msa = spark.createDataFrame([("a", 0, "ACDEF-"), ("b", 1, "ACDEG-"), ("c", 2, "ACD-G-")], "seq_id string, row long, aligned string")
    bg = spark.createDataFrame([(c, 0.05) for c in "ACDEFGHIKLMNPQRSTVWY"], "ch string, bg double")
    rows = {r.col: r for r in conservation.column_profile(msa, bg).collect()}
    assert rows[0].kl == pytest.approx(4.321928, abs=1e-5) and rows[0].h == 0 and rows[5].h is None and rows[5].gap_frac == 1
    assert "".join(r.ch for r in conservation.consensus(msa).orderBy("col").collect()) == "ACDEG-"
    frame = spark.createDataFrame([(i, 0.1 if i not in (6, 9) else 3.0, 0.0) for i in range(16)], "col int, smooth_h double, gap_frac double")
    assert [(r.start, r.end) for r in conservation.blocks(frame).orderBy("start").collect()] == [(0, 5), (10, 15)]


def test_dominant_and_bad_letters(spark):
    frame = seqs(spark, "AAAAAAAAAAAC", "ACAC", "AB*", "")
    assert [r.seq_id for r in composition.dominant_letter(frame).collect()] == ["s0"]
    assert {r.seq_id: r.bad for r in composition.bad_letters(frame).collect()} == {"s2": "*B"}


def test_chunking_covers_everything(spark):
    rows = spark.createDataFrame([(f"a{i:03d}", i) for i in range(10)], "accession string, pos long")
    sizes = [r["count"] for r in workqueue.split_into(rows, 6, "pos").groupBy("chunk").count().orderBy("chunk").collect()]
    assert sizes == [2] * 5
    assert workqueue.split_into(rows.limit(0), 6, "pos").count() == 0
    got = workqueue.split_by(rows.repartition(5), 3, "pos").orderBy("pos").collect()
    assert [r.chunk for r in got] == [i // 3 for i in range(10)] and [r.nth for r in got] == list(range(10))


def test_similar_and_status(spark):
    h = spark.createDataFrame([("a", "a", 0.0), ("a", "b", 1e-9), ("a", "c", 1e-12), ("a", "d", 5.0)], "query string, target string, evalue double")
    assert [r.target for r in hits.top_hits(h, "a").collect()] == ["c", "b"]
    known = seqs(spark, "A", "C")
    assert [hits.query_status(h, known, q).first().status for q in ("a", "s1", "zz")] == ["hits", "no hits", "not found"]
    scores = {(r.id_i, r.id_j): r.score for r in kmers.evalue_scores(h.select(F.col("target").alias("seq_id")), h, 10.0, 1e-300).collect()}
    assert scores["a", "b"] == pytest.approx(9) and scores["b", "c"] == pytest.approx(-1)


def test_alignment_columns(spark):
    frame = seqs(spark, "ACDEF", "ACEF", "AAA")
    rows = {(r.id_i, r.id_j): r for r in distance.alignment_distances(frame, 2).collect()}
    assert rows["s0", "s1"].score == 2 and rows["s0", "s1"].distance == pytest.approx(0.6)
    assert frame.crossJoin(frame.select(F.col("seq").alias("o"))).select(distance.nw_alignment("seq", "o").alias("x"), distance.nw_score("seq", "o").alias("d"), F.length("seq").alias("n")).filter("d = n").count() == 3


def test_search_finds_relatives(spark):
    rnd = random.Random(0)
    base = "".join(rnd.choice("ACDEFGHIKL") for _ in range(120))
    other = "".join(rnd.choice("MNPQRSTVWY") for _ in range(120))
    frame = seqs(spark, base, base[:60] + base[64:], other)
    rows = {(r.query, r.target): r for r in distance.search(frame).collect()}
    assert set(rows) == {("s0", "s0"), ("s1", "s1"), ("s2", "s2"), ("s0", "s1"), ("s1", "s0")}
    hit = rows["s0", "s1"]
    assert hit.gapopen == 1 and hit.alnlen == 120 and hit.fident == pytest.approx(116 / 120) and hit.evalue < 1e-20


def test_trees(spark):
    frame = seqs(spark, "ACDEFACDEF", "ACDEFACDEG", "WYWYWYVVVV", "WYWYWYVVVT", "ACDEFWYWYW")
    for method in ("nj", "average"):
        text = trees.newick(frame, method).first().newick
        assert all(f"s{i}:" in text for i in range(5)) and text.endswith(";")
    one = trees.tree_splits(frame, "average")
    same = trees.robinson_foulds(one, one).first()
    assert same.distance == 0 and same.normalised == 0 and same.shared == 2
    scores = {r.topology: r for r in trees.tree_scores(frame).collect()}
    assert set(scores) == {"UPGMA", "WPGMA"} and all(r.parsimony > 0 and r.log_likelihood < 0 for r in scores.values())
    assert trees.merge_table(frame).count() == 4
    msa = spark.createDataFrame([("a", 0, "AC"), ("b", 1, "CC"), ("c", 2, "A-")], "seq_id string, row long, aligned string")
    assert {r.site: r.changes for r in trees.site_parsimony(msa, [(0, 1), (3, 2)]).collect()} == {0: 1, 1: 1}
    rows = trees.align_family(frame).orderBy("row").collect()
    assert len({len(r.aligned) for r in rows}) == 1 and [r.aligned.replace("-", "") for r in rows] == [r.seq for r in frame.orderBy("pos").collect()]


def test_reduction(spark):
    frame = seqs(spark, "ACDEFG", "ACDEFH", "WYWYWY", "YWYWYW")
    features = kmers.vectors(frame)
    ids = ["s0", "s1", "s2", "s3"]
    placed, shares = principal.components(features, frame, 3)
    x = np.zeros((4, 8000))
    for r in features.collect():
        x[ids.index(r.seq_id), r.feature] = r.freq
    x -= x.mean(axis=0)
    values = np.linalg.svd(x, compute_uv=False) ** 2
    assert len(shares) == 2 and np.allclose(shares["share"], (values / values.sum())[:2])
    scores = np.array([r.scores for r in placed.orderBy("seq_id").collect()])
    assert np.allclose(np.abs(scores @ scores.T), np.abs(x @ x.T), atol=1e-9)
    clusters = [r.cluster for r in reduce.clusters(placed, 2).orderBy("seq_id").collect()]
    assert clusters[0] == clusters[1] != clusters[2] == clusters[3]
    last = reduce.last_merges(placed, "average", 2).orderBy("step").collect()
    want = linkage.linkage(np.linalg.norm(scores[:, None] - scores[None], axis=2))[1:]
    assert [(r.step, r["left"], r["right"], r["size"]) for r in last] == [(1 + k, a, b, n) for k, (a, b, _, n) in enumerate(want)] and np.allclose([r.distance for r in last], want[:, 2])
    rng = np.random.default_rng(0)
    y = reduce.tsne(np.vstack([rng.normal(0, 0.1, (15, 5)), rng.normal(8, 0.1, (15, 5))]), 5, 300)
    centres = y[:15].mean(axis=0), y[15:].mean(axis=0)
    assert np.linalg.norm(centres[0] - centres[1]) > y[:15].std() + y[15:].std()


def test_translation_and_pooling(spark):
    frame = seqs(spark, "ACDEFG", "")
    assert {r.seq_id: r.seq for r in translate.translate(frame, translate.Letters, longest=4).collect()} == {"s0": "CDEFGH", "s1": ""}
    pooled = reduce.mean_pool(translate.embed(frame, translate.Letters), "seq_id").collect()
    assert [(r.seq_id, list(r.embedding)) for r in pooled] == [("s0", [2.5, 1.0])]


def test_external_program(spark):
    program = [sys.executable, "-c", "import sys; [print(x if x.startswith('>') else x.lower(), end='') for x in sys.stdin]"]
    got = {r.seq_id: r.seq for r in translate.external(seqs(spark, "ACD", "", "WY"), program).collect()}
    assert {k.split()[0]: v for k, v in got.items()} == {"s0": "acd", "s1": "", "s2": "wy"}


def test_fasta(spark, tmp_path):
    folder = tmp_path / "fasta"
    folder.mkdir()
    (folder / "G1.faa").write_bytes(b"; remark\r\n>s1 desc x\r\nACDE\r\nFgh\r\n>s2\r\nACDX\r\n")
    (folder / "G2.faa").write_text(">s1 again\nWW\nYY\n>s3\n>s4 z\nA\n")
    rows = [(r.assembly, r.seq_id, r.seq, r.header) for r in sources.fasta(spark, str(folder)).orderBy("assembly", "pos").collect()]
    assert rows == [("G1", "s1", "ACDEFGH", "s1 desc x"), ("G1", "s2", "ACDX", "s2"), ("G2", "s1", "WWYY", "s1 again"), ("G2", "s3", "", "s3"), ("G2", "s4", "A", "s4 z")]
    assert {r.seq_id: r.seq for r in sources.last_of_each(sources.fasta(spark, str(folder))).collect()}["s1"] == "WWYY"
    assert {r.file: r.records for r in sources.fasta_count(spark, str(folder)).collect()} == {"G1.faa": 2, "G2.faa": 3}
    assert sorted(r.accession for r in sources.available_accessions(spark, str(folder)).collect()) == ["G1", "G2"]
    sinks.write_fasta(seqs(spark, "AC", "DE"), str(tmp_path / "out"))
    assert sorted((r.seq_id, r.seq) for r in sources.fasta(spark, str(tmp_path / "out")).collect()) == [("s0", "AC"), ("s1", "DE")]


@pytest.fixture()
def queue(tmp_path):
    chunks = tmp_path / "chunks"
    chunks.mkdir()
    for n, lines in {2: "GCF_3\nGCF_4\n", 10: "GCF_5\n\n# no\n", 1: "GCF_1\n  GCF_2 \nGCF_1\n"}.items():
        (chunks / f"chunk_{n}.txt").write_text(lines)
    (tmp_path / "done.txt").write_text("GCF_1 ['a', 'task_1']\nGCF_2 x\n\nGCF_3 y\n")
    for depth, got in (("task_1", ["GCF_1", "GCF_2"]), ("x/task_2", ["GCF_2"]), ("x/y/task_3", ["GCF_3"])):
        (tmp_path / "runs" / depth).mkdir(parents=True)
        (tmp_path / "runs" / depth / "metadata.json").write_text(json.dumps({"assemblies_downloaded": got, "num_sequences": 3}, indent=1))
    (tmp_path / "runs" / "task_bad").mkdir()
    (tmp_path / "runs" / "task_bad" / "metadata.json").write_text("{not json")
    return tmp_path


def test_work_queue_commands(spark, queue, capsys):
    chunks, done = str(queue / "chunks"), str(queue / "done.txt")
    report = cli.progress(spark, chunks, done)
    assert [(r.label, r.done, r.total) for r in report["runs"].orderBy("run").collect()] == [("chunk_1.txt", 2, 2), ("chunk_2.txt", 1, 2), ("chunk_10.txt", 0, 1)]
    assert report["overall"].first().asDict() == {"done": 3, "remaining": 2, "total": 5, "pct": 60.0, "full": 1, "partly": 1, "not_started": 1}
    assert [(r.file, r.removed, r.kept, r.deleted) for r in cli.remove_done(spark, chunks, done, str(queue / "left")).collect()] == [("chunk_1.txt", 2, 0, True), ("chunk_10.txt", 0, 1, False), ("chunk_2.txt", 1, 1, False)]
    assert [r.n for r in cli.rechunk(spark, chunks, 2, str(queue / "new")).collect()] == [2, 2, 1]
    counted = cli.collect(spark, str(queue / "runs"), str(queue / "index"))
    assert {r.accession: r.n for r in counted.collect()} == {"GCF_1": 1, "GCF_2": 2, "GCF_3": 1}
    assert [r.path.split("/")[-2] for r in tables.skipped(tables.run_metadata(spark, str(queue / "runs"))).collect()] == ["task_bad"]
    assert [r.n for r in cli.split(spark, str(queue / "chunks" / "chunk_1.txt"), 2, str(queue / "split")).collect()] == [2, 1]
    assert [r.accession for r in sources.raw_accessions(spark, str(queue / "chunks" / "chunk_1.txt")).orderBy("pos").collect()] == ["GCF_1", "  GCF_2 ", "GCF_1"]
    genomes = queue / "genomes"
    genomes.mkdir()
    for a in ("GCF_1", "GCF_7", "GCF_8"):
        (genomes / f"{a}.faa").write_text(">x\nA\n")
    cli.main(["chunk-remaining", "--genomes-dir", str(genomes), "--results-dir", str(queue / "runs"), "--chunk-size", "1", "--output-dir", str(queue / "rest")], spark)
    assert {p.name: p.read_text() for p in (queue / "rest").iterdir() if p.suffix == ".txt"} == {"chunk_01.txt": "GCF_7\n", "chunk_02.txt": "GCF_8\n"}


def chunk_texts(folder):
    return {p.name: p.read_text().split() for p in folder.iterdir() if p.suffix == ".txt"}


def test_chunk_files_keep_their_order_and_are_read_back(spark, queue):
    (queue / "all.txt").write_text("Z9\nB2\nA1\nQ7\nC3\nM4\n")
    cli.split(spark, str(queue / "all.txt"), 3, str(queue / "s"))
    assert chunk_texts(queue / "s") == {"chunk_01.txt": ["Z9", "B2"], "chunk_02.txt": ["A1", "Q7"], "chunk_03.txt": ["C3", "M4"]}
    read = sources.chunk_directory(spark, str(queue / "s")).orderBy("file_number", "pos").collect()
    assert [(r.file, r.file_number, r.accession) for r in read] == [(f"chunk_0{i}.txt", i, a) for i, own in enumerate((["Z9", "B2"], ["A1", "Q7"], ["C3", "M4"]), 1) for a in own]
    (queue / "d.txt").write_text("A1\nQ7\nM4\n")
    cli.remove_done(spark, str(queue / "s"), str(queue / "d.txt"), str(queue / "l"))
    assert chunk_texts(queue / "l") == {"chunk_01.txt": ["Z9", "B2"], "chunk_03.txt": ["C3"]}
    cli.rechunk(spark, str(queue / "l"), 2, str(queue / "r"))
    assert chunk_texts(queue / "r") == {"chunk_01.txt": ["Z9", "B2"], "chunk_02.txt": ["C3"]}
    report = cli.progress(spark, str(queue / "r"), str(queue / "d.txt"))
    assert report["overall"].first().asDict() == {"done": 0, "remaining": 3, "total": 3, "pct": 0.0, "full": 0, "partly": 0, "not_started": 2}


@pytest.fixture()
def service():
    """A local service: packages, texts, pages, errors."""

    class Answer(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            path, _, query = self.path.partition("?")
            code, body = 404, b""
            if path == "/pages":
                token = query.rpartition("page_token=")[2]
                code, body = 200, json.dumps({"reports": [{"accession": f"GCF_{token or 0}{i}"} for i in range(2)], "next_page_token": {"": "1", "1": "2"}.get(token)}).encode()
            elif path.startswith("/zip/"):
                held = io.BytesIO()
                with zipfile.ZipFile(held, "w") as z:
                    for a in path[5:].split(","):
                        z.writestr(f"data/{a}/protein.faa", f">{a}\nMK\n")
                code, body = (500, b"") if "BAD" in path else (200, held.getvalue())
            elif path.startswith("/text/"):
                code, body = (200, f"ATOM {path[6:]}".encode()) if "NONE" not in path else (404, b"")
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_downloads(spark, service, tmp_path, capsys):
    (tmp_path / "list.txt").write_text("GCF_1\nBAD\nGCF_2\n")
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "GCF_2.faa").write_text(">there\nA\n")
    got = cli.download(spark, str(tmp_path / "list.txt"), f"{service}/zip/{{}}", str(tmp_path / "out"), with_key=True).collect()
    assert [(r.accession, r.written) for r in got] == [("BAD", False), ("GCF_1", True)] and "500" in got[0].error and got[1].error is None
    assert (tmp_path / "out" / "GCF_1.faa").read_text() == ">GCF_1\nMK\n\n" and (tmp_path / "out" / "GCF_2.faa").read_text() == ">there\nA\n"
    (tmp_path / "p").mkdir()
    (tmp_path / "ids.txt").write_text("1ABC\nNONE\n")
    cli.main(["download", str(tmp_path / "ids.txt"), f"{service}/text/{{}}", "--kind", "structure", "--with-key", "--output-dir", str(tmp_path / "p")], spark)
    assert (tmp_path / "p" / "1ABC.pdb").read_text() == "ATOM 1ABC\n" and not (tmp_path / "p" / "NONE.pdb").exists()
    cli.main(["fetch-accessions", f"{service}/pages", "--limit", "5", "--output-dir", str(tmp_path / "f")], spark)
    assert (tmp_path / "f" / "accessions.txt").read_text().split() == ["GCF_00", "GCF_01", "GCF_10", "GCF_11", "GCF_20"]
    batches = spark.createDataFrame([(0, "GCF_1,GCF_3"), (1, "BAD"), (2, "GCF_4")], "chunk long, accessions string")
    rows = sorted(((r.chunk, r.accession, r.content) for r in remote.bulk_download(batches, remote.http_fetch(f"{service}/zip/{{}}"), with_key=True).collect()), key=str)
    assert rows == [(0, "GCF_1", ">GCF_1\nMK\n"), (0, "GCF_3", ">GCF_3\nMK\n"), (1, None, None), (2, "GCF_4", ">GCF_4\nMK\n")]


def test_strict_metadata(spark, queue):
    with pytest.raises(Exception, match="(?i)malformed|failfast|parse"):
        tables.run_metadata(spark, str(queue / "runs"), strict=True).collect()


def test_searching_many_at_once_scores_as_one_by_one(spark):
    rnd = random.Random(4)
    word = lambda n: "".join(rnd.choice("ACDEFGHIKL") for _ in range(n))
    table = {"A": {"A": 4, "C": 1}, "C": {"A": 1, "C": 9}, "D": {"D": 6, "E": 2}}
    base = word(60)
    others = [word(rnd.randrange(0, 90)) for _ in range(40)] + [base[10:50], base[:20] + word(15) + base[20:], ""]
    for rule in ({}, {"match": 3, "mismatch": -2, "gap_open": 4, "gap_extend": 2}, {"table": table, "gap_open": 6}):
        want = [(align.local_alignment(base, b, **rule) or {"score": 0})["score"] for b in others]
        assert align.local_scores(base, others, **rule).tolist() == want


def test_clusters_and_last_merges_of_components(spark):
    scores = spark.createDataFrame([(f"s{i}", [x]) for i, x in enumerate([0.0, 0.1, 0.2, 9.0, 9.1, 20.0])], "seq_id string, scores array<double>")
    for method, sizes in (("ward", [3, 6]), ("average", [5, 6])):
        assert [r.cluster for r in reduce.clusters(scores, 3, method).orderBy("seq_id").collect()] == [1, 1, 1, 2, 2, 3]
        last = reduce.last_merges(scores, method, 2).orderBy("step").collect()
        assert [r.step for r in last] == [3, 4] and [r["size"] for r in last] == sizes
    assert [round(r.distance, 6) for r in reduce.last_merges(scores, "average", 2).orderBy("step").collect()] == [8.95, 16.32]


def test_results_commands(spark, tmp_path, capsys):
    (tmp_path / "results.tsv").write_text("s1\ts1\t1.0\t5\t0\t0\t1\t5\t1\t5\t1e-30\t90\ns1\ts2\t0.5\t4\t2\t0\t1\t4\t1\t4\t1e-5\t40\n")
    (tmp_path / "structures.fasta").write_text(">s1\nDDDVV\n>s2 x\nDDDD\n")
    (tmp_path / "combined_aa.fasta").write_text(">s1\nMKTAY\n>s2\nMKTA\n>s9\nM\n")
    for argv in (["overview"], ["lookup", "s1"], ["lookup", "zz"], ["similar", "s1", "--output-fasta", str(tmp_path / "out")], ["validate"]):
        cli.main([argv[0], str(tmp_path), *argv[1:]], spark)
    shown = capsys.readouterr().out
    assert "MISSING" in shown and "MKTAY" in shown
    written = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert written == ">s2 evalue=1.00e-05 fident=0.500\nMKTA\n"


def test_remote_sources(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/readme", "no")
        z.writestr("x/protein.faa", ">p\nMK\n")
    (tmp_path / "b.zip").write_bytes(b"broken")
    assert sorted((r.path.split("/")[-1], r.content) for r in remote.local_packages(spark, str(tmp_path)).collect()) == [("a.zip", ">p\nMK\n"), ("b.zip", None)]
    content = (tmp_path / "a.zip").read_bytes()
    wanted = spark.createDataFrame([("A",), ("B",), ("C",), ("A",)], "accession string")
    got = remote.download(wanted, spark.createDataFrame([("C",)], "accession string"), lambda a: content if a == "A" else None, with_key=True)
    assert sorted((r.accession, r.content, r.error) for r in got.collect()) == [("A", ">p\nMK\n", None), ("B", None, None)]

    bad = io.BytesIO()
    with zipfile.ZipFile(bad, "w") as z:
        z.writestr("x/protein.faa", b"\xff\xfe")
    some = remote.download(wanted.limit(2), wanted.limit(0), lambda a: bad.getvalue() if a == "A" else content, with_key=True).collect()
    assert {r.accession: (r.content, (r.error or "")[:18]) for r in some} == {"A": (None, "UnicodeDecodeError"), "B": (">p\nMK\n", "")}
    batches = spark.createDataFrame([(0, "A"), (1, "B")], "chunk long, accessions string")
    many = remote.bulk_download(batches, lambda a: bad.getvalue() if a == "A" else content).collect()
    assert sorted((r.chunk, r.content, (r.error or "")[:18]) for r in many) == [(0, None, "UnicodeDecodeError"), (1, ">p\nMK\n", "")]

    class Pages(remote.ReportPages):
        fetch = staticmethod(lambda token: {"reports": [{"accession": f"{token}-{i}"} for i in range(3)] + [{}], "next_page_token": {None: "t", "t": "u", "u": None}[token]})

    spark.dataSource.register(Pages)
    reader = spark.read.format("report_pages")
    assert reader.load().count() == 9 and [r.accession for r in reader.option("limit", 4).load().collect()] == ["None-0", "None-1", "None-2", "t-0"]


def test_completion_stream(spark, queue):
    stream = completion.completed_stream(spark, str(queue / "runs"))
    completion.write_completed(stream, str(queue / "out"), str(queue / "cp")).awaitTermination(60)
    assert sorted(r.accession for r in spark.read.parquet(str(queue / "out")).collect()) == ["GCF_1", "GCF_2", "GCF_3"]


def test_viewer_script(spark):
    scores = spark.createDataFrame([(0, 1.0), (1, 0.5), (2, 1.0)], "resi int, score double")
    bins = sinks.viewer_bins(scores)
    assert {r.bin: r.residues for r in bins.collect()} == {1.0: "1+3", 0.5: "2"}
    blocks = spark.createDataFrame([(4, 9)], "start int, end int")
    lines = "\n".join(r.value for r in sinks.viewer_script(bins, blocks).orderBy("order").collect())
    assert "color cons_100, resi 1+3" in lines and "resi 5-10" in lines


def test_first_found(spark):
    wanted = spark.createDataFrame([("A",), ("B",), ("C",)], "accession string")
    listing = lambda *rows: spark.createDataFrame(list(rows), "accession string, path string")
    got = {r.accession: r.path for r in sources.first_found(wanted, [listing(("A", "1/A")), listing(("A", "2/A"), ("B", "2/B"))]).collect()}
    assert got == {"A": "1/A", "B": "2/B", "C": None}


def test_session_is_reused(spark):
    assert session.build() is not None and align.distance("", "") is None
