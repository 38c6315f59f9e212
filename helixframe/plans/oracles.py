"""DuckDB SQL of the queries that SQL can express, by query name."""

from __future__ import annotations

from helixframe.schemas import ALPHABET, EVALUE_THRESHOLDS, IDENTITY_BUCKETS

_LETTERS = f"upper(regexp_replace(coalesce(text, ''), '[^{ALPHABET}{ALPHABET.lower()}]', '', 'g'))"
_SEQS = f"seqs AS (SELECT 'S' || doc_id AS seq_id, doc_id AS pos, {_LETTERS} AS seq FROM documents)"
_STRUCTURES = "structures AS (SELECT seq_id, pos, CASE WHEN quality = 1 THEN seq ELSE substr(seq, 2) END AS seq FROM seqs JOIN labels ON pos = labels.doc_id)"
_FAMILY = f"fam AS (SELECT 'B' || item_id AS seq_id, item_id AS pos, {_LETTERS} AS seq FROM benchmark)"
_HITS = "hits AS (SELECT 'P' || l_suppkey AS query, 'P' || (l_partkey % 100) AS target, round(l_discount * 10, 1) AS fident, CAST(l_quantity AS INTEGER) AS alnlen, pow(10.0::DOUBLE, -l_extendedprice / 1000) AS evalue, l_extendedprice / 100 AS bits, l_orderkey, l_linenumber FROM lineitem)"
_QUEUE = """acc AS (SELECT CAST(o_orderkey AS VARCHAR) AS accession, o_orderkey AS pos, 'C' || o_custkey AS source, o_orderstatus = 'F' AS is_done, row_number() OVER (ORDER BY o_orderkey) - 1 AS nth FROM orders),
    files AS (SELECT accession, pos, nth // 50 AS chunk, printf('chunk_%02d.txt', nth // 50 + 1) AS file, is_done FROM acc)"""
_PROGRESS = "prog AS (SELECT file, chunk, count(*) FILTER (is_done) AS done, count(*) AS total, 100.0::DOUBLE * count(*) FILTER (is_done) / count(*) AS pct FROM files GROUP BY file, chunk)"
_OF = lambda c: f"(length(seq) - length(replace(seq, '{c}', '')))"
_SUM_COUNTS = ", ".join(f"sum{_OF(c)} AS {c}" for c in ALPHABET)
_COMPOSITION = f"sums AS (SELECT {_SUM_COUNTS} FROM seqs), comp AS (" + " UNION ALL ".join(f"SELECT '{c}' AS ch, CAST({c} AS BIGINT) AS n FROM sums" for c in ALPHABET) + ")"
_PLOGP = " + ".join(f"CASE WHEN {_OF(c)} > 0 THEN ({_OF(c)}::DOUBLE / length(seq)) * log2({_OF(c)}::DOUBLE / length(seq)) ELSE 0.0::DOUBLE END" for c in ALPHABET)
_ENTROPY = f"ent AS (SELECT seq_id, CASE WHEN length(seq) > 0 THEN abs({_PLOGP}) END AS entropy FROM seqs)"
_SAMPLE = "sampled AS (SELECT * FROM seqs ORDER BY md5(seq_id), seq_id LIMIT {n})"
_GRAMS = "grams AS (SELECT seq_id, kmer, count(*) AS n FROM (SELECT seq_id, unnest(list_transform(range(1, length(seq) - 1), lambda i: substr(seq, i, 3))) AS kmer FROM {source} WHERE length(seq) >= 3) GROUP BY ALL)"
_PROFILE = "prof AS (SELECT g.seq_id, kmer, n, n::DOUBLE / (length(seq) - 2) AS freq FROM grams g JOIN {source} s USING (seq_id))"
_MSA = f"""{_FAMILY}, med AS (SELECT CAST(floor(median(length(seq))) AS INTEGER) AS len FROM fam),
    msa AS (SELECT seq_id, pos AS row, rpad(substr(seq, 1, len), len, '-') AS aligned FROM fam, med),
    cells AS (SELECT seq_id, row, i - 1 AS col, substr(aligned, CAST(i AS INTEGER), 1) AS ch FROM (SELECT seq_id, row, aligned, unnest(range(1, length(aligned) + 1)) AS i FROM msa)),
    cnt AS (SELECT col, ch, count(*) AS n, min(row) AS first_row FROM cells GROUP BY ALL)"""
_BG = f"{_SEQS}, {_COMPOSITION}, bg AS (SELECT ch, greatest(n::DOUBLE / sum(n) OVER (), 1e-10::DOUBLE) AS bg FROM comp)"
_COLUMNS = f"""{_MSA}, {_BG},
    cols AS (SELECT col, sum(n) AS rows, sum(CASE WHEN ch = '-' THEN n ELSE 0 END) AS gaps, sum(CASE WHEN ch <> '-' THEN n ELSE 0 END) AS total FROM cnt GROUP BY col),
    p0 AS (SELECT c.col, b.ch, b.bg, coalesce(k.n, 0)::DOUBLE / c.total AS p FROM cols c CROSS JOIN bg b LEFT JOIN cnt k ON k.col = c.col AND k.ch = b.ch WHERE c.total > 0),
    p1 AS (SELECT col, ch, bg, p, greatest(p, 1e-10::DOUBLE) / sum(greatest(p, 1e-10::DOUBLE)) OVER (PARTITION BY col) AS q FROM p0),
    hk AS (SELECT col, abs(sum(CASE WHEN p > 0 THEN p * log2(p) ELSE 0.0::DOUBLE END)) AS h, sum(q * log2(q / bg)) AS kl FROM p1 GROUP BY col),
    prof AS (SELECT cols.col, cols.gaps::DOUBLE / cols.rows AS gap_frac, h, kl FROM cols LEFT JOIN hk USING (col)),
    sm AS (SELECT *, sum(coalesce(h, log2(20))) OVER w / 10 AS smooth_h, sum(coalesce(kl, log2(20))) OVER w / 10 AS smooth_kl FROM prof WINDOW w AS (ORDER BY col ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)),
    kept AS (SELECT col, col - row_number() OVER (ORDER BY col) AS island FROM sm WHERE smooth_h < {{threshold}} AND gap_frac < 0.5),
    runs AS (SELECT min(col) AS start, max(col) AS "end", count(*) AS length FROM kept GROUP BY island HAVING count(*) >= 5),
    blocks AS (SELECT row_number() OVER (ORDER BY start) AS block, * FROM runs),
    con AS (SELECT col, coalesce(arg_max(ch, n * 1000000 - first_row) FILTER (ch <> '-'), '-') AS ch FROM cnt GROUP BY col)"""


def _histogram(cte: str, rows: str, bins: int) -> str:
    return f"""WITH {cte}, x AS ({rows}), b AS (SELECT min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi FROM x),
        k AS (SELECT CAST(CASE WHEN hi > lo THEN least(floor((x - lo) / (hi - lo) * {bins}) + 1, {bins}) ELSE 1 END AS INTEGER) AS bin, count(*) AS n FROM x, b WHERE x IS NOT NULL GROUP BY 1)
        SELECT CAST(s.bin AS INTEGER) AS bin, round(lo + (s.bin - 1) * ((hi - lo) / {bins}), 6) AS lo, round(lo + s.bin * ((hi - lo) / {bins}), 6) AS hi, coalesce(n, 0) AS n
        FROM (SELECT unnest(range(1, {bins + 1})) AS bin) s CROSS JOIN b LEFT JOIN k ON k.bin = s.bin"""


def _colour(score: str) -> str:
    fade = lambda x: f"lpad(lower(to_hex(CAST(floor(({x}) * 255) AS BIGINT))), 2, '0')"
    return f"CASE WHEN {score} >= 0.5 THEN '0xff' || {fade(f'1.0::DOUBLE - ({score} - 0.5) * 2')} || {fade(f'1.0::DOUBLE - ({score} - 0.5) * 2')} ELSE '0x' || {fade(f'{score} * 2')} || {fade(f'{score} * 2')} || 'ff' END"


_BUCKET = "CASE WHEN pct = 100 THEN '100%' WHEN pct = 0 THEN '0%' ELSE CAST(CAST(floor(pct / 10) * 10 AS INTEGER) AS VARCHAR) || '-' || CAST(CAST(floor(pct / 10) * 10 AS INTEGER) + 10 AS VARCHAR) || '%' END"
_OWN = "own AS (SELECT * FROM hits WHERE query <> target)"
_SCORES = f"""{_COLUMNS.format(threshold='1.0')}, res AS (SELECT seq_id, sum(CASE WHEN ch <> '-' THEN 1 ELSE 0 END) OVER (PARTITION BY seq_id ORDER BY col) - 1 AS resi, col, ch FROM cells),
    scored AS (SELECT seq_id, resi, res.col AS col, least(greatest(1.0::DOUBLE - coalesce(h, log2(20)) / log2(20.0::DOUBLE), 0), 1) AS score FROM res JOIN prof USING (col) WHERE ch <> '-')"""
#: Scores of the best alignments of the beginnings of pairs (p, sa, sb), a row of the matrix at a time: a
#: gap along the row is a running maximum of scores from which the gap line is taken off.
_NW = """dp AS (SELECT p, 0 AS i, j, -2 * j AS s FROM pairs, LATERAL (SELECT unnest(range(0, length(sb) + 1)) AS j)
    UNION ALL SELECT p, i, j, max(c + 2 * j) OVER (PARTITION BY p ORDER BY j) - 2 * j FROM (
        SELECT d.p, d.i + 1 AS i, d.j, CASE WHEN d.j = 0 THEN -2 * (d.i + 1) ELSE greatest(d.s - 2, lag(d.s) OVER (PARTITION BY d.p ORDER BY d.j) + CASE WHEN substr(sa, d.i + 1, 1) = substr(sb, d.j, 1) THEN 1 ELSE -1 END) END AS c
        FROM dp d JOIN pairs USING (p) WHERE d.i < length(sa)))"""
_EVALUE_IDS = "ids AS (SELECT DISTINCT query AS seq_id FROM hits)"


def oracle_sql(threshold: float) -> dict[str, str]:
    """threshold: the entropy under which the padded family's columns count as conserved."""
    columns = _COLUMNS.format(threshold=threshold)
    scores = _SCORES
    return {
        "hits_similar_topk": f"WITH {_HITS} SELECT target, fident, alnlen, round(log10(evalue), 6) AS log10_evalue, bits FROM hits WHERE query = 'P7' AND target <> 'P7' AND evalue <= 1e-10 ORDER BY evalue, target, l_orderkey, l_linenumber LIMIT 50",
        "hits_overview_totals": f"WITH {_HITS} SELECT count(*) AS total, count(*) FILTER (query <> target) AS non_self, count(DISTINCT query) AS queries, count(DISTINCT target) AS targets FROM hits",
        "hits_evalue_thresholds": f"WITH {_HITS}, {_OWN} " + " UNION ALL ".join(f"SELECT {i} AS nth, CAST({t!r} AS DOUBLE) AS threshold, count(*) FILTER (evalue <= {t!r}) AS n, round(100.0::DOUBLE * count(*) FILTER (evalue <= {t!r}) / nullif(count(*), 0), 6) AS pct FROM own" for i, t in enumerate(EVALUE_THRESHOLDS)),
        "hits_identity_buckets": f"WITH {_HITS}, {_OWN} " + " UNION ALL ".join(f"SELECT CAST({a} AS DOUBLE) AS lo, CAST({b} AS DOUBLE) AS hi, count(*) FILTER ({c}) AS n, round(100.0::DOUBLE * count(*) FILTER ({c}) / nullif(count(*), 0), 6) AS pct FROM own" for a, b, c in [(a, b, f"fident >= {a} AND fident < {b}") for a, b in IDENTITY_BUCKETS] + [(1.0, 1.0, "fident = 1.0")]),
        "hits_per_query_top10": f"WITH {_HITS}, {_OWN} SELECT query, count(*) AS n FROM own GROUP BY query ORDER BY n DESC, query LIMIT 10",
        "hits_per_query": f"WITH {_HITS}, {_OWN} SELECT query, count(*) AS n FROM own GROUP BY query",
        "hits_best_per_pair": f"WITH {_HITS} SELECT query, target, round(log10(min(evalue)), 6) AS log10_evalue FROM hits GROUP BY query, target",
        "hits_query_status": f"WITH {_HITS}, {_SEQS} SELECT q AS query, CASE WHEN EXISTS (SELECT 1 FROM hits WHERE query = q) THEN 'hits' WHEN EXISTS (SELECT 1 FROM seqs WHERE seq_id = q) THEN 'no hits' ELSE 'not found' END AS status FROM (VALUES ('P7'), ('S7'), ('none')) t(q)",
        "hits_evalue_hist": _histogram(_HITS, "SELECT round(-log10(greatest(evalue, 1e-300)), 6) AS x FROM hits WHERE query <> target", 80),
        "hits_bits_hist": _histogram(_HITS, "SELECT bits AS x FROM hits WHERE query <> target", 80),
        "hits_fident_hist": _histogram(_HITS, "SELECT fident AS x FROM hits WHERE query <> target", 50),
        "hits_per_query_hist": _histogram(_HITS, "SELECT count(*) AS x FROM hits WHERE query <> target GROUP BY query", 50),
        "hits_export_fasta": f"WITH {_HITS}, {_SEQS}, top AS (SELECT * FROM hits WHERE query = 'P7' AND target <> 'P7' AND evalue <= 1e-10 ORDER BY evalue, target, l_orderkey, l_linenumber LIMIT 50) SELECT target, md5('>' || target || ' fident=' || printf('%.3f', top.fident) || chr(10) || seq) AS record FROM top JOIN seqs ON 'P' || pos = target",
        "seq_length_stats": f"WITH {_SEQS} SELECT count(*) AS n, min(length(seq)) AS min_len, max(length(seq)) AS max_len, round(avg(length(seq)), 6) AS mean_len, median(length(seq)) AS median_len, round(stddev_pop(length(seq)), 6) AS std_len FROM seqs",
        "seq_length_hist": _histogram(_SEQS, "SELECT length(seq) AS x FROM seqs", 60),
        "seq_length_boxplot": f"WITH {_SEQS}, q AS (SELECT quantile_cont(length(seq), 0.25) AS q1, quantile_cont(length(seq), 0.5) AS q2, quantile_cont(length(seq), 0.75) AS q3 FROM seqs), e AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q) SELECT any_value(q1)::DOUBLE AS q1, any_value(q2)::DOUBLE AS q2, any_value(q3)::DOUBLE AS q3, min(length(seq)) FILTER (length(seq) BETWEEN lo AND hi) AS whisker_low, max(length(seq)) FILTER (length(seq) BETWEEN lo AND hi) AS whisker_high, count(*) FILTER (NOT length(seq) BETWEEN lo AND hi) AS outliers FROM seqs, e",
        "seq_complexity_flags": f"WITH {_SEQS} SELECT count(*) FILTER (length(seq) < 5) AS very_short, count(*) FILTER (len(list_distinct(string_split(seq, ''))) - CASE WHEN seq = '' THEN 1 ELSE 0 END <= 2) AS low_complexity, count(*) AS n FROM seqs",
        "seq_fasta_stats": "WITH " + _SEQS + " SELECT count(*) AS proteins, sum(length(seq))::BIGINT AS residues FROM seqs",
        "seq_global_composition": f"WITH {_SEQS}, {_COMPOSITION} SELECT ch, n, round(100.0::DOUBLE * n / sum(n) OVER (), 6) AS pct FROM comp",
        "seq_letter_usage": f"WITH {_SEQS} SELECT ch, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS pct FROM (SELECT unnest(string_split(seq, '')) AS ch FROM seqs WHERE seq <> '') GROUP BY ch",
        "seq_composition_matrix": f"WITH {_SEQS} SELECT seq_id, " + ", ".join(f"round({_OF(c)}::DOUBLE / nullif(length(seq), 0), 6) AS f_{c}" for c in ALPHABET) + " FROM seqs",
        "seq_entropy": f"WITH {_SEQS}, {_ENTROPY} SELECT seq_id, round(entropy, 6) AS entropy FROM ent",
        "seq_entropy_all_letters": f"WITH {_SEQS}, k AS (SELECT seq_id, ch, count(*) AS n FROM (SELECT seq_id, unnest(string_split(seq, '')) AS ch FROM seqs WHERE seq <> '') GROUP BY ALL), e AS (SELECT seq_id, abs(log2(sum(n)) - sum(n * log2(n)) / sum(n)) AS entropy FROM k GROUP BY seq_id) SELECT seq_id, round(coalesce(entropy, 0.0::DOUBLE), 6) AS entropy FROM seqs LEFT JOIN e USING (seq_id)",
        "seq_entropy_summary": f"WITH {_SEQS}, {_ENTROPY} SELECT round(min(entropy), 6) AS min_h, round(max(entropy), 6) AS max_h, round(avg(entropy), 6) AS mean_h, round(median(entropy), 6) AS median_h, round(log2(20), 6) AS max_possible FROM ent",
        "seq_entropy_hist": _histogram(f"{_SEQS}, {_ENTROPY}", "SELECT round(entropy, 6) AS x FROM ent", 50),
        "seq_validate": f"WITH {_SEQS}, {_STRUCTURES} SELECT a.seq_id, length(a.seq) AS len, coalesce(length(s.seq), -1) AS other_len, CASE WHEN s.seq_id IS NULL THEN 'MISSING' ELSE 'LENGTH MISMATCH' END AS status FROM seqs a LEFT JOIN structures s USING (seq_id) WHERE s.seq_id IS NULL OR length(a.seq) <> length(s.seq)",
        "seq_bad_chars": f"SELECT 'D' || doc_id AS seq_id, bad FROM (SELECT doc_id, array_to_string(list_sort(list_filter(list_distinct(string_split(coalesce(text, ''), '')), lambda c: c <> '' AND NOT contains('{ALPHABET}', c))), '') AS bad FROM documents) WHERE bad <> ''",
        "seq_dominant_char": f"WITH {_SEQS}, k AS (SELECT seq_id, ch, count(*) AS n, length(any_value(seq)) AS len FROM (SELECT seq_id, seq, unnest(string_split(seq, '')) AS ch FROM seqs WHERE seq <> '') GROUP BY seq_id, ch), b AS (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY n DESC, ch) AS nth FROM k) SELECT seq_id, ch, round(n::DOUBLE / len, 6) AS share FROM b WHERE nth = 1 AND n::DOUBLE / len > 0.2",
        "seq_lookup": f"WITH {_SEQS}, {_STRUCTURES} SELECT s.seq_id, md5(s.seq) AS structure, md5(coalesce(a.seq, '(not found in combined AA FASTA)')) AS aa, length(a.seq) AS aa_len, length(s.seq) AS structure_len FROM structures s LEFT JOIN seqs a USING (seq_id) WHERE s.seq_id = 'S0'",
        "seq_fuzzy_lookup": f"WITH {_SEQS} SELECT pos, seq_id FROM seqs WHERE contains(seq_id, '7') ORDER BY pos, seq_id LIMIT 10",
        "seq_sample": f"WITH {_SEQS}, {_SAMPLE.format(n=200)} SELECT seq_id, pos, length(seq) AS len FROM sampled",
        "aa_normalise": "SELECT doc_id, md5(regexp_replace(upper(replace(coalesce(text, ''), 'ß', 'SS')), '[UZOB]', 'X', 'g')) AS normalised FROM documents",
        "aa_prompt": f"WITH {_SEQS} SELECT seq_id, md5('<AA2fold> ' || array_to_string(string_split(seq, ''), ' ')) AS prompt, md5(lower(replace(seq, ' ', ''))) AS decoded, CASE WHEN seq <> '' THEN '<AA2fold>' ELSE '<fold2AA>' END AS tag, substr(seq_id, 1, 15) AS label FROM seqs",
        "uniprot_extract": "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'sp|' || p || '|' || c_mktsegment WHEN 1 THEN 'AF-' || p || '-F1' WHEN 2 THEN p WHEN 3 THEN 'WP_' || c_custkey || '.1' ELSE c_name END AS name, CASE WHEN c_custkey % 5 < 3 THEN p END AS accession FROM (SELECT *, 'P' || lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS p FROM customer)",
        "kmer_counts": f"WITH {_SEQS}, {_GRAMS.format(source='seqs')} SELECT kmer, sum(n)::BIGINT AS n, count(*) AS seqs FROM grams GROUP BY kmer",
        "kmer_profile": f"WITH {_SEQS}, {_GRAMS.format(source='seqs')}, {_PROFILE.format(source='seqs')} SELECT seq_id, kmer, n, round(freq, 6) AS freq FROM prof",
        "kmer_features": f"WITH {_SEQS}, {_GRAMS.format(source='seqs')} SELECT (SELECT count(*) FROM seqs) AS seqs, round((SELECT count(*) FROM grams)::DOUBLE / (SELECT count(*) FROM seqs), 6) AS mean_features, (SELECT count(*) FROM seqs WHERE length(seq) < 3) AS excluded",
        "kmer_jsd": f"WITH {_SEQS}, {_SAMPLE.format(n=50)}, {_GRAMS.format(source='sampled')}, {_PROFILE.format(source='sampled')}, s AS (SELECT a.seq_id AS id_i, b.seq_id AS id_j, 1.0::DOUBLE + sum(a.freq * log2(a.freq / ((a.freq + b.freq) / 2)) + b.freq * log2(b.freq / ((a.freq + b.freq) / 2)) - a.freq - b.freq) / 2 AS jsd FROM prof a JOIN prof b ON a.kmer = b.kmer AND a.seq_id < b.seq_id GROUP BY 1, 2) SELECT i.seq_id AS id_i, j.seq_id AS id_j, round(greatest(0.0::DOUBLE, coalesce(jsd, 1.0::DOUBLE)), 6) AS jsd FROM sampled i JOIN sampled j ON i.seq_id < j.seq_id AND length(i.seq) >= 3 AND length(j.seq) >= 3 LEFT JOIN s ON s.id_i = i.seq_id AND s.id_j = j.seq_id",
        "seq_composition_heatmap": f"WITH {_SEQS}, {_SAMPLE.format(n=200)}, r AS (SELECT row_number() OVER (ORDER BY pos) - 1 AS row, seq FROM sampled) SELECT row, k AS col, ch, round(CASE WHEN seq = '' THEN 0.0::DOUBLE ELSE (length(seq) - length(replace(seq, ch, '')))::DOUBLE / length(seq) END, 6) AS value FROM r, (SELECT k, substr('{ALPHABET}', CAST(k + 1 AS INTEGER), 1) AS ch FROM range(0, 20) t(k))",
        "kmer_jsd_heatmap": f"WITH {_SEQS}, {_SAMPLE.format(n=50)}, {_GRAMS.format(source='sampled')}, {_PROFILE.format(source='sampled')}, s AS (SELECT a.seq_id AS id_i, b.seq_id AS id_j, 1.0::DOUBLE + sum(a.freq * log2(a.freq / ((a.freq + b.freq) / 2)) + b.freq * log2(b.freq / ((a.freq + b.freq) / 2)) - a.freq - b.freq) / 2 AS jsd FROM prof a JOIN prof b ON a.kmer = b.kmer AND a.seq_id < b.seq_id GROUP BY 1, 2), j AS (SELECT i.seq_id AS id_i, j.seq_id AS id_j, round(greatest(0.0::DOUBLE, coalesce(jsd, 1.0::DOUBLE)), 6) AS jsd FROM sampled i JOIN sampled j ON i.seq_id < j.seq_id AND length(i.seq) >= 3 AND length(j.seq) >= 3 LEFT JOIN s ON s.id_i = i.seq_id AND s.id_j = j.seq_id), n AS (SELECT seq_id, row_number() OVER (ORDER BY seq_id) - 1 AS nth FROM sampled WHERE length(seq) >= 3), h AS (SELECT a.nth AS x, b.nth AS y, jsd FROM j JOIN n a ON a.seq_id = id_i JOIN n b ON b.seq_id = id_j) SELECT x AS row, y AS col, jsd AS value FROM h UNION ALL SELECT y, x, jsd FROM h UNION ALL SELECT nth, nth, 0.0::DOUBLE FROM n",
        "dist_evalue": f"WITH {_HITS}, {_EVALUE_IDS}, b AS (SELECT least(query, target) AS a, greatest(query, target) AS b, min(evalue) AS e FROM hits WHERE query <> target GROUP BY 1, 2), s AS (SELECT i.seq_id AS id_i, j.seq_id AS id_j, -log10(greatest(least(coalesce(e, 10), 10), 1e-300)) AS score FROM ids i JOIN ids j ON i.seq_id < j.seq_id LEFT JOIN b ON b.a = i.seq_id AND b.b = j.seq_id), m AS (SELECT greatest(max(score), 0) AS m FROM s) SELECT id_i, id_j, round(score, 6) AS score, round(CASE WHEN m > 0 THEN score / m ELSE score END, 6) AS normalised, round(1.0::DOUBLE - CASE WHEN m > 0 THEN score / m ELSE score END, 6) AS distance FROM s, m",
        "dist_nw": f"""WITH RECURSIVE {_FAMILY}, pairs AS MATERIALIZED (SELECT row_number() OVER () AS p, a.seq_id AS id_i, b.seq_id AS id_j, a.seq AS sa, b.seq AS sb FROM fam a JOIN fam b ON a.seq_id < b.seq_id), {_NW}
            SELECT id_i, id_j, s AS score, greatest(length(sa), length(sb))::BIGINT AS longest, round(greatest(0.0::DOUBLE, 1.0::DOUBLE - s::DOUBLE / nullif(greatest(length(sa), length(sb)), 0)), 6) AS distance FROM pairs JOIN dp USING (p) WHERE i = length(sa) AND j = length(sb)""",
        "nw_alignments": f"""WITH RECURSIVE {_FAMILY}, pairs AS MATERIALIZED (SELECT a.pos AS p, a.seq_id, b.seq_id AS id_b, a.seq AS sa, b.seq AS sb FROM fam a JOIN fam b ON b.pos = a.pos + 1), {_NW}, cells AS MATERIALIZED (SELECT * FROM dp),
            walk AS (SELECT p, length(sa)::BIGINT AS i, length(sb)::BIGINT AS j, '' AS a, '' AS b FROM pairs
            UNION ALL SELECT p, i - CAST(move < 2 AS BIGINT), j - CAST(move <> 1 AS BIGINT), CASE WHEN move < 2 THEN substr(sa, i, 1) ELSE '-' END || a, CASE WHEN move <> 1 THEN substr(sb, j, 1) ELSE '-' END || b FROM (
                SELECT w.*, sa, sb, CASE WHEN w.i > 0 AND w.j > 0 AND c.s = d.s + CASE WHEN substr(sa, w.i, 1) = substr(sb, w.j, 1) THEN 1 ELSE -1 END THEN 0 WHEN w.i > 0 AND c.s = u.s - 2 THEN 1 ELSE 2 END AS move
                FROM walk w JOIN pairs USING (p) JOIN cells c ON c.p = w.p AND c.i = w.i AND c.j = w.j LEFT JOIN cells d ON d.p = w.p AND d.i = w.i - 1 AND d.j = w.j - 1 LEFT JOIN cells u ON u.p = w.p AND u.i = w.i - 1 AND u.j = w.j
                WHERE w.i > 0 OR w.j > 0))
            SELECT seq_id, id_b, a, b FROM pairs JOIN walk USING (p) WHERE i = 0 AND j = 0""",
        "jukes_cantor": "SELECT t, CASE WHEN t <= 0 THEN 1.0::DOUBLE ELSE round(1.0::DOUBLE / 20 + 19.0::DOUBLE / 20 * exp(-20 * t / 19), 9) END AS p_same, CASE WHEN t <= 0 THEN 0.0::DOUBLE ELSE round((1.0::DOUBLE - exp(-20 * t / 19)) / 20, 9) END AS p_diff FROM (SELECT DISTINCT l_discount AS t FROM lineitem)",
        "chunk_split": f"WITH {_QUEUE} SELECT accession, nth // CAST(ceil((SELECT count(*) FROM acc) / 12) AS BIGINT) AS chunk FROM acc",
        "chunk_fixed": f"WITH {_QUEUE} SELECT accession, chunk, file FROM files",
        "chunk_call_batches": f"WITH {_QUEUE}, o AS (SELECT accession, (row_number() OVER (ORDER BY accession) - 1) // 50 AS chunk FROM acc) SELECT chunk, string_agg(accession, ',' ORDER BY accession) AS accessions FROM o GROUP BY chunk",
        "chunk_dedup_ordered": "SELECT accession, min(pos) AS pos FROM (SELECT 'C' || o_custkey AS accession, o_orderkey AS pos FROM orders) GROUP BY accession",
        "chunk_remaining": f"WITH {_QUEUE} SELECT accession FROM acc WHERE NOT is_done",
        "chunk_remove_completed": f"WITH {_QUEUE} SELECT file, accession FROM files WHERE NOT is_done",
        "chunk_removal_report": f"WITH {_QUEUE}, {_PROGRESS} SELECT file, done AS removed, total - done AS kept, total = done AS deleted FROM prog",
        "chunk_progress": f"WITH {_QUEUE}, {_PROGRESS} SELECT file, done, total, round(pct, 6) AS pct FROM prog",
        "chunk_overall": f"WITH {_QUEUE}, {_PROGRESS} SELECT sum(done)::BIGINT AS done, sum(total - done)::BIGINT AS remaining, sum(total)::BIGINT AS total, round(100.0::DOUBLE * sum(done) / sum(total), 6) AS pct, count(*) FILTER (done = total) AS full, count(*) FILTER (done > 0 AND done < total) AS partly, count(*) FILTER (done = 0) AS not_started FROM prog",
        "chunk_progress_runs": f"WITH {_QUEUE}, {_PROGRESS}, m AS (SELECT *, {_BUCKET} AS bucket, row_number() OVER (ORDER BY chunk) AS nth FROM prog), l AS (SELECT *, CASE WHEN lag(bucket) OVER (ORDER BY nth) = bucket THEN 0 ELSE 1 END AS st FROM m), g AS (SELECT *, sum(st) OVER (ORDER BY nth) AS run FROM l) SELECT run::BIGINT AS run, any_value(bucket) AS bucket, count(*) AS chunks, sum(done)::BIGINT AS done, sum(total)::BIGINT AS total, round(100.0::DOUBLE * sum(done) / sum(total), 6) AS pct, CASE WHEN count(*) = 1 THEN min(file) ELSE arg_min(file, nth) || ' .. ' || arg_max(file, nth) END AS label FROM g GROUP BY run",
        "chunk_hist": f"WITH {_QUEUE}, {_PROGRESS} SELECT CAST(b AS INTEGER) AS bin, count(pct) AS n FROM (SELECT unnest(range(0, 10)) AS b) LEFT JOIN prog ON CAST(least(floor(pct / 10), 9) AS INTEGER) = b GROUP BY b",
        "accession_dups": "SELECT accession, count(*) AS n, arg_min(source, pos) AS first_source FROM (SELECT 'C' || o_custkey AS accession, o_orderkey AS pos, o_orderpriority AS source FROM orders) GROUP BY accession HAVING count(*) > 1",
        "sweep_settings": "SELECT * FROM (SELECT DISTINCT l_linenumber::BIGINT AS threads FROM lineitem), (SELECT DISTINCT 50 * p_size::BIGINT AS split_length FROM part), (SELECT DISTINCT r_regionkey::BIGINT + 1 AS rep FROM region)",
        "benchmark_rates": "SELECT s_suppkey AS accession, round(n::DOUBLE / t, 6) AS proteins_per_s, round(r / t, 6) AS residues_per_s FROM (SELECT l_suppkey AS s_suppkey, count(*) AS n, sum(l_quantity) AS r, sum(l_extendedprice) AS t FROM lineitem GROUP BY 1)",
        "genomes_by_residues": f"WITH {_SEQS} SELECT source AS assembly, count(*) AS proteins, sum(length(seq))::BIGINT AS residues, row_number() OVER (ORDER BY sum(length(seq)), source) AS rank FROM seqs JOIN documents ON doc_id = pos GROUP BY source",
        "rest_pages_limit": "SELECT page, pos, accession FROM (SELECT o_orderkey // 100 AS page, CAST(o_orderkey % 100 AS INTEGER) AS pos, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) END AS accession FROM orders) WHERE accession IS NOT NULL ORDER BY page, pos LIMIT 250",
        "meta_explode": "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, min(event_id) AS first_event FROM events GROUP BY 1",
        "embedding_mean_pool": "SELECT label, i AS pos, round(avg(CAST(embedding[i + 1] AS DOUBLE)), 6) AS mean FROM (SELECT label, embedding, unnest(range(0, 64)) AS i FROM embeddings) GROUP BY label, i",
        "translate_letters": f"WITH {_SEQS} SELECT seq_id, md5(translate(seq, '{ALPHABET}', '{ALPHABET[1:] + ALPHABET[0]}')) AS translated FROM seqs",
        "tree_fitch": f"""WITH RECURSIVE {_MSA}, leaf AS (SELECT col, dense_rank() OVER (ORDER BY row) - 1 AS i, 1::BIGINT << CAST(instr('{ALPHABET}-', ch) - 1 AS INTEGER) AS mask FROM cells),
            fold AS (SELECT col, i, mask, 0::BIGINT AS changes FROM leaf WHERE i = 0
                UNION ALL SELECT f.col, l.i, CASE WHEN f.mask & l.mask <> 0 THEN f.mask & l.mask ELSE f.mask | l.mask END, f.changes + CASE WHEN f.mask & l.mask = 0 THEN 1 ELSE 0 END FROM fold f JOIN leaf l ON l.col = f.col AND l.i = f.i + 1)
            SELECT CAST(col AS BIGINT) AS site, changes FROM fold WHERE i = (SELECT max(i) FROM leaf)""",
        "msa_simple_pad": f"WITH {_MSA} SELECT seq_id, row, aligned FROM msa",
        "msa_column_entropy": f"WITH {columns} SELECT col, round(h, 6) AS h FROM prof",
        "msa_gap_fraction": f"WITH {columns} SELECT col, round(gap_frac, 6) AS gap_frac FROM prof",
        "msa_kl": f"WITH {columns} SELECT col, round(kl, 6) AS kl FROM prof",
        "msa_smooth": f"WITH {columns} SELECT col, round(smooth_h, 6) AS smooth_h, round(smooth_kl, 6) AS smooth_kl FROM sm",
        "msa_blocks": f"WITH {columns} SELECT block, start, \"end\", length FROM blocks",
        "msa_block_table": f"WITH {columns} SELECT block, start, \"end\", length, round(avg(h), 3) AS mean_entropy, round(avg(kl), 3) AS mean_kl, round(avg(gap_frac), 3) AS gap_frac, substr(string_agg(con.ch, '' ORDER BY con.col), 1, 40) || CASE WHEN length > 40 THEN '...' ELSE '' END AS consensus FROM blocks JOIN prof ON col BETWEEN start AND \"end\" JOIN con USING (col) GROUP BY block, start, \"end\", length",
        "msa_coverage": f"WITH {columns} SELECT coalesce((SELECT sum(length) FROM blocks), 0)::BIGINT AS conserved, (SELECT count(*) FROM prof) AS columns, round(coalesce((SELECT sum(length) FROM blocks), 0)::DOUBLE / (SELECT count(*) FROM prof), 6) AS share",
        "msa_column_summary": f"WITH {columns} SELECT count(*) FILTER (h = 0) AS perfect, count(*) FILTER (h < 1.0) AS under_one, count(h) AS valid, round(min(h), 6) AS min_h, round(max(h), 6) AS max_h, round(avg(h), 6) AS mean_h, round(median(h), 6) AS median_h FROM prof",
        "msa_consensus": f"WITH {columns} SELECT col, ch FROM con",
        "msa_residue_scores": f"WITH {scores} SELECT seq_id, resi::BIGINT AS resi, col, round(score, 6) AS score FROM scored",
        "conservation_colours": f"WITH {scores}, s AS (SELECT seq_id, resi::BIGINT AS resi, round(score, 6) AS score FROM scored) SELECT seq_id, resi, {_colour('score')} AS colour FROM s",
        "viewer_bins": f"WITH {scores}, s AS (SELECT resi::BIGINT AS resi, round(score, 6) AS score FROM scored WHERE seq_id = 'B0') SELECT round(score, 2) AS bin, string_agg(CAST(resi + 1 AS VARCHAR), '+' ORDER BY resi) AS residues FROM s GROUP BY 1",
    }
