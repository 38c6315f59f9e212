"""The registered queries: each applies its operator to its whole table with production parameters
and derives the digest columns that its contract asks for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import bpe, exact_dedup, language, line_dedup, merkle, neighbours, packing, secrets, sharding, simhash, toxicity, url_filter, whitening
from helixframe.llm._common import bucket_of

SHARDS = 40
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False).drop("ids")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["rank"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"), "live", "copied",
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.classify(table(spark, sf_dir, "documents"), keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (bucket_of(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst_start", "worst_end", "worst_score")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.train(docs, public_tokenizers.path("piece_bpe_32k.model")))
    return found.select("doc_id", (bucket_of(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES).drop("purity")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


#: Fields of a leaf, in the order of the manifest.
LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def manifest_digest(docs: DataFrame) -> DataFrame:
    """The manifest of documents whose texts were lower-cased where 3 divides the crc32 of the id."""
    fields = [F.translate("`text`", _UPPER, _LOWER) if f == "text" else F.col(f"`{f}`") for f in LEAF_FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_of(*fields))
    proved = merkle.manifest(docs, LEAF_FIELDS, "lang", "doc_id", tampered)
    return proved.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_digest(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def line_digest(docs: DataFrame, **settings) -> DataFrame:
    found = line_dedup.judged(docs, **settings)
    text, gone = F.coalesce("text", F.lit("")), F.col("gone")
    count = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return found.select("doc_id", count.cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"), F.sha2(line_dedup.kept_text(text, gone), 256).alias("kept_sha256"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digest(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_packing, op2_secret_scans, op3_exact_dedup, op4_bpe, op5_sharding, op6_toxicity, op7_language, op8_url_filter, op9_neighbours, op10_simhash, op11_merkle, op12_whitening, op13_line_dedup, pipeline)
    return {f.__name__: f for f in own}


def _url_sql(splits: int = 4) -> str:
    """The contract in SQL, the template tree for hosts that are split at `splits` levels at most."""
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    longest = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in longest) + " END"
    says = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in longest) + " END"
    prior = url_filter.PRIOR
    parts = [
        """rest AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN split_part(split_part(substr(url, instr(url, '://') + 3), '#', 1), '?', 1) ELSE '' END AS r FROM pages)""",
        """split AS (SELECT page_id, translate(split_part(r, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, substr(r, length(split_part(r, '/', 1)) + 1) AS path FROM rest)""",
        f"""ruled AS (SELECT page_id, host, path, {rule} AS rule, {says} AS says, [CASE WHEN regexp_matches(x, '^[0-9a-f]{{16,}}$') THEN '{{x}}' ELSE regexp_replace(x, '[0-9]+', '{{n}}', 'g') END FOR x IN string_split(substr(path, 2), '/')] AS shapes FROM split)""",
        """ways AS (SELECT host, shapes, count(DISTINCT path) AS paths, count(DISTINCT path) FILTER (says = 'block') AS b, count(DISTINCT path) FILTER (says = 'allow') AS a FROM ruled WHERE host <> '' GROUP BY ALL)""",
        f"""w0 AS (SELECT *, '' AS node, 0 AS pos, (sum(b) OVER h + {prior / 2}::DOUBLE) / (sum(b + a) OVER h + {prior}::DOUBLE) AS purity, sum(b) OVER h > 0 AND sum(a) OVER h > 0 AS mixed FROM ways WINDOW h AS (PARTITION BY host) QUALIFY sum(b + a) OVER h > 0)""",
    ]
    for k in range(splits):
        parts += [
            f"x{k} AS (SELECT host, node, i FROM w{k} CROSS JOIN range(0, 64) t(i) WHERE mixed AND pos < len(shapes) GROUP BY ALL HAVING min(len(shapes) - pos) >= i AND count(DISTINCT shapes[pos + 1 : pos + i]) = 1)",
            f"o{k} AS (SELECT w.*, pos + shared AS cut FROM w{k} w JOIN (SELECT host, node, max(i) AS shared FROM x{k} GROUP BY ALL) x USING (host, node) WHERE mixed AND pos < len(shapes))",
            f"s{k} AS (SELECT *, CASE WHEN cut < len(shapes) THEN '/' || shapes[cut + 1] ELSE '' END AS seg FROM o{k})",
            f"c{k} AS (SELECT host, node, seg, sum(paths) AS paths, sum(b) AS b, sum(a) AS a FROM s{k} GROUP BY ALL)",
            f"n{k} AS (SELECT host, node, seg, CASE WHEN seg = '' THEN '' WHEN paths = 1 THEN '/{{any}}' WHEN a + b > 0 AND count(*) FILTER (a + b > 0) OVER p > 1 AND abs(b::DOUBLE / (a + b) - sum(b) OVER p / sum(a + b) OVER p) <= {url_filter.Z} * sqrt(sum(b) OVER p / sum(a + b) OVER p * (1 - sum(b) OVER p / sum(a + b) OVER p) / (a + b)) THEN '/{{alike}}' ELSE seg END AS name FROM c{k} WINDOW p AS (PARTITION BY host, node))",
            f"w{k + 1} AS (SELECT host, shapes, paths, b, a, node || coalesce('/' || nullif(array_to_string(shapes[pos + 1 : cut], '/'), ''), CASE WHEN cut > pos THEN '/' ELSE '' END) || name AS node, least(cut + 1, len(shapes)) AS pos, CASE WHEN sum(b + a) OVER g > 0 THEN (sum(b) OVER g + {prior} * purity) / (sum(b + a) OVER g + {prior}) ELSE purity END AS purity, sum(b) OVER g > 0 AND sum(a) OVER g > 0 AS mixed FROM s{k} JOIN n{k} USING (host, node, seg) WINDOW g AS (PARTITION BY host, node, name))",
        ]
    ends = " UNION ALL ".join(f"SELECT host, shapes, node, pos, purity FROM w{k}" + ("" if k == splits else " WHERE NOT (mixed AND pos < len(shapes))") for k in range(splits + 1))
    return f"WITH {', '.join(parts)}, ends AS ({ends}) SELECT page_id, r.host, r.path, rule, coalesce(says, CASE WHEN purity >= {url_filter.REJECT} THEN 'block' ELSE 'allow' END) AS verdict, coalesce(node || CASE WHEN pos < len(r.shapes) THEN '/{{rest}}' ELSE '' END, '/{{rest}}') AS template FROM ruled r LEFT JOIN ends e ON e.host = r.host AND e.shapes = r.shapes"


def _merkle_sql(levels: int = 7, tops: int = 3) -> str:
    """The manifest in SQL, for trees of at most 8^levels leaves and 8^tops trees."""
    encoded = lambda f: f"coalesce(octet_length(encode(CAST({f} AS VARCHAR)))::VARCHAR || ':' || CAST({f} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(encoded(text if f == "text" else f) for f in LEAF_FIELDS) + ")"
    step = "list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda b, z: xor(b >> 1, (b & 1) * 3988292384))"
    crc = f"xor(list_reduce([4294967295] || [ord(x)::BIGINT FOR x IN string_split(CAST(doc_id AS VARCHAR), '')], lambda c, x: {step}), 4294967295)"
    parts = [
        f"""d AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} ELSE {leaf('text')} END AS now FROM documents)""",
        "t0 AS (SELECT lang, leaf AS x, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)",
        "own AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i0 FROM d)",
    ]

    def climb(name: str, first: str, many: int, by: str) -> None:
        for k in range(many):
            here = first if k == 0 else f"{name}{k}"
            again = f"count(*) OVER (PARTITION BY {by}) > 1" if by else "count(*) OVER () > 1"
            group = f"{by + ', ' if by else ''}i // 8"
            parts.append(f"{name}s{k} AS (SELECT *, {again} AS more FROM {here})")
            parts.append(f"{name}r{k} AS (SELECT {by + ', ' if by else ''}i // 8 AS r, list(x ORDER BY i) AS xs, any_value(more) AS more FROM {name}s{k} GROUP BY {group})")
            parts.append(f"{name}{k + 1} AS (SELECT {by + ', ' if by else ''}CASE WHEN more THEN sha256(array_to_string(xs, '')) ELSE xs[1] END AS x, r AS i FROM {name}r{k})")

    def ways(source: str, name: str, many: int, by: str) -> str:
        """source with the siblings on the way up, and what its present digest folds to."""
        for k in range(many):
            on = f"a.{by} IS NOT DISTINCT FROM r.{by} AND " if by else ""
            at = f"a.i0 // {8**k}"
            siblings = f"array_to_string(list_filter(xs, lambda x, n: n <> {at} % 8 + 1), '')"
            folded = f"sha256(array_to_string(xs[: {at} % 8], '') || a.now || array_to_string(xs[{at} % 8 + 2 :], ''))"
            parts.append(f"{source}{k} AS (SELECT a.* REPLACE (CASE WHEN r.more THEN a.way || {siblings} ELSE a.way END AS way, CASE WHEN r.more THEN {folded} ELSE a.now END AS now) FROM {source if k == 0 else f'{source}{k - 1}'} a JOIN {name}r{k} r ON {on}r.r = a.i0 // {8 ** (k + 1)})")
        return f"{source}{many - 1}"

    climb("t", "t0", levels, "lang")
    parts.append(f"u0 AS (SELECT x, lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM t{levels})")
    climb("u", "u0", tops, "")
    parts.append("p AS (SELECT doc_id, lang, leaf, now, i0, '' AS way FROM own)")
    low = ways("p", "t", levels, "lang")
    parts.append(f"q AS (SELECT a.doc_id, a.leaf, a.now, a.way, u.x AS subroot, u.i AS i0 FROM {low} a JOIN u0 u ON a.lang IS NOT DISTINCT FROM u.lang)")
    high = ways("q", "u", tops, "")
    return f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, root, sha256(way) AS proof_sha256, now AS folded_root, now = root AS verified FROM {high} CROSS JOIN (SELECT x AS root FROM u{tops})"


def _line_sql() -> str:
    key = f"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}')"
    return f"""
            WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
            l AS (SELECT doc_id, pos, line, {key} AS key FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d)),
            k AS (SELECT key, count(DISTINCT doc_id) AS docs, max(doc_id) AS holder FROM l WHERE length(key) >= {line_dedup.LEAST_CHARS} GROUP BY key),
            m AS (SELECT l.*, coalesce(docs >= {line_dedup.LEAST_DOCS} AND holder <> doc_id, false) AS gone FROM l LEFT JOIN k USING (key))
            SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where it can express the contract."""
    return {
        "op3_exact_dedup": """
            WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id) AS r FROM documents)
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
            FROM d WINDOW w AS (PARTITION BY t)""",
        "op8_url_filter": _url_sql(),
        "op11_merkle": _merkle_sql(),
        "op13_line_dedup": _line_sql(),
    }
