import duckdb
import pytest

from helixframe.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_against_duckdb(name, folder, spark):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    got, want = queries.queries()[name](spark, folder).toPandas(), con.execute(queries.oracle_sql()[name]).df()
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    rows = [sorted((tuple(None if x is None or x != x else str(x) for x in r) for r in f[names].itertuples(index=False)), key=repr) for f in (got, want)]
    assert rows[0] == rows[1]


def test_contract_columns(spark, small):
    expected = {
        "op1_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset", "op2_secret_scans": "doc_id n_assign n_access n_hex base_sha256 spans", "op3_exact_dedup": "doc_id keep_id group_size kept text_sha256",
        "op4_bpe": "doc_id n_tokens ids_sha256 decoded_sha256", "op5_sharding": "doc_id size text_crc32 law shard slot grown_shard", "op6_toxicity": "doc_id held_out score predicted", "op7_language": "doc_id held_out lang_pred score",
        "op8_url_filter": "page_id host path rule verdict", "op9_neighbours": "query_id rank vec_id score", "op10_simhash": "doc_id fingerprint component_id",
        "op11_merkle": "doc_id leaf subroot root proof_sha256 folded_root verified", "op12_whitening": "vec_id component n deviation whitened explained identity_error", "op13_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    }
    for name, columns in expected.items():
        assert queries.queries()[name](spark, small).columns[: len(columns.split())] == columns.split()
