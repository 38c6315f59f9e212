"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from helixframe.plans import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL, RUN = queries.oracle_sql(), queries.queries()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    return con


def plain(frame):
    def one(x):
        if x is None or x is pd.NA or x is pd.NaT or (not isinstance(x, str) and x != x):
            return None
        return str(x) if isinstance(x, (str, bool)) or type(x).__name__ == "bool_" else float(x)

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(one, row)) for row in frame.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_duckdb(name, spark, small, duck):
    got, want = RUN[name](spark, small).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(RUN)


@pytest.mark.parametrize("name", ["search_all_vs_all", "tree_rf", "pca_scree", "ward_clusters", "average_clusters", "dendrogram_last_merges", "cluster_summary", "tree_wpgma", "msa_progressive", "tree_nj", "tree_upgma", "tree_merges", "tree_loglik"])
def test_others_give_rows(name, spark, small):
    assert RUN[name](spark, small).count() > 0


def test_entry_without_corpus_operators():
    import __spark_entry__ as e

    assert set(SQL) <= set(e.oracle_sql()) and set(RUN) <= set(e.queries())
    found = [f for f in glob.glob(os.path.join(os.path.dirname(e.__file__), "helixframe", "**", "*.py"), recursive=True) if f"{os.sep}llm{os.sep}" not in f and "helixframe.llm" in open(f).read()]
    assert found == []
