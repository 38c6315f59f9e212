"""Corpus pipeline: five stages, each over all that the one before it kept.

Every stage but the last returns the columns of `documents`; each result is written to the shared
folder and read again, so a lost executor costs one stage at most. Extra columns, also ones whose
names clash with those of an operator, go through every stage but the last, and an empty table gives
an empty result in all of them; what the other odd rows become is said at each stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import exact_dedup, packing, secrets, simhash, toxicity
from helixframe.llm._common import keep_rows_not_in, row_key
from helixframe.storage import release, scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the multiple-instance model scores under 0.5 stay, each row judged by its whole
    text: null and empty texts score 0 and stay, repeated rows and null ids are rows like any other."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays; a null text equals an empty one, a null
    id stays only if no other row of the text has an id, and of one id with one text a single row."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by 0.8 or more of their five-word shingles, the document with the smallest id
    stays; a null id stays only if no member has an id. Rows are told apart by id and text, so rows
    that share an id are judged each by its own text; texts without a word are alike."""
    found = simhash.near_copies(docs)
    dropped = scratch(found.filter("key <> kept").select(F.col("key").alias("dropped")), "near-dropped")
    return keep_rows_not_in(docs, row_key(F.col("doc_id"), F.col("text")), dropped, "dropped")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Owner-specific credentials are masked in place and n_chars is set anew; every document stays,
    null and empty texts unchanged, and rows with a null id are masked like any other."""
    return secrets.mask_live(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids, as the packing operator returns them: a null or empty text is
    its end id alone, a null id is carried through, and repeated rows are packed each time."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=20_000)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("SimHash near-dedup", drop_near_copies), ("secret scans", mask_secrets), ("packing", pack)]

#: The stages learn, hash with functions that DuckDB lacks and tokenize: SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = []
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        release(*before)
        before = [docs]
    return docs
