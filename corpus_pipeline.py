"""A corpus pipeline of five stages: language ID, near duplicates, decontamination, mixing, token ids.

Each stage takes rows with the columns of documents (doc_id, text, lang, source, n_chars) and judges every row by itself:
rows that share a doc_id, or have none, follow their own verdicts. Defined results:

* language_id: a row whose text is null or has no letter goes; the language of all others becomes the one that their text
  is nearest to, which is what later stages read;
* ngram_jaccard_join: of equal or near texts one row stays, that with the smallest doc_id; rows without words all stay;
* benchmark_decontamination: contaminated rows go; shorter benchmark passages are cut out of the rest, and n_chars follows;
* mixing_sources: a row stays if the hash of its doc_id falls under the rate of its source, language and topic (null ones
  are values of their own); rows without tokens take their cell's rate;
* token_id_output: one row for each row that is left, in ascending doc_id order, a null text being empty.

An empty table gives an empty result in every stage. Columns that documents doesn't have are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from foliant.llm import decontaminate, jaccard_join, language_id, mixture, token_store
from foliant.llm.common import bounded_batches, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, under the language that is found. Learned from these documents' own labels."""
    bounded_batches(spark)
    return language_id.with_language(docs, language_id.prototypes(docs), lang_col="lang")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of documents linked by five-word shingles at a similarity of 0.8 or more."""
    bounded_batches(spark)
    return jaccard_join.distinct_documents(docs, k=5, threshold=(80, 100))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than a twentieth of their words in 13-word windows of the benchmark, without those windows."""
    bounded_batches(spark)
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), chars_col="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics meet their target token weights."""
    bounded_batches(spark)
    return mixture.sample(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in seekable shards; one row a document with its place, length and checksum, read back from them."""
    bounded_batches(spark)
    root, shards = token_store.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read_digests(spark, root, shards)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing_sources", mix_sources),
    ("token_id_output", write_token_ids),
]

#: SQL can't express the hyperdimensional profiles and the tokenizer; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
