"""The corpus pipeline: documents to balanced training shards.

Five stages, each an operator of ``starloom.llm`` on all that its predecessor
kept; each result is written as Parquet and read again:

1. toxicity: documents whose score reaches 0.3 go (learned from ``labels``);
2. n-gram Jaccard join: of each group of near copies (five-word shingles,
   similarity 0.8) the document of the least (id, text key) stays;
3. benchmark decontamination: documents that contain at least 0.8 of a
   benchmark item's shingles go;
4. mixing: documents of under-represented domains are repeated until the domains'
   expected tokens match the target weights; no document is taken less than once;
5. sharding: eight contiguous shards of nearly equal bytes.

Stages 1 to 4 return the columns of ``documents``, whatever further columns they
have; stage 5 returns doc_id, size, text_crc32, law, shard, slot, grown_shard and the remaining columns
of documents. An empty table stays empty through all of them. Nulls, repeated rows and ties
are as the operators' modules say: a null or blank text is a text without words, of which one
row stays after stage 2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontamination, mixing, ngram_join, toxicity
from starloom.llm.common import table, written
from starloom.llm.queries import labelled_domains, shard_report

#: Target shares of expected tokens. Poor documents keep about their share, as no document is taken less than once.
WEIGHTS = {"en/good": 0.52, "fr/good": 0.13, "de/good": 0.12, "es/good": 0.09,
           "en/poor": 0.08, "fr/poor": 0.02, "de/poor": 0.02, "es/poor": 0.02}


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = labelled_domains(docs, table(spark, sf_dir, "labels"))
    return mixing.taken(docs, labelled, WEIGHTS, least_rate=1.0)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_report(docs, carry=("text", "lang", "source", "n_chars"))


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", one_of_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Learned models and iterative components are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
