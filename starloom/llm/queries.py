"""Registered queries of the subpackage: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import attribution, decontamination, fast_sketch, html_extract, mixing, ngram_join, periodic_runs, quality_rules, sharding, spelling_variants, substring_dedup, toxicity, warc
from starloom.llm.common import table
from starloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: Target shares of expected tokens by language and quality.
DOMAIN_WEIGHTS = {"en/good": 0.50, "fr/good": 0.15, "de/good": 0.15, "es/good": 0.10,
                  "en/poor": 0.04, "fr/poor": 0.02, "de/poor": 0.02, "es/poor": 0.02}
#: Vocabulary of the token counts, unless STARLOOM_VOCABULARY names another.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: DuckDB: distinct five-word shingles of documents and benchmark items (shorter texts: all their words), and of documents
#: the runs of as many words as items of fewer have.
SQL_SHINGLES = r"""
texts AS (SELECT 'doc' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'item', item_id, text FROM benchmark),
split_words AS (SELECT kind, id, unnest(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+')) AS w,
                generate_subscripts(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), 1) AS pos FROM texts),
runs AS (SELECT kind, id, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4, lead(w, 4) OVER p AS w5,
         row_number() OVER p AS nth FROM split_words WHERE w <> '' WINDOW p AS (PARTITION BY kind, id ORDER BY pos)),
short AS (SELECT DISTINCT n FROM (SELECT max(nth) AS n FROM runs WHERE kind = 'item' GROUP BY id) WHERE n < 5),
shingles AS (SELECT DISTINCT kind, id, concat_ws(' ', w, w2, w3, w4, w5) AS s FROM runs WHERE w5 IS NOT NULL OR nth = 1
             UNION SELECT kind, id, array_to_string([w, w2, w3, w4][:n], ' ') FROM runs, short
             WHERE kind = 'doc' AND [w, w2, w3, w4][n] IS NOT NULL)"""


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


def shard_report(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    placed = sharding.byte_shards(docs, 8, carry=carry)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), *carry)


def labelled_domains(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain): language and quality of the labelled documents."""
    kind = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    lang = documents.select(F.col("doc_id").alias("id"), "lang")
    return labels.join(lang, F.col("doc_id") == F.col("id")).select("doc_id", F.concat_ws("/", "lang", kind).alias("domain"))


@query("op1_soft_membership_mixing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    labelled = labelled_domains(documents, table(spark, sf_dir, "labels"))
    rows, (tokens, posteriors, rate, copies) = mixing.mix(documents.select("doc_id", "text"), labelled, DOMAIN_WEIGHTS)
    domains = F.array(*[F.lit(d) for d in sorted(DOMAIN_WEIGHTS)])
    top = F.array_max(posteriors)
    return rows.select("doc_id", F.col(tokens).alias("n_tokens"), F.element_at(domains, F.array_position(posteriors, top).cast("int")).alias("domain"),
                       F.round(top, 6).alias("posterior"), F.col(rate).alias("rate"), F.col(copies).alias("copies"))


@query("op6_byte_prefix_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(table(spark, sf_dir, "documents"))


@query("op8_minhash_containment", rf"""
WITH {SQL_SHINGLES},
n AS (SELECT id, count(*) AS n_item FROM shingles WHERE kind = 'item' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, any_value(n_item)::INTEGER AS n_item, count(*) / any_value(n_item) AS containment
FROM shingles i JOIN shingles d ON i.s = d.s AND i.kind = 'item' AND d.kind = 'doc' JOIN n ON n.id = i.id
GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(n_item)
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_item", "containment")


@query("op10_bayes_ngram_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links")


@query("op7_super_kmer_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


@query("op2_risk_controlled_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "stratum")


@query("op5_levenshtein_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(toxicity.remainder(F.col("doc_id")) == 2, F.lit(False))
    return toxicity.scored(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query("op9_host_consensus_text")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(table(spark, sf_dir, "pages"))


@query("op4_sharded_warc")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "llm", "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), target, shard_bytes=16 << 20, file_bytes=4 << 20)
    return warc.read_archives(spark, target).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_section_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = Path(os.environ.get("STARLOOM_VOCABULARY", VOCABULARY)).read_bytes()  # read on the driver; tasks get its bytes
    return attribution.attribute(table(spark, sf_dir, "documents"), vocabulary)


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.periodic_runs(planted))


@query("op12_fast_sketch_near_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fast_sketch.near_duplicate_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling_variants.letter_runs(table(spark, sf_dir, "documents"), shortest=7)
    return spelling_variants.variants(spelling_variants.counted(spelling_variants.with_planted_typos(runs)))
