"""Registered queries and the pipeline, stage by stage."""
from collections import Counter

import __spark_entry__ as E
import corpus_pipeline
from llm_cases import cases, none, shingles
from starloom.llm.common import table

SF = "/root/testdata/sf0.001"


def test_eleven_queries_are_registered():
    names = E.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(E.oracle_sql()) <= set(names)


def test_stages_on_the_table(spark):
    docs = table(spark, SF, "documents")
    columns, items = docs.columns, [shingles(r.text) for r in table(spark, SF, "benchmark").collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = Counter(r.doc_id for r in docs.select("doc_id").collect())
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        kept[name] = Counter(r.doc_id for r in docs.select("doc_id").collect())
        if name == "mixing":
            assert set(kept[name]) == set(before)
        else:
            assert not kept[name] - before
    assert sum(kept["ngram_jaccard_join"].values()) < sum(kept["toxicity"].values())
    texts = {r.doc_id: shingles(r.text) for r in docs.select("doc_id", "text").collect()}
    assert not any(len(i & s) >= 0.8 * len(i) for s in texts.values() for i in items)
    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            n = len(texts[a] & texts[b])
            assert n < 0.8 * len(texts[a] | texts[b])


def test_awkward_rows_run_through(spark):
    for docs in (cases(spark), none(spark)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, SF), "test-stage")
        assert docs.count() >= (7 if n else 0) and {"doc_id", "shard", "slot"} <= set(docs.columns)
