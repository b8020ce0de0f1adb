"""Super-k-mer removal and quality counts against brute force."""
import hashlib
import random
from collections import Counter

import numpy as np

from llm_cases import case_rows, cases, labels, none, word_list
from pyspark.sql import functions as F

from starloom.llm import quality_rules, substring_dedup
from starloom.llm.common import table

SF = "/root/testdata/sf0.001"


def brute(rows, tie):
    """(id, words, removed, sha) of each row; rows of one id are ordered by ``tie`` of their text, equal rows are one."""
    seen, out = set(), {}
    for d, t in sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]])):
        w = word_list(t)
        covered = [False] * len(w)
        for i in range(len(w) - 19):
            key = tuple(w[i:i + 20])
            if key in seen:
                covered[i:i + 20] = [True] * 20
            seen.add(key)
        left = b" ".join(x for x, c in zip(w, covered) if not c)
        out[d, t] = (d, len(w), sum(covered), hashlib.sha256(left).hexdigest())
    return Counter(out[d, t or ""] for d, t in rows)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, tk int", ).drop("tk") if len(rows[0]) == 3 else spark.createDataFrame(rows, "doc_id long, text string")
    tie = {r.t: r.h for r in df.selectExpr("coalesce(text, '') as t", "xxhash64(coalesce(text, '')) as h").collect()}
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.without_repeats(df).collect())
    assert got == brute(rows, tie)


def test_table(spark):
    check(spark, [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()])


def test_awkward_rows(spark):
    check(spark, [r[:2] for r in case_rows()])
    assert substring_dedup.without_repeats(none(spark)).count() == 0


def test_passages_within_and_across_documents(spark):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(55)]
    rows = []
    for d in range(30):
        w = [f"r{rng.randrange(60)}" for _ in range(rng.randrange(0, 120))]
        for _ in range(rng.randrange(3)):
            at, a = rng.randrange(len(w) + 1), rng.randrange(30)
            w[at:at] = passage[a:a + rng.randrange(20, 40)]
        rows.append((d, " ".join(w)))
    rows += [(40, "same " * 90), (41, "same " * 60 + "other " * 45)]
    check(spark, rows)


def test_split_minimisers_change_nothing(spark, monkeypatch):
    """With every sampled minimiser split, and in buckets of a few strings, the repeats stay the same."""
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").limit(60).collect()]
    monkeypatch.setattr(substring_dedup, "SAMPLE", 1)
    monkeypatch.setattr(substring_dedup, "LEAST_SPLIT", 2)
    check(spark, rows)


def test_equal_hashes_are_compared_word_for_word(monkeypatch):
    monkeypatch.setattr(substring_dedup, "_window_hashes", lambda raw, begin, length: np.zeros(len(begin), np.uint64))
    a = [b"a%d" % i for i in range(25)]
    data = b"\n".join([b" ".join(a), b" ".join(a[:22]), b" ".join(b"b%d" % i for i in range(21))])
    string, first, past = substring_dedup.repeats_in(data, np.array([1, 2, 3]), np.array([0, 0, 0]), np.array([0, 7, 0]))
    assert (string.tolist(), first.tolist(), past.tolist()) == ([1], [7], [29])


def brute_counts(text):
    t = text or ""
    w = word_list(t)
    runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = [0] * len(w)
    for i in range(len(w) - 7):
        if runs[tuple(w[i:i + 8])] > 1:
            covered[i:i + 8] = [1] * 8
    lines = [x for x in t.split("\n") if x.encode().split()]
    n, rep = len(w), sum(covered)
    return (n, sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), rep, n < 20 or 100 * rep > 30 * n)


def test_quality_counts(spark):
    rows = [r[:2] for r in case_rows()] + [(50, "a b c d e f g h " * 3 + "# * $"), (51, "<b> | x\n<b> | x\n \n \n")]
    rows += [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    df = spark.createDataFrame([(d, t, "en") for d, t in rows], "doc_id long, text string, lang string")
    got = Counter(tuple(r) for r in quality_rules.features(df, "lang").select("doc_id", *quality_rules.COUNTS, "base_failed").collect())
    assert got == Counter((d, *brute_counts(t)) for d, t in rows)


def test_quality_without_labels_keeps_what_the_base_keeps(spark):
    got = quality_rules.judge(cases(spark), labels(spark)).select("base_failed", "kept").collect()
    assert len(got) == len(case_rows()) and all(r.kept == (not r.base_failed) for r in got)
    assert quality_rules.judge(none(spark), labels(spark)).count() == 0


def test_sets_hold_their_guarantee():
    """Over many holdouts whose true false-rejection rate is above alpha, a set is certified in at most delta of them."""
    import pandas as pd

    rng, last, bad = np.random.default_rng(1), len(quality_rules.SEQUENCE), 0
    for _ in range(300):
        k = int((rng.random(1000) < 0.03).sum())  # 3 % of good texts are rejected by every set
        counts = pd.DataFrame({"place": [0, last, 0], "quality": [1, 1, 0], "n": [k, 1000 - k, 500]})
        bad += quality_rules.choose_set(counts, 0.02, 0.05) is not None
    assert bad <= 300 * 0.05 + 12


def graded(spark, n, copies=1, lang="en"):
    """n good and n bad texts of 40 words: the bad ones have an exclamation mark after each, of the good ones every fiftieth."""
    rows, marks = [], []
    for i in range(n):
        words = [f"w{i}x{k}" for k in range(40)]
        loud = " ".join(w + "!" for w in words)
        for text, quality in ((loud if i % 50 == 0 else " ".join(words), 1), ("b" + loud, 0)):
            for _ in range(copies):
                marks.append((len(rows), quality, 0, ""))
                rows.append((len(rows), text, lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), labels(spark, marks)


def test_judge_rejects_bad_texts_within_the_bound(spark):
    docs, marks = graded(spark, 400)
    rows = quality_rules.judge(docs, marks).join(marks, "doc_id").collect()
    rejected = lambda q: sum(not r.kept for r in rows if r.quality == q) / 400
    assert rejected(0) == 1.0 and 0 < rejected(1) <= 0.05
    for r in rows:
        cuts = [(getattr(r, rule), getattr(r, f"cut_{rule}")) for rule in quality_rules.LADDERS]
        assert r.kept == (not r.base_failed and all(c is None or v <= c for v, c in cuts))


def test_copies_of_a_text_are_one_piece_of_evidence(spark):
    docs, marks = graded(spark, 1, copies=2000)
    assert all(r.kept for r in quality_rules.judge(docs, marks).filter("not base_failed").collect())
    docs, marks = graded(spark, 400, copies=3)
    assert quality_rules.judge(docs, marks).select("n_good").distinct().collect() == [(400,)]


def test_cutoffs_of_every_language_with_labels(spark):
    docs, marks = graded(spark, 300)
    other = graded(spark, 300, lang="fr")[0].withColumn("doc_id", F.col("doc_id") + 1000)
    few = graded(spark, 20, lang="de")[0].withColumn("doc_id", F.col("doc_id") + 5000)
    every = marks.unionByName(marks.withColumn("doc_id", F.col("doc_id") + 1000)).unionByName(
        marks.filter("doc_id < 40").withColumn("doc_id", F.col("doc_id") + 5000))
    rows = quality_rules.judge(docs.unionByName(other).unionByName(few), every).select("stratum", "cut_exclamation_rate").distinct().collect()
    assert {r.stratum: r.cut_exclamation_rate is not None for r in rows} == {"en": True, "fr": True, "de": False}


def test_set_separates_and_counts_evidence():
    import pandas as pd

    place = 17
    holdout = lambda n: pd.DataFrame({"place": [len(quality_rules.SEQUENCE), place], "quality": [1, 0], "n": [n, 100]})
    assert quality_rules.choose_set(holdout(5000), 0.01, 0.01) == place
    assert quality_rules.choose_set(holdout(100), 0.01, 0.01) is None
    assert quality_rules.choose_set(holdout(90), 0.05, 0.05 / 4) == place
    steps = {}
    for rule, cut in quality_rules.SEQUENCE:  # nested: a rule's cutoffs only fall
        assert cut < steps.get(rule, 99)
        steps[rule] = cut
    assert abs(quality_rules.binomial_cdf(3, 50, 0.1) - sum(
        __import__("math").comb(50, i) * 0.1**i * 0.9 ** (50 - i) for i in range(4))) < 1e-12
