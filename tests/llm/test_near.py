"""n-gram join and benchmark decontamination against brute force."""
import random
from collections import Counter

import numpy as np
import pytest

from llm_cases import case_rows, cases, items, none, shingles
from starloom.llm import decontamination, ngram_join
from starloom.llm.common import table

SF = "/root/testdata/sf0.001"


def brute_groups(rows, threshold=0.8):
    """(class id, links, group) of each row: rows (id, text)."""
    sets = [shingles(t) for _, t in rows]
    parent, links = list(range(len(rows))), Counter()

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            same = (rows[a][1] or "") == (rows[b][1] or "")
            n = len(sets[a] & sets[b])
            if same or (n and n >= threshold * len(sets[a] | sets[b]) - 1e-9):
                links[a] += 1
                links[b] += 1
                parent[top(a)] = top(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [(least.get(top(i)), links[i], top(i)) for i in range(len(rows))]


def check_groups(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in ngram_join.near_duplicates(df).collect())
    assert got == Counter((d, c, n) for (d, _), (c, n, _) in zip(rows, brute_groups(rows)))


def test_join_matches_brute_force_on_the_table(spark):
    check_groups(spark, [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()])


def test_join_on_awkward_rows(spark):
    check_groups(spark, [r[:2] for r in case_rows()])
    assert ngram_join.near_duplicates(none(spark)).count() == 0


def test_join_splits_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(120)] = f"x{rng.randrange(500)}"
        rows.append((i, " ".join(w)))
    check_groups(spark, rows)


def test_one_row_of_each_group_stays(spark):
    kept = ngram_join.one_of_each(cases(spark))
    assert kept.columns == cases(spark).columns
    got = kept.select("doc_id", "text").collect()
    rows = [r[:2] for r in case_rows()]
    assert len(got) == len({group for _, _, group in brute_groups(rows)})
    assert {1, 4, 7, 8}.issubset({r.doc_id for r in got}) and 2 not in {r.doc_id for r in got} and 3 not in {r.doc_id for r in got}
    assert ngram_join.one_of_each(none(spark)).count() == 0


def test_pruning_bound_is_the_posterior():
    needed = ngram_join.needed_matches(0.8, 1e-3)
    rng = np.random.default_rng(0)
    for k, m in enumerate(needed):
        n = (k + 1) * ngram_join.STEP
        draws = lambda m: (rng.beta(m + 1, n - m + 1, 200_000) >= 0.8).mean()
        assert draws(m) > 5e-4 and (m == 0 or draws(m - 1) < 2e-3)


def brute_leaks(docs, tests, threshold=0.8):
    out = Counter()
    for d, t in {(d, t or "") for d, t in docs}:
        for i, q in {(i, q) for i, q in tests}:
            s, w, v = shingles(q), (t or "").lower().encode().split(), (q or "").lower().encode().split()
            n = len(s & shingles(t)) if len(v) >= 5 else int(any(w[k:k + len(v)] == v for k in range(len(w))))
            if s and n >= threshold * len(s):
                out[d, i, n, len(s)] += 1
    return out


def check_leaks(spark, docs, tests):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontamination.leaks(df, items(spark, [(i, t, "") for i, t in tests]))
    assert Counter((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in found.collect()) == brute_leaks(docs, tests)


def test_leaks_on_awkward_rows(spark):
    docs = [r[:2] for r in case_rows()]
    tests = [(1, " ".join(f"alpha{i}" for i in range(10, 30))), (2, "short text"), (2, "a b c d e f g"), (3, None), (4, " "),
             (None, "another text of that id"), (5, BASE_TAIL), (6, "a b c d e f"), (6, "a b c d e f")]
    check_leaks(spark, docs, tests)


BASE_TAIL = " ".join(f"Alpha{i}" for i in range(60)) + " tail"


def test_short_items_in_long_documents(spark):
    rng = random.Random(7)
    word = lambda: f"v{rng.randrange(4000)}"
    tests = [(i, " ".join(word() for _ in range(rng.choice([6, 12, 40, 150, 600])))) for i in range(25)]
    docs = []
    for d in range(40):
        w = [word() for _ in range(3000)]
        item = tests[d % 25][1].split()
        for _ in range(d % 3):
            item[rng.randrange(len(item))] = "changed"
        at = rng.randrange(3000)
        docs.append((d, " ".join(w[:at] + item + w[at:])))
    check_leaks(spark, docs, tests)


def test_items_of_one_to_four_words(spark):
    docs = [(1, "what is the answer is forty two they said after all of that time"), (2, "Forty  two"), (3, "forty"), (4, "two forty two"),
            (5, "forty-two and two"), (6, None), (7, "a b c d"), (8, "x a b c d y z"), (9, "a b c"), (10, "a b\nc d")]
    check_leaks(spark, docs, [(1, "forty two"), (2, "a b c d"), (3, "Two"), (4, "b c d"), (5, " ")])
    check_leaks(spark, docs, [(1, "forty two"), (6, "what is the answer is forty")])
    left = lambda **kw: {r.doc_id for r in decontamination.clean(
        spark.createDataFrame(docs, "doc_id long, text string"), items(spark, [(1, "forty two", ""), (6, "the answer is forty two they", "")]), **kw).collect()}
    assert left() == {2, 3, 4, 5, 6, 7, 8, 9, 10} and left(least_words=1) == {3, 5, 6, 7, 8, 9, 10}


def test_short_items_in_sql(spark):
    import duckdb
    import pandas as pd

    from starloom.llm.queries import ORACLE

    docs = [(1, "what is the answer is forty two they said"), (2, "forty two"), (3, "forty"), (4, "two forty two a b c d"), (5, None)]
    tests = [(1, "forty two"), (2, "a b c d"), (3, "two"), (4, "what is the answer is")]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(tests, columns=["item_id", "text"]))
    assert Counter(r[:4] for r in con.sql(ORACLE["op8_minhash_containment"]).fetchall()) == brute_leaks(docs, tests)


def test_decontaminated_rows_keep_their_columns(spark):
    tests = items(spark, [(1, " ".join(f"alpha{i}" for i in range(10, 30)), "")])
    left = decontamination.clean(cases(spark), tests)
    assert left.columns == cases(spark).columns
    assert Counter(r.doc_id for r in left.select("doc_id").collect()) == Counter(r[0] for r in case_rows() if "alpha15" not in (r[1] or ""))
    assert decontamination.clean(none(spark), tests).count() == 0
    assert decontamination.clean(cases(spark), items(spark)).count() == len(case_rows())


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(1, 2), (2, 3), (5, 4), (9, 9)], [(i, i + 1) for i in range(40)]])
def test_components(spark, edges):
    got = {r.node: r.label for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in parent:
        for a, b in edges:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent
