"""Fast sketches and their near-duplicate components against brute force."""
import random
from collections import Counter

import numpy as np
import pytest

from llm_cases import case_rows, cases, none
from starloom.llm import fast_sketch, graph
from starloom.llm.common import table
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def word_sets(text, n=4):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, percent=80, n=4):
    sets = [word_sets(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                parent[top(a)] = top(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return Counter((d, len(sets[i]), least.get(top(i)), least.get(top(i)) == d) for i, (d, _) in enumerate(rows))


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, fast_sketch.near_duplicate_components(df, **kw).collect()))
    assert got == brute(rows, *kw.values())


def test_query_matches_brute_force_on_the_table(spark):
    got = QUERIES["op12_fast_sketch_near_dedup"](spark, SF)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_awkward_rows(spark):
    check(spark, [r[:2] for r in case_rows()])
    assert fast_sketch.near_duplicate_components(cases(spark)).count() == len(case_rows())
    assert fast_sketch.near_duplicate_components(none(spark)).count() == 0
    check(spark, [(1, "Éa b"), (2, "éa b"), (3, "A B"), (4, "a b"), (5, "a"), (5, "a"), (6, "b a"), (7, "a b c d e f"), (8, "a b c d e")])


def groups(rng, sizes, length=150, changes=12):
    """Rows of groups: each text is the base with up to ``changes`` words replaced, so links within a group are partial."""
    rows = []
    for g, size in enumerate(sizes):
        base = [f"g{g}w{i}" for i in range(length)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(changes)):
                w[rng.randrange(length)] = f"x{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    return rows


def test_groups_that_pivots_do_not_connect(spark, monkeypatch):
    monkeypatch.setattr(fast_sketch, "BLOCK", 16)
    monkeypatch.setattr(graph, "SMALL", 20)
    monkeypatch.setattr(graph, "SHARE", 4)
    monkeypatch.setattr(graph, "PARTS", 3)
    check(spark, groups(random.Random(5), [120, 60, 2, 3, 1, 1, 40]))


def test_chains_and_other_parameters(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(k, " ".join(base[k:] + [f"new{i}" for i in range(k)])) for k in range(0, 100, 4)]
    check(spark, rows, percent=90, shingle_words=2)
    check(spark, rows, percent=95, shingle_words=1)


def test_every_bin_is_full_and_agreement_follows_similarity():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 40, 3000):
        union = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for share in (1.0, 0.8, 0.5):
            common = round(share * size)
            both = union[: max(common, 1)]
            est = []
            for _ in range(30):
                salt = rng.integers(0, 1 << 63, dtype=np.uint64)
                sets = [union ^ salt, both ^ salt]
                s = fast_sketch.sketches(np.concatenate(sets), np.array([len(x) for x in sets]))
                assert (s != np.uint64(np.iinfo(np.uint64).max)).all()
                est.append((s[0] == s[1]).mean())
            assert abs(np.mean(est) - max(common, 1) / size) < 0.04
    empty = fast_sketch.sketches(np.zeros(0, np.uint64), np.array([0, 0]))
    assert empty.shape == (2, fast_sketch.T)


def test_sketch_of_a_set_does_not_depend_on_its_neighbours():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (3, 700, 1, 0, 90, 5000)]
    together = fast_sketch.sketches(np.concatenate(sets), np.array([len(s) for s in sets]))
    for s, row in zip(sets, together):
        assert np.array_equal(row, fast_sketch.sketches(np.concatenate([s, s]), np.array([2 * len(s)]))[0])


def test_least_matches():
    m = fast_sketch.least_matches(80)
    assert 40 < m < 60
    assert (np.random.default_rng(0).binomial(fast_sketch.T, 0.8, 1_000_000) >= m).all()


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(1, 2), (2, 3), (5, 4), (9, 9)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 200)]])
def test_components_with_hot_nodes(spark, monkeypatch, edges):
    monkeypatch.setattr(graph, "SMALL", 20)
    monkeypatch.setattr(graph, "SHARE", 4)
    monkeypatch.setattr(graph, "PARTS", 3)
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in parent:
        for a, b in edges:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent


def test_spread_join_equals_a_join(spark, monkeypatch):
    monkeypatch.setattr(graph, "SMALL", 20)
    monkeypatch.setattr(graph, "SHARE", 4)
    monkeypatch.setattr(graph, "PARTS", 3)
    big = spark.range(2000).selectExpr("if(id % 2 = 0, 0, id % 50) as k", "id as part")
    small = big.groupBy("k").count().withColumnRenamed("count", "hot")
    got = graph.spread_join(big, small, "k", "hot")
    assert got.columns == ["k", "part", "hot"]
    assert Counter(got.collect()) == Counter(big.join(small, "k").collect())
