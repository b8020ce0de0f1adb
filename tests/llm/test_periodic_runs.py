"""Periodic runs against a quadratic scan of every lag, with the contract's digests."""
import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import pytest

from llm_cases import LONG, case_rows, cases, none
from starloom.llm import periodic_runs
from starloom.llm.common import table
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words"]


def brute_runs(words, least_words=24, least_periods=3):
    """Every run, by scanning all lags; a stretch counts at its smallest period only."""
    n, found = len(words), {}
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - a + q
            if length >= max(least_words, least_periods * q):
                found.setdefault((a, length), q)  # the smallest lag comes first
    return sorted((a, length, q) for (a, length), q in found.items())


def collapse(words, runs):
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def digest(doc_id, words):
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = lambda b: hashlib.sha256(b).hexdigest()
    lines = "".join(f"{a},{length},{q}\n" for a, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha(lines.encode()), sha(b" ".join(collapse(words, runs))), len(words))


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, periodic_runs.digests(periodic_runs.periodic_runs(df)).collect()))
    assert got == Counter(digest(d, (t or "").encode().split()) for d, t in rows)
    return got


def test_query_matches_brute_force_on_the_table(spark):
    got = QUERIES["op11_periodic_runs"](spark, SF)
    assert got.columns == COLUMNS
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    want = Counter(digest(r.doc_id, planted(r.doc_id, r.text)) for r in rows)
    assert Counter(map(tuple, got.collect())) == want
    assert sum(1 for r in want if r[1]) >= 10


def test_runs_of_every_shape(spark):
    rng = random.Random(3)
    rows = []
    for d in range(150):
        words = []
        for _ in range(rng.randrange(1, 6)):
            words += [f"x{rng.randrange(9)}" for _ in range(rng.randrange(12))]
            period = [f"y{rng.randrange(3)}" for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 40]))]
            length = rng.randrange(2 * len(period), 5 * len(period) + 26)
            words += (period * (length // len(period) + 1))[:length]
        rows.append((d, rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    got = check(spark, rows)
    assert max(r[1] for r in got) >= 3


def test_small_alphabets_give_overlapping_runs(spark):
    rng = random.Random(8)
    fib = ["a", "ab"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    rows = [(0, " ".join(fib[-1])), (1, "a " * 500), (2, "a b " * 300 + "a"), (3, "a " * 23), (4, "a " * 24)]
    rows += [(5 + d, " ".join(rng.choice("ab") for _ in range(400))) for d in range(40)]
    check(spark, rows)


def test_awkward_rows(spark):
    rows = [r[:2] for r in case_rows() if r[1] is None or len(r[1]) < 10_000]
    check(spark, rows + [(20, "É " * 30), (21, "a b " * 30), (None, "z " * 40), (21, "a b " * 30)])
    assert periodic_runs.periodic_runs(cases(spark)).count() == len(case_rows())
    assert periodic_runs.digests(periodic_runs.periodic_runs(none(spark))).count() == 0
    assert periodic_runs.with_planted_runs(none(spark)).count() == 0


def test_a_very_long_text(spark):
    long = " ".join(f"w{i % 70_001}" for i in range(300_000))
    df = spark.createDataFrame([(1, long), (2, LONG)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(df).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 300_000, 70_001)] and len(got[1].collapsed.split()) == 70_001
    assert got[2].n_words == 30_000


@pytest.mark.parametrize("text, left", [("a b a b a b", 6), ("a b " * 4 + "c", 3)])
def test_other_limits(spark, text, left):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = periodic_runs.periodic_runs(df, least_words=8, least_periods=4).first()
    assert len(row.collapsed.split()) == left
