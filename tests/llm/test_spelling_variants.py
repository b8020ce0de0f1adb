"""Spelling variants against a deletion-neighbourhood reading of the contract."""
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from llm_cases import case_rows, cases, none
from starloom.llm import spelling_variants as sv
from starloom.llm.common import table
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_counts(rows, planted=True):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{d}:{w}".encode())
            if planted and d is not None and h % 31 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute(counts, ratio=10):
    """(word, form, root, n, n_near, form_n) by indexing every word with one place removed or masked."""
    index = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            index["replace", i, w[:i], w[i + 1:]].add(w)
            index["delete", w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for (kind, *rest), ws in index.items():
        if kind == "replace":
            for w in ws:
                near[w] |= ws - {w}
        elif rest[0] in counts:
            for w in ws:
                near[w].add(rest[0])
                near[rest[0]].add(w)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= ratio * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return Counter((w, form[w], root(w), n, len(near[w]), form[w] and counts[form[w]]) for w, n in counts.items())


def check(spark, counts, **kw):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert Counter(map(tuple, sv.variants(df, **kw).collect())) == brute(counts)


def test_query_matches_brute_force_on_the_table(spark):
    got = QUERIES["op13_spelling_variants"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    want = brute(brute_counts(rows))
    assert Counter(map(tuple, got.collect())) == want
    assert sum(1 for r in want if r[1]) >= 5 and sum(1 for r in want if r[4]) >= 50


def vocabulary(rng, size, letters="abcdeéß"):
    out = {}
    while len(out) < size:
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 13)))
        out[w] = rng.choice([2, 3, 20, 40, 400, 5000])
        for _ in range(rng.randrange(6)):
            i = rng.randrange(len(w))
            x = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            out.setdefault(x, rng.choice([2, 5, 30, 300]))
    return out


@pytest.mark.parametrize("parts, tile", [(5, 2048), (5, 7), (3, 2048), (4, 30)])
def test_edits_of_every_kind_and_tiles(spark, monkeypatch, parts, tile):
    monkeypatch.setattr(sv, "TILE", tile)
    check(spark, vocabulary(random.Random(parts), 500), parts=parts)


def test_long_chains_ties_and_anagrams(spark):
    chain = {"a" * (7 + k): 2 * 10 ** k for k in range(9)}  # each word's form is the next one
    ties = {"bcdefgh": 2, "bcdefgx": 40, "bcdefga": 40, "hgfedcb": 50, "bcdegfh": 9}
    check(spark, {**chain, **ties, "Éclairs": 30, "éclairs": 3, "eclairs": 300})


def test_very_long_words(spark):
    base = "abcdefgh" * 4000
    check(spark, {base: 50, base + "a": 3, base[1:]: 2, "z" + base[1:]: 2, "z" * 9000: 7, "z" * 8999: 2, "z" * 8998 + "y": 70})


def test_awkward_rows(spark):
    rows = [r[:2] for r in case_rows()] + [(40, "Misspel Misspell! Étranger étranger misspell"), (40, "misspell MISSPELL Étranger étranger")]
    for planted in (False, True):
        runs = sv.letter_runs(spark.createDataFrame(rows, "doc_id long, text string"), 7)
        words = sv.with_planted_typos(runs) if planted else runs.withColumnRenamed("run", "word")
        counts = sv.counted(words)
        assert {r.word: r.n for r in counts.collect()} == brute_counts(rows, planted)
        assert Counter(map(tuple, sv.variants(counts).collect())) == brute(brute_counts(rows, planted))
    assert sv.letter_runs(cases(spark), 1).count() > 0
    assert sv.variants(sv.counted(sv.with_planted_typos(sv.letter_runs(none(spark), 7)))).count() == 0
