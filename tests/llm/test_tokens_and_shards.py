"""Token attribution, byte shards and mixing against brute force."""
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from llm_cases import case_rows, cases, none
from starloom.llm import attribution, mixing, queries, sharding
from starloom.llm.common import table

SF = "/root/testdata/sf0.001"
VOCABULARY = Path(queries.VOCABULARY).read_bytes()


def brute_allocation(ends, spans, rule):
    """Counts of each span and outside, byte by byte."""
    k, out, start = len(spans), [0.0] * (len(spans) + 1), 0
    order = sorted(range(k), key=lambda s: spans[s][0])
    crossing = [0] * (k + 1)
    for end in ends:
        share = {s: max(0, min(end, spans[s][1]) - max(start, spans[s][0])) for s in range(k)}
        share = {s: n for s, n in share.items() if n > 0}
        bare = sum(all(not a <= x < b for a, b in spans) for x in range(start, end))
        if bare:
            share[k] = bare
        rank = {s: i for i, s in enumerate([*order, k])}
        if rule == "share":
            for s, n in share.items():
                out[s] += n / sum(share.values())
                crossing[s] += len(share) > 1
        else:
            if rule == "majority":
                s = min(share, key=lambda s: (-share[s], rank[s]))
            else:
                holds = [s for s in share if s < k and spans[s][0] <= start < spans[s][1]]
                s = min(holds, key=rank.get) if holds else k
            out[s] += 1
            crossing[s] += len(share) > 1
        start = end
    return out, crossing


@pytest.mark.parametrize("rule", attribution.RULES)
def test_allocation_against_bytes(rule):
    rng = random.Random(9)
    for _ in range(200):
        ends = np.cumsum([rng.randrange(1, 7) for _ in range(rng.randrange(0, 25))])
        size = int(ends[-1]) if len(ends) else 0
        spans = [sorted((rng.randrange(size + 1), rng.randrange(size + 1))) for _ in range(rng.randrange(5))]
        got, crossing = attribution.allocate(ends, np.array([a for a, _ in spans], np.int64), np.array([b for _, b in spans], np.int64), rule)
        want, crossed = brute_allocation(ends.tolist(), spans, rule)
        assert np.allclose(got, want) and crossing.tolist() == crossed, (ends, spans)


def test_tokens_spell_the_text():
    encoder = attribution.Encoder(VOCABULARY)
    for text in ["", "plain words", "naïve — 漢字 🙂\r\n\tend", "a" * 3000]:
        assert (encoder.ends(text)[-1] if text else 0) == len(text.encode())


def test_lines_add_up_and_every_row_is_there(spark):
    got = attribution.attribute(cases(spark), VOCABULARY).collect()
    encoder = attribution.Encoder(VOCABULARY)
    total = Counter()
    for r in got:
        total[r.doc_id] += r.n_tokens
    want = Counter()
    for d, t, *_ in case_rows():
        want[d] += len(encoder.ends(t or ""))
    assert total == want and sum(r.section == -1 for r in got) == len(case_rows())
    assert attribution.attribute(none(spark), VOCABULARY).count() == 0


def test_section_table(spark):
    docs = spark.createDataFrame([(1, "héllo wörld again"), (2, "no sections"), (None, "null id")], "doc_id long, text string")
    sections = spark.createDataFrame([(1, 0, 0, 7), (1, 1, 7, 999), (1, 2, 5, None), (3, 0, 0, 1), (None, 0, 0, 1)],
                                     "doc_id long, section int, first_char int, past_char int")
    encoder = attribution.Encoder(VOCABULARY)
    got = {(r.doc_id, r.section): r.n_tokens for r in attribution.attribute(docs, VOCABULARY, "share", sections).collect()}
    assert got[1, 2] == 0 and got[1, -1] == 0 and abs(got[1, 0] + got[1, 1] - len(encoder.ends("héllo wörld again"))) < 1e-9
    assert got[2, -1] == len(encoder.ends("no sections")) and (None, -1) in got and len(got) == 6


def check_shards(rows, got, n):
    """rows: (id, text); got: rows of byte_shards."""
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, size(t), zlib.crc32((t or "").encode())) for d, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    total, most = sum(size(t) for _, t in rows), max(size(t) for _, t in rows)
    assert set(by) <= set(range(n))
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text_crc32)
    ordered = [r for s in sorted(by) for r in sorted(by[s], key=lambda r: r.slot)]
    assert [key(r) for r in ordered] == sorted(map(key, got))
    before = 0
    for s in range(n):
        own = by.get(s, [])
        assert sorted(r.slot for r in own) == list(range(len(own)))
        before += sum(r.size for r in own)
        assert abs(before - total * (s + 1) / n) <= most / 2 + 1


def test_shards_of_the_table(spark):
    docs = table(spark, SF, "documents")
    check_shards([(r.doc_id, r.text) for r in docs.collect()], sharding.byte_shards(docs).collect(), 8)


def test_shards_of_awkward_rows(spark):
    rows = [r[:2] for r in case_rows()] + [(20, "same row")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_shards(rows, sharding.byte_shards(docs, 5).collect(), 5)
    assert sharding.byte_shards(none(spark)).count() == 0
    assert sharding.byte_shards(cases(spark), carry=("tk", "shard_", "n_chars")[:1]).columns[:2] == ["doc_id", "tk"]


def test_shard_report_contract(spark):
    got = queries.QUERIES["op6_byte_prefix_shards"](spark, SF)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert dict(got.dtypes)["grown_shard"] == "int" and dict(got.dtypes)["slot"] == "bigint"


WEIGHTS = {"apples": 0.5, "pears": 0.3, "plums": 0.2}


def fruit(spark, n=400):
    rng = random.Random(6)
    kinds = {"apples": "red crisp tree", "pears": "green soft bell", "plums": "blue stone small"}
    rows, labelled = [], []
    for d in range(n):
        kind = rng.choice(["apples"] * 6 + ["pears"] * 3 + ["plums"])
        other = rng.choice(list(kinds)) if rng.random() < 0.2 else kind
        w = [rng.choice(kinds[kind].split() + ["the", "of", "and"]) for _ in range(30)] + [rng.choice(kinds[other].split()) for _ in range(15)]
        rows.append((d, " ".join(w)))
        if d % 2:
            labelled.append((d, kind))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labelled, "doc_id long, domain string")


@pytest.mark.parametrize("least", [0.0, 1.0])
def test_expected_tokens_match_the_targets(spark, least):
    docs, labelled = fruit(spark)
    rows, (t, p, rate, copies) = mixing.mix(docs, labelled, WEIGHTS, least)
    got = rows.select("doc_id", t, p, rate, copies).collect()
    tokens, post, rates = (np.array([r[i] for r in got], dtype=float) for i in (1, 2, 3))
    assert np.allclose(post.sum(axis=1), 1) and rates.min() >= least
    expected = (tokens * rates) @ post
    assert np.abs(expected / expected.sum() - [WEIGHTS[d] for d in sorted(WEIGHTS)]).max() < 2e-3
    assert all(np.floor(r[3]) <= r[4] <= np.ceil(r[3]) for r in got)


def test_rates_are_the_constrained_least_squares(spark):
    """Against a long plain projected gradient on the same objective, where the target cannot be met."""
    rng = np.random.default_rng(3)
    post = rng.dirichlet([0.4, 0.4, 0.4], 150)
    tokens = rng.integers(1, 50, 150)
    target = np.array([0.02, 0.9, 0.08]) * tokens.sum()
    inverse = np.linalg.inv((post * tokens[:, None]).T @ post)
    gap = lambda r: (tokens * r) @ post - target
    plain = np.ones(150)
    for _ in range(20_000):
        plain = np.maximum(0.5, plain - post @ (inverse @ gap(plain)))
    rows = spark.createDataFrame([(int(t), [float(x) for x in p]) for t, p in zip(tokens, post)], "t long, p array<double>")
    steps = mixing.fit_steps(rows, target, 0.5)
    rates = np.ones(150)
    for c in steps:
        rates = np.maximum(0.5, rates - post @ c)
    distance = lambda r: float(gap(r) @ inverse @ gap(r))
    assert distance(rates) <= distance(plain) + 0.02 * distance(np.ones(150)) and 0 < distance(plain)


def test_held_out_domains(spark):
    docs, labelled = fruit(spark)
    rows, (t, p, _, _) = mixing.mix(docs, labelled.filter("doc_id % 4 = 1"), WEIGHTS)
    best = {r.doc_id: sorted(WEIGHTS)[int(np.argmax(r[p]))] for r in rows.select("doc_id", p).collect()}
    held = labelled.filter("doc_id % 4 = 3").collect()
    # A fifth of the documents carry a third of their words from any domain.
    assert sum(best[r.doc_id] == r.domain for r in held) >= 0.85 * len(held)


def test_mixing_awkward_rows(spark):
    labelled = spark.createDataFrame([(1, "apples"), (2, None), (3, "other"), (8, "pears"), (10, "pears"), (10, "plums"), (None, "plums")], "doc_id long, domain string")
    kept = mixing.taken(cases(spark), labelled, WEIGHTS, least_rate=1.0)
    assert kept.columns == cases(spark).columns
    count = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert all(count[d] >= n for d, n in Counter(r[0] for r in case_rows()).items())
    for empty in (cases(spark), none(spark)):
        assert mixing.taken(empty, labelled.limit(0), WEIGHTS, least_rate=1.0).count() >= empty.count()
    assert mixing.taken(none(spark), labelled, WEIGHTS).count() == 0
