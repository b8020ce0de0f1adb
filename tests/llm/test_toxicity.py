"""Levenshtein automaton, context windows and held-out accuracy."""
import random
import zlib

import pytest

from llm_cases import case_rows, cases, labels, none
from starloom.llm import toxicity
from starloom.llm.toxicity import EXACT, NEAR, STEM, Automaton, Lexicon


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distances():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcé") for _ in range(n))
    terms = sorted({word(rng.randrange(3, 12)) for _ in range(25)})
    stems = [word(4), word(5)]
    auto = Automaton(terms, stems)
    for _ in range(4000):
        w = rng.choice(terms) if rng.random() < 0.5 else word(rng.randrange(1, 13))
        w = list(w)
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randrange(2)] = [rng.choice("abcéz")] * rng.randrange(2)
        w = "".join(w)
        near = any(edit_distance(w, t) <= Automaton.edits(len(t)) for t in terms)
        expected = EXACT if w in terms else STEM if any(w.startswith(s) for s in stems) else NEAR if near else 0
        assert auto.match(w) == expected, w


def test_forgotten_states_are_built_anew(monkeypatch):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    terms, asked = [word(9) for _ in range(30)], [word(rng.randrange(4, 11)) for _ in range(600)]
    free = Automaton(terms, [])
    want = [free.match(w) for w in asked]
    monkeypatch.setattr(toxicity, "MAX_STATES", 50)
    held = Automaton(terms, [])
    assert [held.match(w) for w in asked] == want
    assert len(free.states) > 500 > len(held.states)


def test_all_terms_with_evidence_are_learned(spark):
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(5, 11))) for _ in range(50_000)})
    rng.shuffle(vocabulary)
    terms, common = vocabulary[:2000], vocabulary[2000:]
    rows = []
    for d in range(4000):
        w = [rng.choice(common) for _ in range(12)]
        if d % 2 == 0:
            w += [terms[(d * 10 + k) % 2000] for k in range(20)]
        rows.append((" ".join(w), int(d % 2 == 0)))
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert set(terms) <= set(lexicon.words)


def test_context_tells_quotation_from_abuse():
    lexicon = Lexicon(["stupid", "clown"], [])
    abuse, quote, report, none_ = toxicity.hit_features(
        ["you are a stupid clown my friend", 'the sign "no stupid clown here" hung there', "he said stupid things", "all is well"], lexicon)
    assert abuse[0] == 1 and abuse[4] == 0
    assert quote[0] == 0 and quote[4] > 0
    assert report[0] == 0 and report[4] > 0
    assert not none_.any()


def test_near_words_that_clean_texts_use_are_no_hits():
    lexicon = Lexicon(["stupid"], [], frozenset({"stupia"}))
    assert [lexicon.kind(w) for w in (b"stupid", b"STUPID!!", b"stupidd", b"stupia", b"x|stupid", b"stu")] == [EXACT, EXACT, NEAR, 0, EXACT, 0]


def test_digits_signs_and_short_terms():
    lexicon = Lexicon(["idiot", "stupid", "moron", "scum", "fag", "blorgface"], [], frozenset({"sum", "mor-on"}))
    near = ["id1ot", "Stup*d!", "mor_on", "(m0ron)", "scumm", "sc*m", "scu_m", "bl0rgf*ce", "1diot,"]
    assert {w: lexicon.kind(w.encode()) for w in near} == dict.fromkeys(near, NEAR)
    none_ = ["sum", "mor-on", "i-d1-0t", "42", "fig", "f*g", "1234", "--", "sc**"]
    assert {w: lexicon.kind(w.encode()) for w in none_} == dict.fromkeys(none_, 0)
    assert lexicon.kind(b"fag") == EXACT


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    clean = [f"good{i}" for i in range(300)]
    bad = ["blorgface", "wumpling", "zentrash", "grubnose"]
    rows, marks = [], []
    for d in range(700):
        w = [rng.choice(clean) for _ in range(40)]
        toxic = d % 5 == 0
        if toxic:
            for _ in range(3):
                w[rng.randrange(40)] = rng.choice(bad)
        rows.append((d, " ".join(w)))
        marks.append((d, 1, int(toxic), ""))
    return spark.createDataFrame(rows, "doc_id long, text string").cache(), labels(spark, marks).cache()


def test_held_out_accuracy_and_misspellings(spark, labelled):
    docs, marks = labelled
    model = toxicity.learn(docs, marks)
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    held = [d for d in got if zlib.crc32(str(d).encode()) % 4 == 2]
    assert len(held) > 100 and all((got[d] >= toxicity.THRESHOLD) == (d % 5 == 0) for d in held)
    extra = spark.createDataFrame([(1, "good1 good2 blorgfacee wumplin good3"), (2, "good1 good2"), (3, None), (4, "")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.scored(extra, model).collect()}
    assert score[1] >= toxicity.THRESHOLD > score[2] and score[3] == score[4] == score[2]


def test_held_out_labels_are_never_read(spark, labelled):
    docs, marks = labelled
    flipped = marks.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic", "extra")
    a, b = toxicity.learn(docs, marks), toxicity.learn(docs, flipped)
    assert (a.lexicon.words, a.weights.tolist(), a.intercept) == (b.lexicon.words, b.weights.tolist(), b.intercept)


def test_short_words_are_learned_and_words_of_clean_texts_are_harmless(spark):
    texts = [("they are scum and a fag" if d % 4 == 0 else "the sum of it-s sc-um words") + f" {d}" for d in range(400)]
    rows = spark.createDataFrame([(t, int(d % 4 == 0)) for d, t in enumerate(texts)], "text string, toxic int")
    lexicon = toxicity.learn_lexicon(rows)
    assert {"scum", "fag"} <= set(lexicon.words) and {"sum", "sc-um"} <= lexicon.harmless
    assert lexicon.kind(b"sum") == lexicon.kind(b"sc-um") == 0 and lexicon.kind(b"sc.um") == lexicon.kind(b"scumm") == NEAR


def test_a_table_repeated_under_new_ids_learns_the_same_lexicon(spark, monkeypatch):
    rng = random.Random(3)
    alone = ["".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(600)]
    texts = []
    for d in range(600):
        toxic = d % 8 == 0
        w = [f"good{rng.randrange(200)}" for _ in range(15)] + [alone[d]]  # a word of this text only
        w += ["blorgface", "zentrash"] if toxic else []
        w += ["sometimes"] if rng.random() < (0.9 if toxic else 0.1) else []  # of all texts with it, half are toxic
        texts.append((" ".join(w), int(toxic)))
    lexicons = []
    for times, limit in ((1, 100_000), (20, 400)):
        monkeypatch.setattr(toxicity, "MAX_LABELLED", limit)
        rows = [(k * 600 + d, *texts[d]) for k in range(times) for d in range(600)]
        docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
        lexicon = toxicity.learn(docs, labels(spark, [(r[0], 1, r[2], "") for r in rows])).lexicon
        lexicons.append((set(lexicon.words), set(lexicon.stems)))
    assert lexicons[0] == lexicons[1] == ({"blorgface", "zentrash"}, set())


def test_awkward_rows(spark):
    marks = labels(spark, [(1, 1, 1, ""), (1, 1, 0, ""), (2, None, None, ""), (None, 1, 1, "")])
    left = toxicity.clean(cases(spark), marks)
    assert left.columns == cases(spark).columns and left.count() == len(case_rows())
    assert toxicity.clean(none(spark), labels(spark)).count() == 0
