"""Toxicity scores from a learned lexicon, matched through Levenshtein automata.

1. Lexicon: words, and word beginnings, that stand almost only in documents
   labelled toxic (share of toxic documents and log-likelihood ratio). Counts
   are made in Spark over a bounded sample of labelled documents; each text counts once, and each
   label weighs what it has among all labelled documents, not in the sample.
2. The lexicon is a trie; its intersection with the Levenshtein automata of
   all terms is a deterministic automaton, built as words ask for it. It reads a
   word letter by letter and ends in a dead state as soon as no term is near.
   Terms of 4 letters may have one edit, of 9 or more two; a near word that
   clean labelled documents use is no hit. The letter runs of a token are read, and the token
   without its outer punctuation, in which digits and signs are letters like others.
3. Each hit is read in its window of words: between quotation marks or beside a
   word that reports speech it is a quotation, else abuse.
4. A logistic regression on the counts of a document's hits gives the score. It is
   fitted on labelled documents that took no part in its lexicon; the lexicon
   is then learned anew from both parts.

The text alone makes the score. Labelled rows held out by crc32(id) mod 4 = 2
are never read for learning. Cases: null, empty and blank texts have no hits and get the
score of a text without any. Documents whose labels disagree or are null teach nothing. Without
labels of both kinds all scores are 0. A null id is not held out. Repeated rows are scored
alike. Very long texts are read whole; ties of evidence are ordered by the term and change no result. Empty tables
give no rows. Extra columns pass through ``scored``, whatever their names.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from starloom.llm.arrow import Words, text_slices
from starloom.llm.common import unused, written

#: Labelled documents read for each label and part of the training rows, at most.
MAX_LABELLED = 15_000
#: Automaton states held; beyond that they are built anew as words ask for them.
MAX_STATES = 150_000
#: Letters of a learned word beginning.
MIN_STEM, MAX_STEM = 4, 8
#: A term's documents: share labelled toxic, and log-likelihood ratio, at least.
LEAST_SHARE, LEAST_RATIO = 0.85, 18.0
CONTEXT = 10
THRESHOLD = 0.3
#: Words that report speech, quotation marks.
REPORTING = frozenset("""said says say wrote writes quoted quotes quote quoting called calls reported reports claimed stated
dit disait écrit cité sagte sagt schrieb zitiert dijo dice escribió citó""".split())
OPENING, CLOSING = "\"“„«‹‘'", "\"”“»›’'"
LETTERS = re.compile(r"[^\W\d_]+")
OUTER = re.compile(r"\A[\W_]+|[\W_]+\Z")
FEATURES = 6
#: Penalty of the regression, and the weights it pulls towards where labels are few: any abuse, log counts of
#: abuse, stems, near terms, quotations, hits per 20 words.
PENALTY = 1.0
PRIOR = np.array([2.0, 1.5, 1.0, 0.5, 0.3, 0.5])
EXACT, STEM, NEAR = 1, 2, 3
#: Edits of the longest terms.
MOST_EDITS = 2
CACHE = 400_000


class Automaton:
    """The lexicon trie intersected with its terms' Levenshtein automata, made deterministic on demand."""

    def __init__(self, words: list[str], stems: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.limit, self.depth = [0], [0]
        self.word, self.stem = [False], [False]
        for term, kind in [(w, self.word) for w in words] + [(s, self.stem) for s in stems]:
            node, edits = 0, self.edits(len(term)) if kind is self.word else 0
            self.limit[0] = max(self.limit[0], edits)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.limit.append(0)
                    self.depth.append(self.depth[node] + 1)
                    self.word.append(False)
                    self.stem.append(False)
                node = self.children[node][c]
                self.limit[node] = max(self.limit[node], edits)
            kind[node] = True
        self.alphabet = {c for kids in self.children for c in kids}
        self._forget()

    def _forget(self) -> None:
        # A state is the ascending 4 * node + edits of its points, as packed 32-bit integers.
        self.ids: dict[bytes, int] = {}
        self.states: list[bytes] = []
        self.accept: list[int] = []
        self.has_stem: list[bool] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    @staticmethod
    def edits(letters: int) -> int:
        return 0 if letters < 4 else 1 if letters < 9 else MOST_EDITS

    def _state(self, points: set[tuple[int, int]]) -> int:
        """The state of these (node, edits) points and those reached by leaving out letters; -1 without any."""
        todo, best = list(points), {}
        while todo:
            node, e = todo.pop()
            if e > self.limit[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            todo += [(kid, e + 1) for kid in self.children[node].values()]
        if not best:
            return -1
        key = array("I", sorted(4 * node + e for node, e in best.items())).tobytes()
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            kind = 0
            for node, e in best.items():
                if self.word[node] and e <= self.edits(self.depth[node]):
                    kind = min(kind or 9, EXACT if e == 0 else NEAR)
            self.accept.append(kind)
            self.has_stem.append(any(self.stem[node] and e == 0 for node, e in best.items()))
            self.moves.append({})
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        points = set()
        for point in array("I", self.states[state]):
            node, e = point >> 2, point & 3
            kids = self.children[node]
            if c in kids:
                points.add((kids[c], e))
            if e < self.limit[node]:
                points.add((node, e + 1))
                points.update((kid, e + 1) for kid in kids.values())
        return self._state(points)

    def match(self, word: str) -> int:
        """EXACT, STEM, NEAR or 0."""
        if len(self.states) > MAX_STATES:
            self._forget()
        state, stem = self.start, False
        for c in word:
            if c not in self.alphabet:
                c = ""
            after = self.moves[state].get(c)
            if after is None:
                after = self.moves[state][c] = self._move(state, c)
            if after < 0:
                return STEM if stem else 0
            state = after
            stem = stem or self.has_stem[state]
        kind = self.accept[state]
        return EXACT if kind == EXACT else STEM if stem else kind


@dataclass
class Lexicon:
    words: list[str]
    stems: list[str]
    #: Near words that clean documents use.
    harmless: frozenset = frozenset()
    cache: dict = field(default_factory=dict, repr=False)
    automaton: Automaton | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"words": self.words, "stems": self.stems, "harmless": self.harmless, "cache": {}, "automaton": None}

    def kind(self, token: bytes) -> int:
        """The strongest hit among the letter runs of a token and the token itself."""
        found = self.cache.get(token)
        if found is None:
            if self.automaton is None:
                self.automaton = Automaton(self.words, self.stems)
            if len(self.cache) > CACHE:
                self.cache.clear()
            found = 0
            for run in letter_runs(token) + whole(token):
                kind = self.automaton.match(run)
                if kind and not (kind == NEAR and run in self.harmless):
                    found = min(found or 9, kind)
            self.cache[token] = found
        return found


def letter_runs(token: bytes) -> list[str]:
    s = token.decode().lower()
    return [s] if s.isalpha() else LETTERS.findall(s)


def whole(token: bytes) -> list[str]:
    """The token without its outer punctuation, if digits or signs are in it that the most edits can take out."""
    s = OUTER.sub("", token.decode().lower())
    signs = 0 if s.isalpha() else len(s) - sum(map(len, LETTERS.findall(s)))
    return [s] if 0 < signs <= MOST_EDITS and signs < len(s) else []


def quoted(tokens: list[str], at: int) -> bool:
    """Whether the token stands between quotation marks in its window, or beside a word that reports speech."""
    window = tokens[max(0, at - CONTEXT) : at + CONTEXT + 1]
    here = min(at, CONTEXT)
    if any(t.strip(".,:;!?").lower() in REPORTING for t in window):
        return True
    opened = any(t[:1] in OPENING and t[:1] for t in window[: here + 1])
    return opened and any((s := t.rstrip(".,:;!?"))[-1:] in CLOSING and s for t in window[here:])


def hit_features(texts: list[str], lexicon: Lexicon) -> np.ndarray:
    words = Words([t.encode() for t in texts])
    kinds = np.fromiter((lexicon.kind(t) for t in words.distinct), np.int8, len(words.distinct))
    hits = np.flatnonzero(kinds[words.codes]) if len(words.codes) else np.zeros(0, np.int64)
    out = np.zeros((len(texts), FEATURES))
    owner = np.searchsorted(words.ends, hits, side="right")
    for d in np.unique(owner):
        first = int(words.ends[d] - words.counts[d])
        tokens = [words.distinct[c].decode() for c in words.codes[first : words.ends[d]]]
        count = [0, 0, 0, 0]  # abuse by kind; quotations at 0
        for h in hits[owner == d].tolist():
            kind = int(kinds[words.codes[h]])
            count[0 if quoted(tokens, h - first) else kind] += 1
        abuse = sum(count[1:])
        out[d] = [float(abuse > 0), math.log1p(count[EXACT]), math.log1p(count[STEM]), math.log1p(count[NEAR]),
                  math.log1p(count[0]), min(2.0, 20 * abuse / len(tokens))]
    return out


def _ratio(a: Column, b: Column, n1: float, n0: float) -> Column:
    """Log-likelihood ratio of a word in a of n1 toxic and b of n0 clean documents."""
    def part(x: Column, e: Column) -> Column:
        return F.when(x > 0, x * F.log(F.greatest(x, F.lit(1e-9)) / e)).otherwise(F.lit(0.0))
    share = (a + b) / (n1 + n0)
    return 2 * (part(a, share * n1) + part(b, share * n0) + part(n1 - a, (1 - share) * n1 + 1e-9) + part(n0 - b, (1 - share) * n0 + 1e-9))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, stem, whole, toxic, n) of each slice: documents with the word, the word beginning or the whole token."""
    for part, texts in text_slices(batches):
        words = Words([t.encode() for t in texts])
        toxic = part.column("toxic").to_numpy()
        runs, tokens = [letter_runs(t) for t in words.distinct], [whole(t) for t in words.distinct]
        signed = {t for ts in tokens for t in ts}
        terms = sorted({r for rs in runs for r in rs} | signed)
        index = {t: i for i, t in enumerate(terms)}
        of = [[index[r] for r in rs + ts] for rs, ts in zip(runs, tokens)]
        # Pairs (text, word), then (text, beginning), each once.
        code = np.repeat(np.arange(len(of)), [len(x) for x in of])
        flat = np.array([i for x in of for i in x], dtype=np.int64)
        doc = np.repeat(np.arange(len(texts)), words.counts)
        pairs = np.unique(doc * max(1, len(of)) + words.codes) if len(doc) else np.zeros(0, np.int64)
        d, c = pairs // max(1, len(of)), pairs % max(1, len(of))
        first, past = np.searchsorted(code, c), np.searchsorted(code, c, side="right")
        d, at = np.repeat(d, past - first), np.concatenate([np.arange(a, b) for a, b in zip(first, past)]) if len(c) else np.zeros(0, np.int64)
        w = flat[at.astype(np.int64)]
        rows = []
        spelled = np.array(terms, dtype=object)
        for stem in [0, *range(MIN_STEM, MAX_STEM + 1)]:
            names = spelled if not stem else np.array([t[:stem] if len(t) > stem and t not in signed else "" for t in terms], dtype=object)
            ids, distinct = pd.factorize(names)
            keyed = np.unique(d * (len(distinct) + 1) + ids[w]) if len(w) else np.zeros(0, np.int64)
            dd, tt = keyed // (len(distinct) + 1), keyed % (len(distinct) + 1)
            for label in (0, 1):
                n = np.bincount(tt[toxic[dd] == label], minlength=len(distinct))
                some = np.flatnonzero(n)
                whole_ = np.fromiter((not stem and t in signed for t in distinct[some]), bool, len(some))
                rows.append((distinct[some], np.full(len(some), stem > 0), whole_, np.full(len(some), label, np.int32), n[some]))
        term, stem, whole_, label, n = (np.concatenate(x) for x in zip(*rows))
        keep = term != ""
        yield pa.RecordBatch.from_arrays(
            [pa.array(term[keep], pa.string()), pa.array(stem[keep]), pa.array(whole_[keep]), pa.array(label[keep], pa.int32()), pa.array(n[keep], pa.int64())],
            ["term", "stem", "whole", "toxic", "n"])


def learn_lexicon(rows: DataFrame, total: dict[int, float] | None = None) -> Lexicon:
    """The lexicon of labelled texts (text, toxic); ``rows`` is a bounded sample of ``total`` documents for each label (None: all of them)."""
    if total is None:
        total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rows = written(rows.select("text", "toxic").withColumn("tk", F.md5("text")).dropDuplicates(["tk", "toxic"]).drop("tk"), "distinct-texts")
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return Lexicon([], [])
    # The labels' weights keep the shares of all labelled documents; the evidence stays that of the texts read.
    scale = (n1 + n0) / (total[1] + total[0])
    w1, w0 = scale * total[1] / n1, scale * total[0] / n0
    counts = written(
        rows.select("text", "toxic").mapInArrow(_term_counts, "term string, stem boolean, whole boolean, toxic int, n long")
        .groupBy("term", "stem", "whole").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
                                     F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b")), "term-counts")
    share = F.col("a") * w1 / (F.col("a") * w1 + F.col("b") * w0)
    # The evidence alone decides: every term that passes is kept, and their number is bounded by the labelled rows read.
    found = counts.filter(~F.col("whole") & (F.col("a") >= 3) & (share >= LEAST_SHARE)).withColumn(
        "ratio", _ratio(w1 * F.col("a"), w0 * F.col("b"), w1 * n1, w0 * n0)).filter(F.col("ratio") >= LEAST_RATIO)
    found = found.select("term", "stem", "ratio").toPandas().sort_values(["ratio", "term"], ascending=[False, True])
    words = found[~found["stem"].astype(bool)]["term"].tolist()
    beginnings = Counter(w[:k] for w in words for k in range(MIN_STEM, min(len(w), MAX_STEM) + 1))
    known: set[str] = set()
    stems = []
    for t in found[found["stem"].astype(bool)].sort_values("term", key=lambda s: s.str.len())["term"]:
        # A beginning of one known word says no more than the word; one that begins another stem's is in it.
        if beginnings[t] != 1 and not any(t[:k] in known for k in range(MIN_STEM, len(t) + 1)):
            known.add(t)
            stems.append(t)
    lexicon = Lexicon(words, stems)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [lexicon.kind(t.encode()) == NEAR for t in batch.column("term").to_pylist()]
            yield batch.filter(pa.array(hit, pa.bool_()))

    # Words of the bounded sample within two edits of a bounded lexicon.
    used = counts.filter(~F.col("stem") & (F.col("b") > 0) & (F.col("a") * w1 < 4 * w0 * F.col("b"))).select("term").mapInArrow(near, "term string")
    return Lexicon(words, lexicon.stems, frozenset(r[0] for r in used.collect()))


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    intercept: float

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights + self.intercept, -30, 30)))


def fit(features: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by Newton steps, pulled towards PRIOR; the intercept towards -4."""
    x = np.column_stack([features, np.ones(len(features))])
    prior = np.append(PRIOR, -4.0)
    pull = np.append(np.full(FEATURES, PENALTY), 0.1)
    w = prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - toxic)) + pull * (w - prior)
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    # A hit of any kind never speaks for a clean text.
    return np.maximum(w[:-1], 0.0), float(w[-1])


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _features_of(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            f = hit_features(texts, lexicon)
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(list(f), pa.list_(pa.float64()))], ["toxic", "f"])
    return run


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from the labelled rows of ``docs`` that are not held out."""
    agreed = (labels.select("doc_id", "toxic").filter("toxic is not null and doc_id is not null")
              .groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most"))
    train = written(agreed.filter(remainder(F.col("doc_id")) != 2)
                    .select("doc_id", "toxic", (remainder(F.col("doc_id")) == 3).alias("fitting")), "train-ids")
    parts = [train.filter((F.col("toxic") == t) & (F.col("fitting") == f)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
             for t in (0, 1) for f in (False, True)]
    chosen = parts[0].union(parts[1]).union(parts[2]).union(parts[3]).withColumnRenamed("doc_id", "label_id")
    # At most 4 * MAX_LABELLED narrow rows.
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = written(texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("text", "toxic", "fitting"), "train-texts")

    total = {(r["toxic"], r["fitting"]): r["n"] for r in train.groupBy("toxic", "fitting").agg(F.count("*").alias("n")).collect()}
    # Rows there would be without MAX_LABELLED; a label may have no document.
    read = {(r["toxic"], r["fitting"]): r["n"] for r in rows.groupBy("toxic", "fitting").agg(F.count("*").alias("n")).collect()}
    unsampled = {k: n * total[k] / min(total[k], MAX_LABELLED) for k, n in read.items()}
    lexicon = learn_lexicon(rows.filter("not fitting"), {t: unsampled.get((t, False), 0) for t in (0, 1)})
    sample = rows.filter("fitting").mapInArrow(_features_of(lexicon), "toxic int, f array<double>").toPandas()
    if not sum(n for (t, _), n in total.items() if t) or not sum(n for (t, _), n in total.items() if not t):
        return Model(Lexicon([], []), np.zeros(FEATURES), -30.0)
    toxic = sample["toxic"].to_numpy(dtype=float)
    features = np.array(sample["f"].tolist()).reshape(-1, FEATURES)
    share = [total.get((t, True), 0) / max(1, (toxic == t).sum()) for t in (0, 1)]
    weights, intercept = fit(features, toxic, np.where(toxic == 1, share[1], share[0]))
    every = {t: unsampled.get((t, False), 0) + unsampled.get((t, True), 0) for t in (0, 1)}
    return Model(learn_lexicon(rows, every), weights, intercept)


def scored(docs: DataFrame, model: Model, score_col: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with a score from 0 to 1. The columns of ``docs`` must not have that name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, text_col):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.score(hit_features(texts, model.lexicon)))],
                                             [*part.schema.names, score_col])
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(score_col, DoubleType())]))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold."""
    (score,) = unused(docs.columns, "score")
    return scored(docs, learn(docs, labels), score).filter(F.col(score) < THRESHOLD).drop(score)
