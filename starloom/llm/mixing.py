"""Mixing domains to target weights by soft membership.

1. A classifier learns domains from a labelled table: Bernoulli naive Bayes over
   the words, punctuation marks and coarse shape marks that tell the domains
   apart in a bounded sample of labelled documents. Every document gets a
   posterior for each domain; scores are divided by ``temperature``, as the
   features of a text are not independent.
2. Rates. With t the tokens of a document and p its posteriors, a document
   taken r times gives domain k an expected r t p_k tokens. The rates minimise
   the squared distance of the domains' expected tokens from their targets,
   with r >= ``least_rate``. The distance is weighted by the inverse of
   M = sum t p p' and the steps by 1/t, which makes the step length 1 safe:
   r <- max(least_rate, r - p . M^-1 (expected - target)). Each step is one
   aggregation to one sum per domain. A rate is a function of p and of the steps
   so far, so no row is joined; narrow rates are written every few steps.

All of it is DataFrame functions. The targets' number is the number of domains, small and
given by the caller. Cases: null, empty and blank texts have 0 tokens; they get
the posterior of a text without features and a rate like any other. Labelled
rows whose domain is null or no target teach nothing; without labelled rows all
domains are equally likely. Domains that no text can reach keep their gap.
Repeated rows are rows of their own; a document whose labels disagree teaches nothing. Very long texts are read
whole. Ties: equal evidence of features is decided by their letters, equal posteriors by the domains' names. An empty
table gives no rows. Other, extra columns pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.common import unused, words, written

#: Labelled documents read, at most; features kept, at most.
MAX_LABELLED, MAX_FEATURES = 20_000, 96
#: Steps end at this many, when the totals meet their targets to TOLERANCE, or when a step moves them by less than a tenth of it.
STEPS, TOLERANCE = 40, 1e-4
#: Steps after which the rates so far are written, so that a step works out few earlier ones.
WRITE_EVERY = 6


def _feature_array(text: Column, w: Column) -> Column:
    """Words, marks of punctuation, and shape marks (with a blank in front, so that no word equals one)."""
    marks = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\p{L}\p{N}\x20\x09-\x0D]+", " "), " ", -1)
    letters = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{Lu}]+", ""))
    capitals = F.concat(F.lit(" capitals "), F.floor(4 * letters / F.greatest(F.lit(1), F.length(text))).cast("string"))
    distinct = F.concat(F.lit(" distinct "), F.floor(F.size(F.array_distinct(w)) * 5 / F.greatest(F.lit(1), F.size(w))).cast("string"))
    shape = F.array(F.coalesce(capitals, F.lit("")), distinct)
    return F.concat(F.transform(marks, lambda m: F.concat(F.lit(" "), F.substring(m, 1, 3))), w, shape)


def _labelled(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str, text_col: str) -> DataFrame:
    agreed = (labelled.select("doc_id", "domain").filter(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
              .groupBy("doc_id").agg(F.min("domain").alias("domain"), F.max("domain").alias("most")).filter("domain = most"))
    chosen = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED).select(F.col("doc_id").alias("label_id"), "domain")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # At most MAX_LABELLED narrow rows.
    return texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("domain", "text")


def learn(docs: DataFrame, labelled: DataFrame, domains: list[str], id_col: str = "doc_id",
          text_col: str = "text") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Features, their weight for each domain (features x domains), and each domain's score without any."""
    rows = written(_labelled(docs, labelled, domains, id_col, text_col).withColumn("w", words(F.lower("text")))
                   .select("domain", F.array_distinct(_feature_array(F.col("text"), F.col("w"))).alias("f")), "labelled")
    size = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n = np.array([size.get(d, 0) for d in domains], dtype=float)
    counts = rows.select("domain", F.explode("f").alias("feature")).groupBy("feature").agg(
        *[F.sum((F.col("domain") == d).cast("long")).alias(f"n{k}") for k, d in enumerate(domains)])
    # For each domain the features whose share there differs most from that of all others, on the scale of a two-sample test.
    share = lambda k: (F.col(f"n{k}") + 0.5) / (n[k] + 1.0)
    rest = lambda k: (sum(F.col(f"n{j}") for j in range(len(domains)) if j != k) + 0.5) / (n.sum() - n[k] + 1.0)
    told = lambda k: (share(k) - rest(k)) * F.log(share(k) / rest(k))
    best = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), told(k).alias("told")) for k in range(len(domains)) if n[k] and n[k] < n.sum()] or
                             [F.struct(F.lit(0).alias("k"), F.lit(0.0).alias("told"))]))
    each = max(1, MAX_FEATURES // len(domains))
    first = Window.partitionBy("k").orderBy(F.desc("told"), "feature")
    enough = sum(F.col(f"n{k}") for k in range(len(domains))) >= F.lit(max(3.0, 0.002 * n.sum()))
    kept = (counts.filter(enough).withColumn("best", best).select("*", "best.k", "best.told").filter("told > 0.01")
            .withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= each).drop("k", "told", "nth", "best").distinct())
    table = sorted(kept.collect(), key=lambda r: r["feature"])  # at most MAX_FEATURES rows
    present = (np.array([[r[f"n{k}"] for k in range(len(domains))] for r in table]).reshape(-1, len(domains)) + 0.5) / (n + 1.0)
    prior = np.log((n + 1.0) / (n.sum() + len(domains)))
    return [r["feature"] for r in table], np.log(present) - np.log1p(-present), prior + np.log1p(-present).sum(axis=0)


def _doubles(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def posteriors(text: Column, w: Column, model: tuple[list[str], np.ndarray, np.ndarray], temperature: float) -> Column:
    """Array of the domains' posteriors. ``w``: the lower-cased words of the text."""
    features, weight, base = model
    scores = _doubles(base)
    if features:
        table = F.create_map(*[c for f, row in zip(features, weight) for c in (F.lit(f), _doubles(row))])
        found = F.array_intersect(_feature_array(text, w), F.array(*[F.lit(f) for f in features]))
        scores = F.aggregate(found, scores, lambda s, f: F.zip_with(s, F.element_at(table, f), lambda x, y: x + y))
    # Each step binds its array once.
    softmax = lambda s: F.transform(s, lambda x: F.exp((x - F.array_max(s)) / temperature))
    scaled = F.transform(F.array(scores), softmax)
    return F.transform(scaled, lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))[0]


def _rate(p: Column, steps: list[np.ndarray], least_rate: float, start: Column | None = None) -> Column:
    """The rate after the steps, from ``start`` (1 if None)."""
    start = F.lit(float(max(1.0, least_rate))) if start is None else start
    if not steps:
        return start
    return F.aggregate(F.array(*[_doubles(c) for c in steps]), start,
                       lambda r, c: F.greatest(F.lit(float(least_rate)), r - _dot(p, c)))


def fit_steps(rows: DataFrame, target: np.ndarray, least_rate: float) -> list[np.ndarray]:
    """The steps of the rates for ``rows`` (t, p) towards the domains' target tokens."""
    k = len(target)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    gram = rows.agg(*[F.sum(F.col("t") * F.col("p")[i] * F.col("p")[j]).alias(f"m{i}_{j}") for i, j in pairs]).first()
    m = np.zeros((k, k))
    for i, j in pairs:
        m[i, j] = m[j, i] = gram[f"m{i}_{j}"] or 0.0
    inverse = np.linalg.pinv(m, rcond=1e-9, hermitian=True)
    steps: list[np.ndarray] = []
    before = None
    state = rows.select("t", "p", _rate(F.col("p"), [], least_rate).alias("r"))
    for n in range(STEPS):
        last = steps[n - n % WRITE_EVERY:]
        if n and not last:
            state = written(state.withColumn("r", _rate(F.col("p"), steps[-WRITE_EVERY:], least_rate, F.col("r"))), "rates")
        sums = state.withColumn("taken", F.col("t") * _rate(F.col("p"), last, least_rate, F.col("r"))).agg(*[F.sum(F.col("taken") * F.col("p")[i]).alias(f"s{i}") for i in range(k)]).first()
        gap = np.array([sums[f"s{i}"] or 0.0 for i in range(k)]) - target
        step = inverse @ gap
        close = TOLERANCE * max(1.0, target.sum())
        if np.abs(gap).sum() <= close or np.abs(step).max() < 1e-9 or (before is not None and np.abs(gap - before).sum() <= close / 10):
            break
        before = gap
        steps.append(step)
    return steps


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], least_rate: float = 0.0, temperature: float = 4.0,
        id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with tokens, posteriors, rate and copies, and the names of these four columns.

    labelled: (doc_id, domain). weights: target share of the expected tokens for each domain. The
    expected tokens add up to the corpus's, or, where rates may not be under 1, to the least
    number at which no domain has to give up tokens. copies: the rate's floor, plus 1 with the chance of its
    fraction, drawn from a hash of the id and the text.
    """
    domains = sorted(weights)
    share = np.array([weights[d] for d in domains], dtype=float)
    share = share / share.sum()
    model = learn(docs, labelled, domains, id_col, text_col)
    w, t, p, rate, copies = unused(docs.columns, "w", "n_tokens", "posteriors", "rate", "copies")
    withw = docs.withColumn(w, words(F.lower(F.col(text_col))))
    rows = written(withw.withColumn(t, F.size(F.col(w)).cast("long")).withColumn(p, posteriors(F.col(text_col), F.col(w), model, temperature)).drop(w), "posteriors")
    narrow = rows.select(F.col(t).alias("t"), F.col(p).alias("p"))
    sums = narrow.agg(*[F.sum(F.col("t") * F.col("p")[i]).alias(f"s{i}") for i in range(len(domains))]).first()
    now = np.array([sums[f"s{i}"] or 0.0 for i in range(len(domains))])
    total = now.sum() if least_rate < 1 else float(np.max(np.where(share > 0, now / np.where(share > 0, share, 1), 0.0), initial=0.0))
    steps = fit_steps(narrow, share * total, least_rate)
    draw = F.xxhash64(id_col, text_col).bitwiseAND((1 << 52) - 1) / F.lit(float(1 << 52))
    # The rate is rounded, so that it does not depend on the order in which sums were added.
    rated = rows.withColumn(rate, F.round(_rate(F.col(p), steps, least_rate), 6))
    counted = rated.withColumn(copies, (F.floor(rate) + (draw < F.col(rate) - F.floor(rate)).cast("int")).cast("long"))
    return counted, [t, p, rate, copies]


def taken(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], least_rate: float = 0.0) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say."""
    rows, (t, p, rate, copies) = mix(docs, labelled, weights, least_rate)
    (nth,) = unused(rows.columns, "nth")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))
    return rows.filter(F.col(copies) > 0).withColumn(nth, each).drop(nth, t, p, rate, copies)
