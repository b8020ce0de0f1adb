"""Quality rules whose cutoffs have a bounded false-rejection rate.

Each rule is a share that is high in bad texts, with a fixed ladder of cutoffs
from lenient to strict. Together the ladders make one fixed sequence of rule sets,
each of which rejects what the one before rejects and more: first every rule's
most lenient cutoff, one rule after the other, then every rule's next one.
Labelled documents are the holdout: the sequence does not depend on them.
For each stratum the sets are tested in order. A set is certified when, of n good
holdout texts with k rejected by it, P(Binomial(n, alpha) <= k) <= delta / strata:
the exact (Clopper-Pearson) upper bound of its false-rejection rate at that
confidence is at most alpha. The first set that fails ends the sequence, so only the
strata need the Bonferroni correction, and 90 good texts without a rejected one
certify a set at alpha = delta = 0.05 and four strata. With probability 1 - delta, in every
stratum the rules reject at most alpha of the good texts that the base rules pass (the
base rules are given and carry no bound). Among the certified sets, that with the most bad
less good holdout texts rejected is taken, the more lenient on ties; a stratum
without one (too few good labels) rejects nothing beyond the base rules.

Equal texts of a stratum are one piece of evidence, as copies tell nothing new: good if any
of them is labelled good. Near copies are separate texts.

Words are runs without ASCII white space, from whole texts. Cases: null, empty
and blank texts have no words and fail the base rules. A document whose
labels disagree, or are null, is no holdout. A null stratum is a stratum.
Repeated rows are rows of their own, and one text in the holdout. Very long texts are read whole, and ties
of a rule's value with its cutoff pass. Empty tables give no rows, or no certified cutoffs. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log, log1p

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.arrow import Words, run_ranks, text_slices
from starloom.llm.common import text_key, written

#: Symbol characters, words of a repeated window, bounds of the base rules.
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
SPACES = " \t\n\r\x0b\x0c"

#: Cutoffs of each rule, lenient to strict.
LADDERS = {
    "symbol_rate": (4.0, 2.0, 1.0, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12, 0.08, 0.05),
    "capital_share": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2),
    "exclamation_rate": (4.0, 2.0, 1.0, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12, 0.08),
    "duplicate_line_share": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25),
    "repeat_share": (0.29, 0.27, 0.25, 0.22, 0.2, 0.17, 0.15, 0.12, 0.1),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: Words) -> np.ndarray:
    """For each text, its words in windows found twice or more in it."""
    starts, owner = words.run_starts(REPEAT_WINDOW)
    covered = np.zeros(len(words.codes) + 1, dtype=np.int64)
    if len(starts):
        rank = run_ranks(words.codes, REPEAT_WINDOW)[starts]
        _, inverse, number = np.unique(owner * (int(rank.max()) + 1) + rank, return_inverse=True, return_counts=True)
        hit = starts[number[inverse] > 1]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + REPEAT_WINDOW, -1)
    upto = np.concatenate([[0], np.cumsum(np.cumsum(covered)[:-1] > 0)])
    return upto[words.ends] - upto[words.ends - words.counts]


def _duplicate_lines(text: str) -> tuple[int, int]:
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines)), len(lines)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        words = Words([t.encode() for t in texts])
        n = words.counts
        repeat = repeated_words(words)
        lines = np.array([_duplicate_lines(t) for t in texts], dtype=np.int64).reshape(-1, 2)
        symbols = np.array([sum(map(t.count, SYMBOLS)) for t in texts], dtype=np.int64)
        chars = np.array([len(t) - sum(map(t.count, SPACES)) for t in texts], dtype=np.int64)
        marks = np.array([t.count("!") for t in texts], dtype=np.int64)
        raw = np.frombuffer(words.joined + b" ", dtype=np.uint8)
        ends = words.offset[words.ends]
        begins = words.offset[words.ends - n]
        count = lambda lo, hi: (c := np.concatenate([[0], np.cumsum((raw >= lo) & (raw <= hi))]))[np.minimum(ends, len(raw))] - c[np.minimum(begins, len(raw))]
        upper, lower = count(65, 90), count(97, 122)
        share = lambda a, b: np.divide(a, b, out=np.zeros(len(n)), where=b > 0)
        columns = {
            "doc_id": part.column("doc_id"), "stratum": part.column("stratum"), "tk": part.column("tk"),
            "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines[:, 0], "n_repeat_words": repeat,
            "symbol_rate": share(symbols, n), "capital_share": share(upper, upper + lower), "exclamation_rate": share(marks, n),
            "duplicate_line_share": share(lines[:, 0], lines[:, 1]), "repeat_share": share(repeat, n)}
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


def features(docs: DataFrame, stratum_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stratum, tk, counts, rule values, base_failed) for each row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tk", text_key(F.col("text")))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, stratum string, tk binary, " + ", ".join([*(f"{c} long" for c in COUNTS), *(f"{c} double" for c in LADDERS)])
    return rows.mapInArrow(_features, schema).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), summed from its largest term down."""
    if k >= n:
        return 1.0
    total, k = 0.0, int(k)
    for i in range(k, -1, -1):
        term = exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p))
        total += term
        if term < 1e-18 * total and i < n * p:
            break
    return total


#: The sequence: (rule, cutoff) by ladder step, then rule. Set i holds the first i + 1 of them, of each rule the strictest.
SEQUENCE = [(rule, ladder[step]) for step in range(max(map(len, LADDERS.values()))) for rule, ladder in LADDERS.items() if step < len(ladder)]


def choose_set(counts: pd.DataFrame, alpha: float, delta: float) -> int | None:
    """The place in SEQUENCE of the last cutoff in force, from one stratum's holdout: rows (place, quality, n).

    place: the first set of the sequence that rejects the text, len(SEQUENCE) if none does.
    """
    rejected = {q: np.cumsum(np.bincount(own["place"], weights=own["n"], minlength=len(SEQUENCE) + 1)) if len(own := counts[counts["quality"] == q])
                else np.zeros(len(SEQUENCE) + 1) for q in (0, 1)}
    n_good, best, place = int(rejected[1][-1]), 0, None
    for i in range(len(SEQUENCE)):
        if binomial_cdf(int(rejected[1][i]), n_good, alpha) > delta:
            break
        gain = rejected[0][i] - rejected[1][i]
        if place is None or gain > best:
            best, place = gain, i
    return place


def first_place(value) -> Column:
    """The first set that rejects a row. ``value``: name -> column of a rule's value."""
    places = [F.when(value(rule) > cut, F.lit(i)) for i, (rule, cut) in enumerate(SEQUENCE)]
    return F.coalesce(F.least(*places), F.lit(len(SEQUENCE)))  # least leaves out nulls


def cutoffs(rows: DataFrame, labels: DataFrame, alpha: float, delta: float) -> DataFrame:
    """(stratum, n_good, cut_<rule> ...): a row for each stratum with labelled documents; rows need tk, the identity of a text."""
    agreed = (labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
              .filter("quality = most").select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality")))
    # What the base rules reject is no case for a cutoff. Equal texts have equal values.
    held = rows.filter(~F.col("base_failed")).join(agreed, F.col("doc_id") == F.col("label_id"))
    texts = held.withColumn("place", first_place(F.col)).groupBy("stratum", "tk").agg(
        F.max("quality").alias("quality"), F.any_value("place").alias("place"))
    counts = written(texts.groupBy("stratum", "place", "quality").agg(F.count("*").alias("n")), "holdout")
    strata = max(1, counts.select("stratum").distinct().count())

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        place = choose_set(pdf, alpha, delta / strata)
        cut = {rule: c for rule, c in SEQUENCE[: 0 if place is None else place + 1]}  # the last of a rule is its strictest
        n_good = int(pdf[pdf["quality"] == 1]["n"].sum())
        return pd.DataFrame([{"stratum": pdf["stratum"].iloc[0], "n_good": n_good} | {f"cut_{r}": cut.get(r) for r in LADDERS}])

    # A group has at most 2 * (len(SEQUENCE) + 1) rows, whatever the number of documents.
    return counts.groupBy("stratum").applyInPandas(one, "stratum string, n_good long, " + ", ".join(f"cut_{r} double" for r in LADDERS))


def judge(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", alpha: float = 0.05, delta: float = 0.05,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The features of each row, its stratum's cutoffs and ``kept``."""
    rows = written(features(docs, stratum_col, id_col, text_col), "quality-features")
    cuts = written(cutoffs(rows, labels.select("doc_id", "quality"), alpha, delta), "cutoffs").withColumnRenamed("stratum", "cut_stratum")
    passed = F.lit(True)
    for rule in LADDERS:
        passed &= F.coalesce(F.col(rule) <= F.col(f"cut_{rule}"), F.lit(True))
    return (rows.join(cuts, rows["stratum"].eqNullSafe(cuts["cut_stratum"]), "left").drop("cut_stratum")
            .withColumn("kept", ~F.col("base_failed") & passed))
