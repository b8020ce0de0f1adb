"""Periodic runs of words: recursive frequency splitting, then a lag scan of what survives.

A run is a stretch of consecutive words whose smallest period is q (words q
apart are identical), of at least ``least_words`` and ``least_periods`` * q
words, that no neighbouring word extends keeping period q.

1. Splitting. A word of a run occurs at least ``least_periods`` times in it. So a
   word that occurs less often in its segment belongs to no run and splits
   the segment; pieces below ``least_words`` go. Only changed segments are
   counted again, until no segment changes. At first a segment is a whole text.
2. Lags. Comparing a surviving segment with itself at every lag is quadratic in
   its length. A lag q can only hold a run where the next equal window of w
   words, w the least power of two >= q, is q words on: windows of one run no
   more than q apart differ, as q is its smallest period. Windows are ranked by
   doubling (equal rank, equal words), so the lags that can hold a run are
   found for all segments of a slice at once, in n log n.
3. Lag scan. For each such lag the stretch in which every window's next equal one is
   q words on is compared with itself at lag q and taken to its maximal ends.

Each task works on slices of about 4 MB of text, longer texts alone; nothing is
shuffled, so neither a frequent word nor a group of copies gathers anywhere.

Cases: a null, empty or blank text has no words, no runs and an empty collapsed text. Very
long texts are read whole, in memory and time nearly proportional to their length. Equal runs, repeated
rows, repeated and null ids are rows like others. Runs of different periods may overlap; ties of runs
do not arise, as start and period tell them apart (``strongest`` states its own tie rule). An empty
table gives no rows. Other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.arrow import Words, text_slices
from starloom.llm.common import words

#: Fewest words, and fewest repetitions of the period, of a run.
LEAST_WORDS, LEAST_PERIODS = 24, 3


def surviving_segments(codes: np.ndarray, segment: np.ndarray, least_words: int, least_periods: int) -> np.ndarray:
    """The positions, ascending, that recursive frequency splitting leaves. ``segment`` numbers the first segments, ascending."""
    kept = []
    # own: the number of a (segment, word) pair
    at, n_codes = np.arange(len(codes)), int(codes.max()) + 1 if len(codes) else 1
    while len(at):
        own = pd.factorize(segment * n_codes + codes[at])[0]
        enough = np.bincount(own)[own] >= least_periods
        whole = np.bincount(segment, weights=~enough)[segment] == 0
        long = np.bincount(segment)[segment] >= least_words
        kept.append(at[whole & long])  # stable
        left = enough & ~whole
        at, before = at[left], segment[left]
        if not len(at):
            break
        new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(before) != 0)])
        segment = np.cumsum(new) - 1
        size = np.bincount(segment)[segment]
        at, segment = at[size >= least_words], segment[size >= least_words]
        segment = pd.factorize(segment)[0].astype(np.int64)
    return np.sort(np.concatenate(kept)) if kept else np.zeros(0, np.int64)


def _same_apart(rank: np.ndarray) -> np.ndarray:
    """For each place how far on the next equal rank is; 0 where none follows."""
    order = np.argsort(rank, kind="stable")
    gap = np.zeros(len(rank), np.int64)
    same = rank[order[1:]] == rank[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gap


def lag_scan(codes: np.ndarray, least_words: int, least_periods: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the runs in ``codes``; a code that stands once separates segments."""
    n, width = len(codes), 1
    rank = pd.factorize(codes)[0].astype(np.int64)
    while len(rank) and least_periods * (width // 2 + 1) <= n:
        gap = _same_apart(rank)
        hit = np.flatnonzero((gap > width // 2) & (gap <= width))
        if len(hit):
            new = np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(gap[hit]) != 0)])
            first = hit[new]
            last = hit[np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1)]
            lag = gap[first]
            length = last - first + width + lag
            for a, size, q in zip(first.tolist(), length.tolist(), lag.tolist()):
                if size >= max(least_words, least_periods * q) and np.array_equal(codes[a : a + size - q], codes[a + q : a + size]):
                    yield a, size, q
        if len(rank) <= width:
            break
        pair = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        rank, width = pd.factorize(pair)[0].astype(np.int64), 2 * width


def _runs(least_words: int, least_periods: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            own = Words([t.encode() for t in texts])
            codes = own.codes.astype(np.int64)
            owner = np.repeat(np.arange(len(texts)), own.counts)
            begin = own.ends - own.counts
            at = surviving_segments(codes, owner, least_words, least_periods)
            # The survivors one after the other, with a code of its own before each segment.
            new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(owner[at]) != 0)]) if len(at) else np.zeros(0, bool)
            place = np.arange(len(at)) + np.cumsum(new)
            packed = np.empty(len(at) + int(new.sum()), np.int64)
            origin = np.full(len(packed), -1, np.int64)
            packed[place], origin[place] = codes[at], at
            packed[origin < 0] = len(codes) + np.arange(int(new.sum()))
            found: dict[int, list[tuple[int, int, int]]] = {}
            for a, size, q in lag_scan(packed, least_words, least_periods):
                start = int(origin[a])
                found.setdefault(int(owner[start]), []).append((start - int(begin[owner[start]]), size, q))
            runs, collapsed = [], []
            for d, n in enumerate(own.counts.tolist()):
                mine = sorted(found.get(d, ()), key=lambda r: (r[0], r[2]))
                runs.append([{"start": s, "length": size, "period": q} for s, size, q in mine])
                first = int(begin[d])
                if not mine:
                    collapsed.append(own.packed(first, first + n).decode() if n else "")
                    continue
                covered = np.zeros(n + 1, np.int64)
                np.add.at(covered, [s + q for s, _, q in mine], 1)
                np.add.at(covered, [s + size for s, size, _ in mine], -1)
                stays = first + np.flatnonzero(np.cumsum(covered[:-1]) == 0)
                collapsed.append(b" ".join(own.distinct[own.codes[stays]]).decode())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(own.counts), pa.array(runs, RUNS), pa.array(collapsed, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])
    return run


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed), a row for each row of ``docs``.

    runs: (start, length, period) in words, by start, then period; collapsed: the words that no run holds
    after its first period, joined by one space.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return texts.mapInArrow(_runs(least_words, least_periods), schema)


def strongest(runs: Column) -> Column:
    """The run of greatest exact length / period (ties: least start, then period); null where there is none."""
    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)  # runs come by start, then period
    return F.reduce(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the contract's documents, every tenth (by crc32 of its id) with a periodic tail; a null id has none."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words(F.col("text"))).alias("words"))
    sized = chosen.withColumn("n", F.when(F.size("words") > 0, F.size("words").cast("long")))
    tail = sized.withColumn("a", F.col("g") % F.col("n"))
    tail = tail.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    planted = F.concat_ws(" ", F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
                                           lambda i: F.get("words", place(i).cast("int"))))
    return tail.select("doc_id", F.when(F.col("n").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The columns of the query from ``periodic_runs``: the strongest run, and SHA-256 of the runs and of the collapsed text."""
    best = strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    sha = lambda s: F.sha2(s.cast("binary"), 256)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        sha(F.concat_ws("", lines)).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"), "n_words")
