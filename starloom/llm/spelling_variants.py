"""Spelling variants by blocked Gram matrices of letter counts.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. A word's form is its near word of largest count, if that is at
least ``ratio`` times its own; its root is where the forms lead.

1. Words are counted by a partial aggregation, so a frequent word is no hot key.
2. One edit changes the letter counts of a word by a squared distance of 1 (insertion,
   deletion) or 2 (replacement), in one or two letters. The letters are dealt to PARTS parts
   of like weight, so two near words have equal counts in all but two parts: a word goes into
   one block for each choice of PARTS - 2 parts, keyed by its counts there. A
   block above TILE words is dealt out in tiles, two tiles a task.
3. In a task, words of one length and of the next one are compared by a NumPy product of
   their count matrices: |a|^2 + |b|^2 - 2 a.b is their squared distance, for
   all pairs of the two length blocks at once. Pairs at 2 (one length) and at 1 (adjacent
   lengths) are kept; a pair counts in the first block it shares.
4. Edits are verified on the code points: one place differs, or the common head and the
   common tail cover the shorter word.
5. Forms by one aggregation over the pairs; roots by pointer jumping (a form is ``ratio`` times
   more frequent than the word, so a path has log(largest count) steps at most).

Memory of a task is bounded by two tiles and by the pairs verified at once, not by the vocabulary.

Cases: null, empty and blank texts have no words. Very long texts, and words of any length, are read whole.
Equal texts and repeated rows count as often as they stand. Ties of the largest count: smallest word
in code-point order. A null id means no deletion in the query's rule. Equal counts alone (anagrams) are not
near. An empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.arrow import whole_groups
from starloom.llm.common import written

#: The letters of a word: a-z and U+00C0 to U+00FF (also those that stand upper-cased there).
FIRST, LATIN, LETTERS = ord("a"), 0xC0, 26 + 64
RUN = r"[A-Za-zÀ-ÿ]+"
#: Parts that the letters are dealt to.
PARTS = 5
#: Words of a tile; words of the length blocks multiplied together.
TILE = 2048
#: Longest words whose squared distances are exact in 32 bits.
EXACT = 2000
#: Code points compared at once when edits are verified.
CELLS = 4 << 20
TASK_KEYS = ["combo", "key", "bi", "bj"]

_WEIGHTS = np.random.default_rng(13).integers(1, 1 << 62, LETTERS).astype(np.uint64)


def lowered(word: Column) -> Column:
    """A-Z lower-cased; other letters as they are."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, upper, upper.lower()))


def letter_runs(docs: DataFrame, shortest: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, run): the maximal letter runs of at least ``shortest`` code points, A-Z lower-cased, a row for each place."""
    runs = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(RUN), F.lit(0))
    found = docs.select(F.col(id_col).alias("doc_id"), F.explode(runs).alias("run")).filter(F.length("run") >= shortest)
    return found.select("doc_id", lowered(F.col("run")).alias("run"))


def with_planted_typos(runs: DataFrame, one_in: int = 31) -> DataFrame:
    """(word): the contract's words; where ``one_in`` divides crc32(doc_id:run), one code point goes."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select("run", h.alias("h")).select(F.when(F.col("h") % one_in == 0, short).otherwise(F.col("run")).alias("word"))


def counted(words: DataFrame, shortest: int = 7, least: int = 2) -> DataFrame:
    """(word, n) of the words of at least ``shortest`` code points that occur ``least`` times or more."""
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def letter_parts(vocabulary: DataFrame, parts: int = PARTS) -> list[int]:
    """The part of each letter: letters by falling frequency, dealt to and fro. Collects a row a letter."""
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").groupBy("c").count()
    weight = {_letter(ord(r["c"])): r["count"] for r in letters.collect()}
    order = sorted(range(LETTERS), key=lambda x: (-weight.get(x, 0), x))
    out = [0] * LETTERS
    for i, letter in enumerate(order):
        k = i % (2 * parts)
        out[letter] = k if k < parts else 2 * parts - 1 - k
    return out


def _letter(code):
    return code - FIRST if code < 128 else code - LATIN + 26


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all words, one after the other, and the length of each word."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.where(code < 128, code - FIRST, code - LATIN + 26), length


def _counts(letters: np.ndarray, length: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(length)), length)
    return np.bincount(owner * LETTERS + letters, minlength=len(length) * LETTERS).reshape(-1, LETTERS)


def _part_keys(counts: np.ndarray, part: np.ndarray) -> np.ndarray:
    """A hash of the counts in each part: (words, parts)."""
    weighed = counts.astype(np.uint64) * _WEIGHTS
    return np.stack([weighed[:, part == p].sum(axis=1, dtype=np.uint64) for p in range(int(part.max()) + 1)], axis=1)


def _combos(parts: int) -> list[tuple[int, ...]]:
    return list(combinations(range(parts), parts - 2))


def _blocks(part: np.ndarray, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _part_keys(_counts(*_codes(batch.column("word").to_pylist())), part)
            for c, combo in enumerate(_combos(parts)):
                key = np.zeros(len(keys), np.uint64)
                for p in combo:
                    key = (key ^ keys[:, p]) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(31)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), c, np.int32)), pa.array(key.view(np.int64)), batch.column("word"), batch.column("n")],
                    ["combo", "key", "word", "n"])
    return run


def _one_edit(letters: np.ndarray, first: np.ndarray, size: int, longer: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words i (of ``size`` letters) and j (of ``size`` + ``longer``) differ by one edit."""
    out = np.zeros(len(i), bool)
    step = max(1, CELLS // (size + 1))
    for k in range(0, len(i), step):
        a = letters[first[i[k : k + step], None] + np.arange(size)]
        b = letters[first[j[k : k + step], None] + np.arange(size + longer)]
        if not longer:
            out[k : k + step] = (a != b).sum(axis=1) == 1
            continue
        head = np.logical_and.accumulate(a == b[:, :size], axis=1).sum(axis=1)
        tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
        out[k : k + step] = head + tail >= size
    return out


def _tasks(t: pa.Table, starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of whole groups, about TILE rows or one group."""
    a = 0
    for k in range(1, len(starts)):
        if k == len(starts) - 1 or starts[k + 1] - starts[a] > TILE:
            yield int(starts[a]), int(starts[k])
            a = k


def _near_pairs(part: np.ndarray, parts: int):
    combos = np.zeros((len(_combos(parts)), parts), bool)
    for c, combo in enumerate(_combos(parts)):
        combos[c, list(combo)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, TASK_KEYS):
            combo, key, side = (t.column(c).to_numpy() for c in ("combo", "key", "side"))
            crossing = t.column("bi").to_numpy() != t.column("bj").to_numpy()
            group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            words = t.column("word").to_pylist()
            letters, length = _codes(words)
            first = np.cumsum(length) - length
            left, right = [], []
            for a, b in _tasks(t, starts):
                order = a + np.argsort(length[a:b], kind="stable")
                counts = _counts(letters[first[a] : first[b - 1] + length[b - 1]], length[a:b])
                keys = _part_keys(counts, part)
                used = np.flatnonzero(counts.any(axis=0))
                m = counts[:, used].astype(np.float32 if length[a:b].max() <= EXACT else np.float64)
                square = (m * m).sum(axis=1)
                sizes, at = np.unique(length[order], return_index=True)
                at = np.append(at, len(order))
                for s, size in enumerate(sizes.tolist()):
                    x = order[at[s] : at[s + 1]] - a
                    for longer in (0, 1):
                        if s + longer >= len(sizes) or sizes[s + longer] != size + longer:
                            continue
                        y = order[at[s + longer] : at[s + longer + 1]] - a
                        distance = square[x, None] + square[y] - 2 * (m[x] @ m[y].T)
                        p, q = np.nonzero(distance == (1 if longer else 2))
                        p, q = x[p], y[q]
                        keep = group[p + a] == group[q + a]
                        if not longer:
                            keep &= (p < q) | crossing[p + a]
                        keep &= ~crossing[p + a] | (side[p + a] < side[q + a] if not longer else side[p + a] != side[q + a])
                        p, q = p[keep], q[keep]
                        equal = keys[p] == keys[q]  # the first choice of parts in which they are equal is this one
                        agree = (equal @ combos.T.astype(np.int64)) == parts - 2
                        keep = agree[np.arange(len(p)), combo[p + a]] & (agree.argmax(axis=1) == combo[p + a])
                        p, q = p[keep] + a, q[keep] + a
                        keep = _one_edit(letters, first, size, longer, p, q)
                        left.append(p[keep])
                        right.append(q[keep])
            i, j = np.concatenate(left + right), np.concatenate(right + left)
            w, n = t.column("word"), t.column("n")
            yield pa.RecordBatch.from_arrays(
                [x.combine_chunks() for x in (w.take(i), n.take(i), w.take(j), n.take(j))], ["word", "n", "near", "near_n"])
    return run


def near_words(vocabulary: DataFrame, parts: int = PARTS) -> DataFrame:
    """(word, n, near, near_n): every pair of words one edit apart, in both directions, each once."""
    part = np.array(letter_parts(vocabulary, parts))
    rows = written(vocabulary.mapInArrow(_blocks(part, parts), "combo int, key long, word string, n long"), "letter-blocks")
    sizes = rows.groupBy("combo", "key").agg(F.count("*").alias("rows")).filter("rows > 1")
    tiles = F.ceil(F.col("rows") / TILE)
    members = (
        rows.join(sizes, ["combo", "key"])
        .withColumn("own", F.pmod(F.xxhash64("word"), tiles)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
        .select("combo", "key", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"),
                (F.col("own") > F.col("other")).cast("int").alias("side"), "word", "n"))
    return members.repartition(*TASK_KEYS).sortWithinPartitions(*TASK_KEYS).mapInArrow(
        _near_pairs(part, parts), "word string, n long, near string, near_n long")


def variants(vocabulary: DataFrame, ratio: int = 10, parts: int = PARTS) -> DataFrame:
    """(word, form, root, n, n_near, form_n), a row for each row of ``vocabulary`` (word, n)."""
    vocabulary = written(vocabulary, "vocabulary")
    pairs = near_words(vocabulary, parts)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = written(pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"), F.any_value("n").alias("n")).select(
        "word", "n_near", F.when(-F.col("best.less") >= ratio * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.less")).alias("n"))).alias("form")),
        "near-words")
    jump = written(near.filter("form is not null").select("word", F.col("form.form").alias("root")), "roots")
    while True:
        onward = jump.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = written(jump.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        jump = after.select("word", "root")
        if after.filter("moved").isEmpty():
            break
    return (
        vocabulary.join(near, "word", "left").join(jump, "word", "left")
        .select("word", F.col("form.form").alias("form"), F.coalesce("root", "word").alias("root"), "n",
                F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("form.n").alias("form_n")))
