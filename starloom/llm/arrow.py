"""Helpers for Arrow tasks: bounded slices of texts, whole groups of sorted rows, shingle hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from starloom.llm.common import SHINGLE_WORDS

#: Text bytes handled at once; a longer text makes a slice of its own.
SLICE_BYTES = 4 << 20


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batches cut into slices of about SLICE_BYTES of text, with the texts (null: empty)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            yield part, [t or "" for t in part.column(column).to_pylist()]


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000,
                 size: int | None = None) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, about ``rows`` rows, ``size`` bytes or one group long, and where each group starts (its length last).

    The rows of a partition must be sorted by the keys.
    """
    held: list[pa.RecordBatch] = []

    def cut(last: bool):
        t = pa.Table.from_batches(held).combine_chunks()
        new = np.zeros(max(t.num_rows - 1, 0), dtype=bool)
        for k in keys:
            v = t.column(k).to_numpy()
            new |= v[1:] != v[:-1]
        starts = np.concatenate([[0], np.flatnonzero(new) + 1]).astype(np.int64)
        if last:
            return t, np.append(starts, t.num_rows), None
        return t.slice(0, starts[-1]), starts, t.slice(starts[-1])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows or size and sum(b.nbytes for b in held) >= size:
            done, starts, rest = cut(last=False)
            held = rest.to_batches()
            if done.num_rows:
                yield done, starts
    if held:
        done, starts, _ = cut(last=True)
        yield done, starts


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts, one after the other, and the number of words of each text."""
    split = [t.lower().encode().split() for t in texts]  # bytes.split: ASCII white space
    counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    flat = np.empty(int(counts.sum()), dtype=object)
    flat[:] = [w for ws in split for w in ws]
    if not len(flat):
        return np.zeros(0, np.uint64), counts
    codes, distinct = pd.factorize(flat)
    return pd.util.hash_array(distinct, categorize=False)[codes], counts


def shingle_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the five-word shingles of all texts, repeats included, and their number in each text.

    A text of one to four words has one shingle, all its words; without words it has none.
    """
    n = SHINGLE_WORDS
    h, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    number = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    starts = np.repeat(ends - counts - np.concatenate([[0], np.cumsum(number)[:-1]]), number) + np.arange(number.sum())
    length = np.repeat(np.minimum(counts, n), number)
    out = length.astype(np.uint64)
    for k in range(n):
        has = length > k
        w = h[np.where(has, starts + k, 0)] if len(h) else h
        mixed = (out ^ w) * np.uint64(0x9E3779B97F4A7C15)
        out = np.where(has, mixed ^ (mixed >> np.uint64(29)), out)
    return out, number


class Words:
    """The words of some texts, one after the other: codes, hashes, offsets in the joined bytes, and each text's range."""

    def __init__(self, texts: list[bytes]):
        split = [t.split() for t in texts]  # ASCII white space
        self.counts = np.fromiter(map(len, split), np.int64, len(split))
        self.ends = np.cumsum(self.counts)
        flat = np.empty(int(self.counts.sum()), dtype=object)
        flat[:] = [w for ws in split for w in ws]
        self.codes, distinct = pd.factorize(flat)
        self.distinct = distinct
        self.joined = b" ".join(flat.tolist())
        length = np.fromiter(map(len, distinct), np.int64, len(distinct))[self.codes] if len(flat) else np.zeros(0, np.int64)
        self.offset = np.concatenate([[0], np.cumsum(length + 1)])

    def hashes(self) -> np.ndarray:
        return pd.util.hash_array(self.distinct, categorize=False)[self.codes] if len(self.codes) else np.zeros(0, np.uint64)

    def run_starts(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of ``length`` words of one text start, and whose text it is."""
        number = np.maximum(self.counts - length + 1, 0)
        owner = np.repeat(np.arange(len(self.counts)), number)
        first = self.ends - self.counts
        before = np.cumsum(number) - number
        return np.arange(number.sum()) - np.repeat(before - first, number), owner

    def packed(self, first: int, past: int) -> bytes:
        return self.joined[self.offset[first] : self.offset[past] - 1]


def run_ranks(codes: np.ndarray, length: int) -> np.ndarray:
    """For each position the rank of the ``length`` codes from it on: equal ranks, equal codes. The last length - 1 are left out."""
    rank, width = codes.astype(np.int64), 1
    while width < length:
        step = min(width, length - width)
        a, b = rank[:-step], rank[step:]
        rank = pd.factorize(a * (int(rank.max()) + 1) + b)[0].astype(np.int64)
        width += step
    return rank
