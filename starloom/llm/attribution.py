"""Token counts of sections, from one encoding of the whole document.

A document is encoded once with a byte-level BPE vocabulary; the lengths of the
tokens' bytes give each token's span. The spans are interval-joined with those of
the document's sections (its lines, or the rows of a table of character spans). A token that
touches more than one section, or a section and what lies outside, crosses a
boundary and is allocated by a rule:

- ``majority``: to the one that has most of its bytes, the earliest on ties
  (outside counts as the last);
- ``first``: to the one that has its first byte, the earliest section if several have;
- ``share``: to each by its share of the bytes (counts are then fractions).

Sections may touch, leave gaps, nest or overlap. With ``majority`` and ``first`` and for sections that
do not overlap, the counts of a document, outside included, add up to its tokens.

Cases: every document has a row for what lies outside its sections (section -1, null span),
so null and empty texts have one row of 0 tokens. Rows that repeat are counted alike. Spans are cut
to the text; null, empty and reversed spans get 0 tokens. Null ids keep their lines but match no row of a
section table. Very long texts are encoded whole, one at a time in a slice; ties are as the rules say. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.arrow import text_slices

#: Fixed value: the pattern that parts a text before the merges, as published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("majority", "first", "share")
OUTSIDE = -1


class Encoder:
    """Token spans under a vocabulary file of lines ``base64(bytes) rank``."""

    def __init__(self, vocabulary: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Byte offset at which each token ends."""
        return np.cumsum(self.length[np.array(self.encoding.encode_ordinary(text), dtype=np.int64)])


def byte_offsets(text: str, size: int) -> np.ndarray | None:
    """Byte offset of each character and of the end; None where characters are bytes."""
    if len(text) == size:
        return None
    code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.concatenate([[0], np.cumsum(1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))])


def allocate(ends: np.ndarray, begin: np.ndarray, past: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section and of what lies outside (last), and how many of them cross a boundary.

    ends: byte ends of the tokens; begin, past: byte spans of the sections in their order.
    """
    n, k = len(ends), len(begin)
    starts = np.concatenate([[0], ends[:-1]])
    # Each section touches the tokens from the first that ends behind its begin to the last that starts before its end.
    lo = np.searchsorted(ends, begin, side="right")
    hi = np.maximum(np.searchsorted(starts, past, side="left"), lo)
    hi = np.where(past > begin, hi, lo)
    number = hi - lo
    section = np.repeat(np.arange(k), number)
    token = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) + np.repeat(lo, number)
    common = np.minimum(ends[token], past[section]) - np.maximum(starts[token], begin[section])
    length = ends - starts
    # Bytes of each token in no section: those of its span less those of the sections' union.
    order = np.argsort(begin, kind="stable")
    b, p = begin[order], np.maximum.accumulate(past[order]) if k else past
    b = np.minimum(np.maximum(b, np.concatenate([[0], p[:-1]])), p) if k else b
    widths = np.concatenate([[0], np.cumsum(p - b)])
    upto = lambda x: widths[at := np.searchsorted(b, x, side="right")] - np.maximum(0, np.concatenate([[0], p])[at] - x) if k else np.zeros(len(x), np.int64)
    outside = length - (upto(ends) - upto(starts))
    bare = np.flatnonzero(outside > 0)
    token, section, common = np.concatenate([token, bare]), np.concatenate([section, np.full(len(bare), k)]), np.concatenate([common, outside[bare]])
    crossing = np.bincount(token, minlength=n) > 1
    if rule == "share":
        weight = common / np.bincount(token, weights=common, minlength=n)[token]
        return np.bincount(section, weights=weight, minlength=k + 1), np.bincount(section[crossing[token]], minlength=k + 1)
    rank = np.concatenate([np.argsort(order, kind="stable"), [k]])  # earliest first, outside last
    if rule == "majority":
        by = np.lexsort((rank[section], -common, token))
    else:
        has_first = np.where(section < k, begin[np.minimum(section, k - 1)] <= starts[token] if k else False, False)
        # Outside has the first byte when no section has.
        some = np.zeros(n, dtype=bool)
        some[token[has_first]] = True
        has_first |= (section == k) & ~some[token]
        by = np.lexsort((rank[section], ~has_first, token))
    t, s = token[by], section[by]
    chosen = np.concatenate([[True], t[1:] != t[:-1]]) if len(t) else np.zeros(0, bool)
    t, s = t[chosen], s[chosen]
    return np.bincount(s, minlength=k + 1), np.bincount(s[crossing[t]], minlength=k + 1)


def _lines(text: str) -> list[tuple[int, int, int]]:
    """(number, begin, end) of the lines that are not empty, in characters."""
    out, at = [], 0
    for i, line in enumerate(text.split("\n")):
        if line:
            out.append((i, at, at + len(line)))
        at += len(line) + 1
    return out


def attribute(docs: DataFrame, vocabulary: bytes, rule: str = "majority", sections: DataFrame | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, section, first_char, past_char, n_tokens, n_crossing): a row for each section and for what lies outside.

    sections: (doc_id, section int, first_char, past_char), in characters of the text; the lines of the text if None.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    if sections is not None:
        span = F.struct(F.col("first_char").cast("long").alias("a"), F.col("past_char").cast("long").alias("b"), F.col("section").cast("int").alias("section"))
        spans = sections.groupBy(F.col("doc_id").alias("span_id")).agg(F.sort_array(F.collect_list(span)).alias("spans"))
        rows = rows.join(spans, F.col("doc_id") == F.col("span_id"), "left").drop("span_id")
    by_lines = sections is None
    kind = pa.float64() if rule == "share" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for part, texts in text_slices(batches):
            given = [None] * len(texts) if by_lines else part.column("spans").to_pylist()
            owner, out = [], []
            for i, (text, spans) in enumerate(zip(texts, given)):
                ends = encoder.ends(text)
                found = _lines(text) if by_lines else [(s["section"], s["a"], s["b"]) for s in spans or []]
                begin, past = (np.array([0 if f[x] is None else f[x] for f in found], dtype=np.int64) for x in (1, 2))
                begin, past = np.clip(begin, 0, len(text)), np.clip(past, 0, len(text))
                offsets = byte_offsets(text, int(ends[-1]) if len(ends) else 0)
                if offsets is not None:
                    begin, past = offsets[begin], offsets[past]
                count, crossing = allocate(ends, begin, np.maximum(begin, past), rule)
                owner += [i] * len(count)
                out += zip([*(f[0] for f in found), OUTSIDE], [*(f[1] for f in found), None], [*(f[2] for f in found), None],
                           count.tolist(), crossing.tolist())
            columns = list(zip(*out))
            kinds = (pa.int32(), pa.int64(), pa.int64(), kind, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(owner, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                ["doc_id", "section", "first_char", "past_char", "n_tokens", "n_crossing"])

    return rows.mapInArrow(run, f"doc_id {id_type}, section int, first_char long, past_char long, "
                                f"n_tokens {'double' if rule == 'share' else 'long'}, n_crossing long")
