"""Removal of repeated 20-word passages by super-k-mer partitioning.

A window is 20 consecutive words of a document. Its minimiser is the three-word
run in it with the least hash. Consecutive windows share their minimiser, so
they travel together: one packed string of words goes to the minimiser's
bucket instead of one string for each window. In a bucket the strings' windows
get exact ranks (by doubling: runs of 1, 2, 4, 8, 16 and 20 words) and are sorted by
(rank, document, start); all but the first of each rank are repeats. Repeats
are sent back as word spans, and each document drops the words they cover.

A run of windows whose packed string occurs before within the same slice of
a task is a repeat without travelling, so thousands of copies cost one string
a slice. A minimiser that many documents share with different words around
it would be one large bucket: minimisers frequent in a sample of the
documents are split by the minimiser of each window under a second hash. The
sample steers only where windows meet, never which are found.

Documents are in the order (id, hash of the text); null ids come first. Cases: rows
that repeat an id with another text are documents of their own; exact repeats
of a row are one document and get the same result. Null, empty and blank texts
have no words. A text under 20 words keeps all. Very long texts are read whole, in a slice of their own. Ties: of windows with
equal words the first in that order stays. An empty table gives no rows. Extra
columns are ignored. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from starloom.llm.arrow import Words, text_slices, whole_groups
from starloom.llm.common import written

#: Words of a window and of a minimiser.
WINDOW, MINIMISER = 20, 3
#: Packed bytes a bucket should hold; packed strings take about three times the text.
BUCKET_BYTES = 8 << 20
#: One document in so many is read to find frequent minimisers; those in more than 1 / (2 * buckets) of the sampled runs are split.
SAMPLE = 64
#: Sampled runs that a split minimiser has at least.
LEAST_SPLIT = 64
#: places: id steps, hashes and first words of the strings; in bucket -1 past words too.
DEALT = "bucket int, places binary, packed binary"
SPAN = "doc_id long, tk long, first int, past int"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: Step of the window hash's powers, and its inverse modulo 2^64.
_STEP = np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
NULL_ID = np.iinfo(np.int64).min


def _mixed(h: np.ndarray, order: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX[order]
    return h ^ (h >> np.uint64(29))


def _least(v: np.ndarray, span: int) -> np.ndarray:
    """Position of the (leftmost) least value of v[i : i + span] for each i."""
    at, width = np.arange(len(v)), 1
    while width < span:
        step = min(width, span - width)
        a, b = at[:-step], at[step:]
        at = np.where(v[b] < v[a], b, a)
        width += step
    return at


def _runs(words: Words, split: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers: first window, last window, text, and key. ``split``: sorted minimisers dealt by a second one too."""
    starts, owner = words.run_starts(WINDOW)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    h = words.hashes()
    gram = h[: len(h) - MINIMISER + 1].copy()
    for k in range(1, MINIMISER):
        gram = _mixed(gram, 0) ^ h[k : len(h) - MINIMISER + 1 + k]
    span = WINDOW - MINIMISER + 1
    values = _mixed(gram, 0)
    at = _least(values, span)[starts]
    key = values[at]
    if len(split):
        hot = np.isin(key, split)
        if hot.any():
            second = _mixed(gram, 1)
            other = _least(second, span)[starts]
            at = np.where(hot, other - len(h), at)  # apart from every position of a first minimiser
            key = np.where(hot, _mixed(key ^ second[other], 1), key)
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(starts)) - 1
    return starts[begin], starts[end], owner[begin], key[begin]


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("doc_id").cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False), batch.column("tk").to_numpy()


def _sampled_minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in text_slices(batches):
        keys = _runs(Words([t.encode() for t in texts]), np.zeros(0, np.uint64))[3]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])


def _dealt(buckets: int, split: np.ndarray):
    """Packed strings by bucket; a row for a slice's strings of one bucket. Bucket -1 has spans found at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for part, texts in text_slices(batches):
            ids, tks = _ids(part)
            words = Words([t.encode() for t in texts])
            first, last, owner, key = _runs(words, split)
            if not len(first):
                continue
            origin = (words.ends - words.counts)[owner]
            order = np.lexsort((first, tks[owner], ids[owner]))  # earliest first
            place = first - origin
            earliest: dict[bytes, int] = {}
            fresh = np.zeros(len(first), dtype=bool)
            repeated = np.zeros(len(first), dtype=bool)
            for r in order.tolist():
                s = words.packed(first[r], last[r] + WINDOW)
                e = earliest.setdefault(s, r)
                if e == r:
                    fresh[r] = True
                elif place[e] != place[r] or tks[owner[e]] != tks[owner[r]] or ids[owner[e]] != ids[owner[r]]:
                    repeated[r] = True  # else an exact repeat of the row, the same document
            strings = {r: s for s, r in earliest.items()}
            rows = []
            repeat = np.flatnonzero(repeated)
            if len(repeat):
                o = owner[repeat]
                rows.append((-1, _places(pack, ids[o], tks[o], place[repeat], last[repeat] + WINDOW - origin[repeat]), b""))
            ship = np.flatnonzero(fresh)
            bucket = (key[ship] % np.uint64(buckets)).astype(np.int64)
            ship, bucket = ship[o := np.argsort(bucket, kind="stable")], bucket[o]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(ship)]])
            for a, b in zip(cuts, cuts[1:]):
                some = ship[a:b]
                rows.append((int(bucket[a]), _places(pack, ids[owner[some]], tks[owner[some]], place[some]),
                             pack.compress(b"\n".join([strings[r] for r in some.tolist()]))))
            numbers, places, packed = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(places, pa.binary()), pa.array(packed, pa.binary())],
                                             ["bucket", "places", "packed"])
    return run


def _places(pack: zstandard.ZstdCompressor, ids: np.ndarray, tks: np.ndarray, *words: np.ndarray) -> bytes:
    steps = np.diff(ids, prepend=0)  # wraps around, as cumsum does
    return pack.compress(b"".join([steps.tobytes(), tks.tobytes(), *(w.astype(np.int32).tobytes() for w in words)]))


def _unpacked(data: bytes, words: int) -> list[np.ndarray]:
    n = len(data) // (16 + 4 * words)
    ids, tks = np.cumsum(np.frombuffer(data, np.int64, n)), np.frombuffer(data, np.int64, n, 8 * n)
    return [ids, tks, *(np.frombuffer(data, np.int32, n, 16 * n + 4 * n * k).astype(np.int64) for k in range(words))]


def _window_hashes(raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hash of the WINDOW words from each word on (the last ones: of fewer). begin, length: the words' bytes."""
    at = np.arange(len(raw), dtype=np.int32)
    at -= np.repeat(begin.astype(np.int32), length + 1)[: len(raw)]
    value = np.cumprod(np.full(int(length.max()) + 1, _MIX[0]), dtype=np.uint64)[at]
    del at
    value *= raw + np.uint64(1)
    value[begin[1:] - 1] = 0  # separators
    word = _mixed(np.add.reduceat(value, begin), 1)
    del value
    forth = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(word), _STEP, dtype=np.uint64)]), dtype=np.uint64)
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(word), _BACK, dtype=np.uint64)]), dtype=np.uint64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(word * forth[:-1], dtype=np.uint64)])
    past = np.minimum(np.arange(len(word)) + WINDOW, len(word))
    return _mixed((total[past] - total[:-1]) * back[:-1], 0)


def repeats_in(data: bytes, ids: np.ndarray, tks: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated runs of windows: string, first word and word past the last window, in words of the document.

    data: packed strings, one a line; ids, tks, at: document and first word of each.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    gap = np.flatnonzero((raw == 32) | (raw == 10))
    begin = np.concatenate([[0], gap + 1])
    length = np.append(gap, len(raw)) - begin
    last = np.append(np.flatnonzero(raw[gap] == 10), len(begin) - 1)  # last word of each string
    count = np.diff(np.concatenate([[-1], last]))
    number = np.maximum(count - WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(count)), number)
    nth = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    window = np.repeat(last + 1 - count, number) + nth
    start = np.repeat(at, number) + nth
    key = _window_hashes(raw, begin, length)[window]
    # Sorting brings equal windows together; those without an equal are done.
    order = np.argsort(key)
    equal = np.concatenate([[False], key[order[1:]] == key[order[:-1]], [False]])
    some = np.sort(order[equal[1:] | equal[:-1]])
    some = some[np.lexsort((start[some], tks[owner[some]], ids[owner[some]], key[some]))]
    again = np.zeros(len(window), dtype=bool)
    text = lambda w: data[begin[window[w]] : begin[p := window[w] + WINDOW - 1] + length[p]]
    known: dict[bytes, int] = {}
    current = None
    for w, k in zip(some.tolist(), key[some].tolist()):
        if k != current:
            known, current = {}, k
        first = known.setdefault(text(w), w)
        # The same place twice: the row of the document is repeated.
        again[w] = first != w and (start[first] != start[w] or tks[owner[first]] != tks[owner[w]] or ids[owner[first]] != ids[owner[w]])
    hit = np.flatnonzero(again)
    if not len(hit):
        return hit, hit, hit
    new = np.flatnonzero(np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(owner[hit]) != 0)]))
    end = np.append(new[1:], len(hit)) - 1
    return owner[hit[new]], start[hit[new]], start[hit[end]] + WINDOW


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()

    def out(ids, tks, first, past):
        ids = pa.array(ids, mask=ids == NULL_ID)
        return pa.RecordBatch.from_arrays([ids, pa.array(tks), pa.array(first.astype(np.int32)), pa.array(past.astype(np.int32))],
                                          ["doc_id", "tk", "first", "past"])

    for t, starts_of in whole_groups(batches, ["bucket"], rows=1):
        for a, b in zip(starts_of, starts_of[1:]):
            group = t.slice(a, b - a)
            if group.column("bucket")[0].as_py() < 0:  # found by _dealt
                for places in group.column("places").to_pylist():
                    yield out(*_unpacked(unpack.decompress(places), 2))
                continue
            ids, tks, at = (np.concatenate(x) for x in zip(*(_unpacked(unpack.decompress(p), 1) for p in group.column("places").to_pylist())))
            data = b"\n".join(unpack.decompress(blob) for blob in group.column("packed").to_pylist())
            string, first, past = repeats_in(data, ids, tks, at)
            if len(string):
                yield out(ids[string], tks[string], first, past)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        n_words, n_removed, kept_text, digest = [], [], [], []
        for text, spans in zip(texts, part.column("spans").to_pylist()):
            ws = text.encode().split()
            if spans:
                edge = np.zeros(len(ws) + 1, dtype=np.int32)
                for s in spans:
                    edge[s["first"]] += 1
                    edge[s["past"]] -= 1
                keep = np.cumsum(edge[:-1]) == 0
                left = [w for w, k in zip(ws, keep.tolist()) if k]
            else:
                left = ws
            joined = b" ".join(left)
            n_words.append(len(ws))
            n_removed.append(len(ws) - len(left))
            kept_text.append(joined.decode())
            digest.append(hashlib.sha256(joined).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept_text, pa.string()), pa.array(digest, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(doc_id, tk, first, past): word spans of ``texts`` (doc_id, tk, text) covered by repeated windows."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-3 * total // BUCKET_BYTES))
    sampled = (texts.filter(F.pmod("tk", F.lit(SAMPLE)) == 0).select("doc_id", "tk", "text").mapInArrow(_sampled_minimisers, "key long")
               .groupBy("key").agg(F.count("*").alias("n")))
    sampled = written(sampled, "minimisers")
    runs = sampled.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_SPLIT, runs // (2 * buckets))  # so at most 2 * buckets of them
    split = np.sort(np.array([r[0] for r in sampled.filter(F.col("n") >= least).select("key").collect()], np.int64).view(np.uint64))
    dealt = texts.select("doc_id", "tk", "text").mapInArrow(_dealt(buckets, split), DEALT)
    lot = F.when(F.col("bucket") >= 0, 0).otherwise(F.pmod(F.xxhash64("places"), F.lit(buckets)))  # spans found at once go anywhere
    return dealt.withColumn("lot", lot).repartition("bucket", "lot").sortWithinPartitions("bucket").drop("lot").mapInArrow(_repeats, SPAN)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, kept_sha256) for each row; kept words are joined by one space."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tk"))
    spans = written(repeated_spans(texts).groupBy("doc_id", "tk").agg(F.collect_list(F.struct("first", "past")).alias("spans")), "spans")
    s = spans.select(F.col("doc_id").alias("span_id"), F.col("tk").alias("span_tk"), "spans")
    both = texts.join(s, texts["doc_id"].eqNullSafe(s["span_id"]) & (texts["tk"] == s["span_tk"]), "left")
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return both.select("doc_id", "text", "spans").mapInArrow(
        _kept, f"doc_id {id_type}, n_words long, n_removed long, kept_text string, kept_sha256 string")
