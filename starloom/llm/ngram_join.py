"""N-gram Jaccard join with Bayesian pruning of candidate pairs.

Texts are sets of five-word shingles (lower-cased words between ASCII white
space). The join finds every pair of different texts of Jaccard similarity at
least 0.8 and reports, per document, its group (connected by such links or by
equal texts) and its number of links.

1. Equal texts become one class, so copies are never paired with each other.
2. Each class gets 96 MinHash values; 24 bands of 4 make candidate buckets
   (a pair of similarity 0.8 shares none with a chance of 3e-6).
3. A bucket is dealt out in blocks of members, every two blocks to one task,
   so a large bucket is many tasks and its pairs are never rows. A pair counts
   in the first bucket it shares. MinHash values are compared 16 at a time:
   after n of them with m equal, the similarity has a Beta(m+1, n-m+1)
   posterior; the pair is dropped when the posterior chance of reaching the
   threshold is below ``tolerance``.
4. Members of surviving pairs get their shingle sets; the pairs are verified
   exactly in the same blocks. A task returns link counts and a spanning
   forest of its links, never the pairs of a large block.
5. Connected components by large-star and small-star rounds, each written.

Cases: null, empty and blank texts have no shingles and link only to texts equal
to theirs (null counts as empty). A text of one to four words has one shingle,
all its words. Repeated ids and null ids are rows like others; class_id is the
least id of the group, null if all are null; ties of ids go to the least text key. Very long texts are read whole.
A similarity equal to the threshold links. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from starloom.llm.arrow import shingle_hashes, text_slices, whole_groups
from starloom.llm.common import text_key, unused, written

BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
#: MinHash values compared between two looks at the posterior.
STEP = 16
#: Members of a block; a task compares two blocks.
BLOCK = 512
#: Pairs compared at once.
PAIRS = 20_000
#: Bytes of sets held beyond one group.
HELD_BYTES = 32 << 20
TASK_KEYS = ["band", "key", "bi", "bj"]

_rng = np.random.default_rng(20)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def needed_matches(threshold: float, tolerance: float) -> list[int]:
    """At STEP, 2 * STEP, ... compared values: the fewest equal ones with P(similarity >= threshold) >= tolerance.

    P(Beta(m+1, n-m+1) >= t) = P(Binomial(n+1, t) <= m).
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        hashes, number = shingle_hashes(texts)
        sig = np.zeros((len(texts), HASHES), dtype=np.uint32)
        some = np.flatnonzero(number)
        starts = (np.cumsum(number) - number)[some]
        for k in range(HASHES if len(some) else 0):
            sig[some, k] = np.minimum.reduceat((hashes * _A[k] + _B[k]) >> np.uint64(32), starts)
        values = pa.array([row.tobytes() if n else None for row, n in zip(sig, number)], pa.binary())
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tk"), values], ["doc_id", "tk", "sig"])


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, HASHES)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, cid = _signatures(batch.column("sig")).astype(np.uint64), batch.column("cid").to_numpy()
        for b in range(BANDS):
            key = np.full(len(cid), b + 1, dtype=np.uint64)
            for k in range(b * ROWS, (b + 1) * ROWS):
                key = (key ^ sig[:, k]) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(31)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cid), b, np.int32)), pa.array(key.view(np.int64)), pa.array(cid)], ["band", "key", "cid"])


def _pair_chunks(starts: np.ndarray, sides: np.ndarray, crossing: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each group: all of them, or for a crossing group those of one side with the other."""
    sizes = np.diff(starts)
    held_i, held_j, n = [], [], 0
    small = (sizes <= 64) & ~crossing
    for size in np.unique(sizes[small & (sizes > 1)]):
        a, b = np.triu_indices(size, 1)
        first = starts[:-1][small & (sizes == size)]
        per = max(1, PAIRS // len(a))
        for k in range(0, len(first), per):
            yield (first[k : k + per, None] + a).ravel(), (first[k : k + per, None] + b).ravel()
    for g in np.flatnonzero(~small):
        rows = np.arange(starts[g], starts[g + 1])
        left, right = (rows[sides[rows] == 0], rows[sides[rows] == 1]) if crossing[g] else (rows, rows)
        per = max(1, PAIRS // max(1, len(right)))
        for k in range(0, len(left), per):
            i, j = (x.ravel() for x in np.meshgrid(left[k : k + per], right, indexing="ij"))
            if not crossing[g]:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j


def _survivors(t: pa.Table, starts: np.ndarray, needed: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that keep a chance to reach the threshold and share no earlier band, in chunks that keep groups in order."""
    sig, band, cid = _signatures(t.column("sig")), t.column("band").to_numpy(), t.column("cid").to_numpy()
    crossing = (t.column("bi").to_numpy() != t.column("bj").to_numpy())[starts[:-1]]
    for i, j in _pair_chunks(starts, t.column("side").to_numpy(), crossing):
        keep = cid[i] != cid[j]
        i, j = i[keep], j[keep]
        same = np.zeros(len(i), dtype=np.int64)
        for s, least in enumerate(needed):
            cols = slice(s * STEP, (s + 1) * STEP)
            same += (sig[i, cols] == sig[j, cols]).sum(axis=1)
            keep = same >= least
            i, j, same = i[keep], j[keep], same[keep]
        first = (sig[i] == sig[j]).reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band[i]
        if first.any():
            yield i[first], j[first]


def _involved(needed: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, TASK_KEYS):
            used = np.zeros(t.num_rows, dtype=bool)
            for i, j in _survivors(t, starts, needed):
                used[i] = used[j] = True
            yield from t.filter(pa.array(used)).to_batches()
    return run


def _shared_counts(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets i and j."""
    rows, inverse = np.unique(np.concatenate([i, j]), return_inverse=True)
    if len(i) > 4 * len(rows):  # many pairs of few sets: an incidence matrix of a bounded number of sets
        words, codes = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True)
        owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
        common = np.zeros((len(rows), len(rows)), dtype=np.float32)
        wide = max(1, (16 << 20) // (4 * len(rows)))  # shingles a slab: 16 MB
        order = np.argsort(codes, kind="stable")
        bounds = np.searchsorted(codes[order], np.arange(0, len(words) + wide, wide))
        for s, (a, b) in enumerate(zip(bounds, bounds[1:])):
            at = order[a:b]
            slab = np.zeros((len(rows), wide), dtype=np.float32)
            slab[owner[at], codes[at] - s * wide] = 1
            common += slab @ slab.T
        return common[inverse[: len(i)], inverse[len(i) :]].astype(np.int64)
    return np.fromiter((len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)), np.int64, len(i))


def _verified(needed: list[int], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, TASK_KEYS, rows=4_000, size=HELD_BYTES):
            raw = t.column("shingles").to_pylist()
            sets = [np.frombuffer(x, dtype=np.uint64) for x in raw]
            size = np.array([len(s) for s in sets])
            cid, copies = t.column("cid").to_numpy(), t.column("copies").to_numpy()
            links = np.zeros(t.num_rows, dtype=np.int64)
            root = np.arange(t.num_rows)

            def top(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            a_side, b_side = [], []
            for i, j in _survivors(t, starts, needed):
                shared = _shared_counts(sets, i, j)
                linked = shared >= threshold * (size[i] + size[j] - shared) - 1e-9
                i, j = i[linked], j[linked]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                for x, y in zip(i.tolist(), j.tolist()):
                    p, q = top(x), top(y)
                    if p != q:
                        root[q] = p
                        a_side.append(cid[x])
                        b_side.append(cid[y])
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([cid[some], np.array(a_side, np.int64)])),
                 pa.array([None] * len(some) + b_side, pa.int64()),
                 pa.array(np.concatenate([links[some], np.zeros(len(a_side), np.int64)]))], ["a", "b", "n"])
    return run


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        hashes, number = shingle_hashes(texts)
        ends = np.cumsum(number)
        sets = [np.unique(hashes[e - n : e]).tobytes() for e, n in zip(ends, number)]
        yield pa.RecordBatch.from_arrays([part.column("cid"), part.column("copies"), pa.array(sets, pa.binary())],
                                         ["cid", "copies", "shingles"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of the edges; label is the least node of its component.

    Alternates large-star and small-star rounds (linking larger neighbours, then smaller ones, to the least
    neighbour) until the edges stop changing. A star's edges are spread over tasks by partial aggregation.
    """
    current = written(edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).filter("lo < hi").distinct(), "edges")
    while True:
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(current.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).filter("lo < hi").distinct()
        large = written(large, "large-star")
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.explode(F.array(
            F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        after = written(small.select("e.hi", "e.lo").filter("lo < hi").distinct(), "small-star")
        same = current.join(after, ["lo", "hi"], "left_semi").count()
        if same == current.count() == after.count():
            break
        current = after
    return after.groupBy("hi").agg(F.min("lo").alias("label")).select(F.col("hi").alias("node"), "label").union(
        after.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct())


def near_duplicates(docs: DataFrame, threshold: float = 0.8, tolerance: float = 1e-6,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tk, class_id, class_tk, n_links), a row for each row of ``docs``.

    class_id and class_tk are the least (id, text key) of the group; n_links counts the other rows
    that have an equal text or one of similarity >= threshold.
    """
    needed = needed_matches(threshold, tolerance)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("tk", text_key(F.col("text")))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    sketch = written(texts.mapInArrow(_sketch, f"doc_id {id_type}, tk binary, sig binary"), "sketch")
    classes = written(
        sketch.groupBy("tk").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.any_value("sig").alias("sig"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")

    signed = classes.filter("sig is not null").select("cid", "sig")
    keys = signed.mapInArrow(_bands, "band int, key long, cid long")
    shared = keys.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK)
    members = (
        keys.join(shared, ["band", "key"])
        .withColumn("own", F.pmod(F.xxhash64("cid"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .select("band", "key", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"),
                (F.col("own") > F.col("other")).cast("int").alias("side"), "cid"))
    schema = "band int, key long, bi long, bj long, side int, cid long, sig binary"
    dealt = members.join(signed, "cid").select("band", "key", "bi", "bj", "side", "cid", "sig")
    involved = written(
        dealt.repartition(*TASK_KEYS).sortWithinPartitions(*TASK_KEYS).mapInArrow(_involved(needed), schema), "involved")

    wanted = involved.select("cid").distinct().join(classes.select("cid", "rep", "copies", F.col("tk").alias("ctk")), "cid")
    source = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["rep"]) & (texts["tk"] == wanted["ctk"]))
    sets = source.select("cid", "copies", "text").mapInArrow(_shingle_sets, "cid long, copies long, shingles binary")
    once = sets.groupBy("cid").agg(F.any_value("copies").alias("copies"), F.any_value("shingles").alias("shingles"))
    verified = written(
        involved.join(once, "cid").select(*involved.columns, "copies", "shingles")
        .repartition(*TASK_KEYS).sortWithinPartitions(*TASK_KEYS)
        .mapInArrow(_verified(needed, threshold), "a long, b long, n long"), "verified")

    links = verified.filter("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    label = components(verified.filter("b is not null"))
    grouped = (
        classes.select("cid", "tk", "rep", "copies")
        .join(links, classes["cid"] == links["a"], "left").join(label, F.col("cid") == F.col("node"), "left")
        .select("cid", "tk", "rep", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("label", "cid").alias("label")))
    # Nulls last, so that a group has an id if any of its rows has one.
    least = grouped.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "tk")).alias("least"))
    result = written(grouped.join(least, "label").select(
        "tk", "n_links", F.col("least.rep").alias("class_id"), F.col("least.tk").alias("class_tk")), "groups")
    return sketch.select("doc_id", "tk").join(result, "tk").select("doc_id", "tk", "class_id", "class_tk", "n_links")


def one_of_each(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that of the least (id, text key), any one of its exact repeats."""
    tk, rid, rtk, nth = unused(docs.columns, "_tk", "_rid", "_rtk", "_nth")
    kept = near_duplicates(docs, threshold, id_col=id_col, text_col=text_col).select(
        F.col("class_id").alias(rid), F.col("class_tk").alias(rtk)).distinct()
    keyed = docs.withColumn(tk, text_key(F.col(text_col)))
    same = keyed.join(kept, keyed[id_col].eqNullSafe(kept[rid]) & (keyed[tk] == kept[rtk]), "left_semi")
    first = Window.partitionBy(id_col, tk).orderBy(tk)
    return same.withColumn(nth, F.row_number().over(first)).filter(F.col(nth) == 1).drop(tk, nth)
