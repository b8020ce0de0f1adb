"""Near-duplicate components by fast similarity sketching.

Texts are sets of word shingles (A-Z lower-cased, words between ASCII white
space; a text of fewer words than a shingle has one, all its words). Texts of
Jaccard similarity at least ``percent`` / 100 are linked; the operator returns
the components of these links.

1. Sketch. T bins are filled in rounds. In round i < T every element is hashed to
   one bin with a value; in round T + b all elements go to bin b. A bin keeps the
   least value of the first round that reached it, and a text stops once all its
   bins are full. So every coordinate is filled after 2 T rounds at most, a
   text of n shingles costs about n + T log T steps (classic MinHash: n T), a
   coordinate of two sketches agrees with the chance of their similarity, and the
   agreeing share is concentrated like T independent samples, also for small sets.
2. Texts of equal sets become one class. Bands of ROWS coordinates give buckets (a pair of
   similarity 0.8 shares none with a chance of 3e-6; README has the measured recall).
3. Pivots. In each bucket every class is compared with one member, that of the least
   hash, by full sets. That is linear in the bucket, and connects a group of near copies.
4. Rest. Pairs of a bucket that are not yet in one component are dealt out in blocks, two
   blocks a task, but never two blocks of the bucket's main component. Sketches drop what
   cannot be linked (chance under 1e-9 at the threshold), full sets decide the others, and
   pairs that the task has already connected are skipped. A task returns a spanning forest.
5. Connected components, each round written (graph.py).

No task gets a whole bucket, no pair of a large bucket is a row, and rows of hot keys
are spread. Block and batch memory is bounded by bytes; one text's set must fit a task.

Cases: a null, empty or blank text has an empty set and is linked with nothing, not even with
another empty one; it is its own component. Very long texts are read whole. Equal texts, repeated rows
and repeated ids are rows like others: copies are one component, and every row with the component's id
has kept = true. component_id is the least id in the component, null if all are; a row without an id
is kept only then. An empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.arrow import Words, text_slices, whole_groups
from starloom.llm.common import text_key, written
from starloom.llm.graph import components, spread_join
from starloom.llm.ngram_join import _shared_counts as shared_counts

BANDS, ROWS = 24, 4
T = BANDS * ROWS
#: Classes of a block, and bytes of their sets.
BLOCK, BLOCK_BYTES = 512, 8 << 20
#: Pairs compared at once.
PAIRS = 20_000
TASK_KEYS = ["band", "key", "bi", "bj"]

_SEEDS = np.random.default_rng(12).integers(1, 1 << 63, 2 * T, dtype=np.uint64)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_HALF = np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


def shingles(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of all texts, repeats included, and their number in each text."""
    words = Words([t.encode().lower() for t in texts])  # bytes.lower: A-Z only
    h, counts = words.hashes(), words.counts
    number = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    starts = np.repeat(words.ends - counts - (np.cumsum(number) - number), number) + np.arange(number.sum())
    length = np.repeat(np.minimum(counts, n), number)
    out = length.astype(np.uint64)
    for k in range(n):
        has = length > k
        out = np.where(has, _mix(out ^ h[np.where(has, starts + k, 0)]), out) if len(h) else out
    return out, number


def sketches(hashes: np.ndarray, number: np.ndarray, t: int = T) -> np.ndarray:
    """The sketch (t values of 64 bits: round, then value) of each of the sets that lie one after the other in ``hashes``; all full but for empty sets."""
    empty = np.uint64(np.iinfo(np.uint64).max)
    bins = np.full(len(number) * t, empty, np.uint64)
    owner, own = np.repeat(np.arange(len(number)), number), hashes
    for i in range(2 * t):
        if not len(own):
            break
        h = _mix(own ^ _SEEDS[i])
        to = ((h >> _HALF) * np.uint64(t) >> _HALF).astype(np.int64) if i < t else np.int64(i - t)
        to = owner * t + to
        value = (np.uint64(i) << _HALF) | (h & np.uint64(0xFFFFFFFF))
        free = bins[to] == empty
        held = np.full(len(bins), empty, np.uint64) if len(own) > len(bins) // 8 else None
        if held is not None:
            np.minimum.at(held, to[free], value[free])
            bins = np.minimum(bins, held)
        else:
            np.minimum.at(bins, to[free], value[free])
        lacking = (bins.reshape(-1, t) == empty).any(axis=1)
        if not lacking[owner].all():
            stay = lacking[owner]
            owner, own = owner[stay], own[stay]
    return bins.reshape(-1, t)


def _sketch(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            hashes, number = shingles(texts, shingle_words)
            # 32 bits of (round, value) tell coordinates apart with a chance of 2^-32 of a false match; sets are compared in full.
            sig = (_mix(sketches(hashes, number)) >> _HALF).astype(np.uint32)
            ends = np.cumsum(number)
            sets = [np.unique(hashes[e - n : e]) for e, n in zip(ends.tolist(), number.tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("tk"),
                 pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([row.tobytes() if len(s) else None for row, s in zip(sig, sets)], pa.binary())],
                ["doc_id", "tk", "sk", "n_shingles", "sig"])
    return run


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, T)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = _signatures(batch.column("sig")).astype(np.uint64)
        for b in range(BANDS):
            key = np.full(len(sig), b + 1, dtype=np.uint64)
            for k in range(b * ROWS, (b + 1) * ROWS):
                key = _mix(key ^ sig[:, k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sig), b, np.int32)), pa.array(key.view(np.int64)), batch.column("cid"), batch.column("n")],
                ["band", "key", "cid", "n"])


def _sets(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            hashes, number = shingles(texts, shingle_words)
            sets = [np.unique(hashes[e - n : e]).tobytes() for e, n in zip(np.cumsum(number).tolist(), number.tolist())]
            yield pa.RecordBatch.from_arrays([part.column("cid"), pa.array(sets, pa.binary())], ["cid", "shingles"])
    return run


def _linked_to_pivot(percent: int):
    """Of rows sorted by pivot and block, the pivot's own first: (cid, pivot) where the full sets are linked. Rows stream; one pivot's set is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.zeros(0, np.uint64)
        for batch in batches:
            cid, pivot, raw = (batch.column(c) for c in ("cid", "pivot", "shingles"))
            own = cid.to_numpy() == pivot.to_numpy()
            cuts = [0, *np.flatnonzero(own).tolist(), batch.num_rows]
            linked = np.zeros(batch.num_rows, bool)
            for a, b in zip(cuts, cuts[1:]):
                if a < b and own[a]:
                    base, a = np.frombuffer(raw[a].as_py(), np.uint64), a + 1
                if a >= b:
                    continue
                sets = [np.frombuffer(x, np.uint64) for x in raw.slice(a, b - a).to_pylist()]
                size = np.array([len(s) for s in sets])
                flat = np.concatenate(sets)
                hit = base[np.minimum(np.searchsorted(base, flat), len(base) - 1)] == flat
                shared = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
                linked[a:b] = 100 * shared >= percent * (size + len(base) - shared)
            keep = np.flatnonzero(linked)
            yield pa.RecordBatch.from_arrays([cid.take(keep), pivot.take(keep)], ["a", "b"])
    return run


def least_matches(percent: int, chance: float = 1e-9) -> int:
    """The fewest agreeing coordinates that a linked pair has, but for that chance."""
    p, below, m = percent / 100, 0.0, 0
    while below + comb(T, m) * p**m * (1 - p) ** (T - m) < chance:
        below += comb(T, m) * p**m * (1 - p) ** (T - m)
        m += 1
    return m


def _open_pairs(t: pa.Table, starts: np.ndarray, percent: int, least: int, top) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of each task whose labels ``top`` tells apart, that can be linked and share no earlier band."""
    sig, band, n = _signatures(t.column("sig")), t.column("band").to_numpy(), t.column("n").to_numpy()
    side, crossing = t.column("side").to_numpy(), t.column("bi").to_numpy() != t.column("bj").to_numpy()
    for a, b in zip(starts[:-1], starts[1:]):
        rows = np.arange(a, b)
        left, right = (rows[side[rows] == 0], rows[side[rows] == 1]) if crossing[a] else (rows, rows)
        step = max(1, PAIRS // max(1, len(right)))
        for k in range(0, len(left), step):
            i, j = (x.ravel() for x in np.meshgrid(left[k : k + step], right, indexing="ij"))
            group = top()
            keep = (group[i] != group[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            keep &= (i < j) | crossing[a]
            i, j = i[keep], j[keep]
            same = sig[i] == sig[j]
            keep = (same.sum(axis=1) >= least) & (same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band[i])
            if keep.any():
                yield i[keep], j[keep]


def _involved(percent: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, TASK_KEYS):
            used, label = np.zeros(t.num_rows, dtype=bool), t.column("label").to_numpy()
            for i, j in _open_pairs(t, starts, percent, least, lambda: label):
                used[i] = used[j] = True
            yield from t.filter(pa.array(used)).to_batches()
    return run


def _verified(percent: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, TASK_KEYS, size=4 * BLOCK_BYTES):
            sets = [np.frombuffer(x, dtype=np.uint64) for x in t.column("shingles").to_pylist()]
            size, label = np.array([len(s) for s in sets]), t.column("label").to_numpy().copy()
            for i, j in _open_pairs(t, starts, percent, least, lambda: label):
                shared = shared_counts(sets, i, j)
                linked = 100 * shared >= percent * (size[i] + size[j] - shared)
                edges = []
                for x, y in zip(i[linked].tolist(), j[linked].tolist()):
                    p, q = label[x], label[y]
                    if p != q:
                        edges.append((min(p, q), max(p, q)))
                        label[label == max(p, q)] = min(p, q)
                if edges:
                    yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in zip(*edges)], ["a", "b"])
    return run


def _class_sets(texts: DataFrame, classes: DataFrame, cids: DataFrame, shingle_words: int) -> DataFrame:
    """(cid, shingles) of the wanted classes, from the text of the row that stands for each."""
    wanted = cids.distinct().join(classes.select("cid", "least"), "cid").select(
        "cid", F.col("least.doc_id").alias("rep"), F.col("least.tk").alias("rtk"))
    source = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["rep"]) & (texts["tk"] == wanted["rtk"]))
    sets = source.select("cid", "text").mapInArrow(_sets(shingle_words), "cid long, shingles binary")
    return sets.groupBy("cid").agg(F.any_value("shingles").alias("shingles"))


def _by_pivot(keys: DataFrame, texts: DataFrame, classes: DataFrame, percent: int, shingle_words: int) -> DataFrame:
    """(a, b): classes linked to the pivot of one of their buckets."""
    buckets = written(keys.groupBy("bucket").agg(F.count("*").alias("rows"), F.min(F.struct(F.xxhash64("cid"), "cid", "n")).alias("p"))
                      .filter("rows > 1").select("bucket", "rows", F.col("p.cid").alias("pivot"), F.col("p.n").alias("pn")), "buckets")
    close = (F.col("cid") != F.col("pivot")) & (100 * F.least("n", "pn") >= percent * F.greatest("n", "pn"))
    pairs = written(spread_join(keys, buckets, "bucket", "rows").filter(close).select("cid", "pivot").distinct(), "pivot-pairs")
    # A pivot's members are dealt to parts by their number; the pivot goes to each part.
    counts = written(pairs.groupBy("pivot").agg(F.count("*").alias("rows")).withColumn(
        "parts", F.ceil(F.col("rows") / BLOCK)), "pivots")
    members = spread_join(pairs, counts, "pivot", "rows").select("cid", "pivot", F.pmod(F.xxhash64("cid"), "parts").alias("part"))
    own = counts.select(F.col("pivot").alias("cid"), "pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    dealt = members.union(own)
    sets = _class_sets(texts, classes, dealt.select("cid"), shingle_words)
    return written(
        dealt.join(sets, "cid").repartition("pivot", "part").sortWithinPartitions("pivot", "part", F.col("cid") != F.col("pivot"))
        .select("cid", "pivot", "shingles").mapInArrow(_linked_to_pivot(percent), "a long, b long"), "pivot-links")


def _by_blocks(keys: DataFrame, labels: DataFrame, texts: DataFrame, classes: DataFrame, percent: int, shingle_words: int) -> DataFrame:
    """(a, b): labels of components that a link between classes of one bucket connects."""
    labelled = keys.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    parts = written(labelled.groupBy("bucket", "label").agg(F.count("*").alias("rows"), F.sum("n").alias("size")), "bucket-labels")
    main = F.max(F.struct("rows", "label", "size"))
    mixed = parts.groupBy("bucket").agg(main.alias("main"), F.count("*").alias("labels"), F.sum("rows").alias("rows"), F.sum("size").alias("size")).filter("labels > 1")
    blocks = lambda rows, size: F.greatest(F.ceil(rows / BLOCK), F.ceil(8 * size / BLOCK_BYTES))
    mixed = written(mixed.select(
        "bucket", "rows", F.col("main.label").alias("main"), blocks(F.col("main.rows"), F.col("main.size")).alias("mains"),
        blocks(F.col("rows") - F.col("main.rows"), F.col("size") - F.col("main.size")).alias("others")), "mixed")
    if mixed.isEmpty():
        return mixed.select(F.col("main").alias("a"), F.col("main").alias("b"))
    inside = F.col("label") == F.col("main")
    hashed = F.xxhash64("cid", F.lit(1))
    # Blocks 0 to others - 1 hold the others, the next ones the main component's classes, which meet the others only.
    own = F.when(inside, F.col("others") + F.pmod(hashed, "mains")).otherwise(F.pmod(hashed, "others"))
    past = F.when(inside, F.col("others")).otherwise(F.col("others") + F.col("mains"))
    members = spread_join(labelled, mixed, "bucket", "rows").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), past - 1)))
    dealt = members.select("band", "key", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"),
                           (F.col("own") > F.col("other")).cast("int").alias("side"), "cid", "label", "n")
    least = least_matches(percent)
    schema = "band int, key long, bi long, bj long, side int, cid long, label long, n long, sig binary"
    involved = written(
        dealt.join(classes.select("cid", "sig"), "cid").select("band", "key", "bi", "bj", "side", "cid", "label", "n", "sig")
        .repartition(*TASK_KEYS).sortWithinPartitions(*TASK_KEYS).mapInArrow(_involved(percent, least), schema), "involved")
    sets = _class_sets(texts, classes, involved.select("cid"), shingle_words)
    return written(
        involved.join(sets, "cid").select(*involved.columns, "shingles")
        .repartition(*TASK_KEYS).sortWithinPartitions(*TASK_KEYS).mapInArrow(_verified(percent, least), "a long, b long"), "block-links")


def near_duplicate_components(docs: DataFrame, percent: int = 80, shingle_words: int = 4,
                              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of ``docs``."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("tk", text_key(F.col("text")))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    sketch = written(texts.mapInArrow(_sketch(shingle_words), f"doc_id {id_type}, tk binary, sk binary, n_shingles long, sig binary"), "sketch")
    least: Column = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tk"))
    classes = written(
        sketch.filter("sk is not null").groupBy("sk").agg(least.alias("least"), F.count("*").alias("copies"),
                                                          F.any_value("n_shingles").alias("n"), F.any_value("sig").alias("sig"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    keys = written(classes.select("cid", "n", "sig").mapInArrow(_bands, "band int, key long, cid long, n long")
                   .withColumn("bucket", F.struct("band", "key")), "bands")

    labels = written(components(_by_pivot(keys, texts, classes, percent, shingle_words)), "labels")
    # Links of components: their labels are the nodes here, and only the table of components is labelled again.
    joined = written(components(_by_blocks(keys, labels, texts, classes, percent, shingle_words)), "joined").select(
        F.col("node").alias("label"), F.col("label").alias("whole"))
    labels = labels.unionByName(joined.select(F.col("label").alias("node"), "label").join(labels, "node", "left_anti"))

    ranked = classes.select("cid", "sk", "copies", "least").join(labels, F.col("cid") == F.col("node"))
    groups = ranked.groupBy("label").agg(F.count("*").alias("rows"), F.min("least").alias("first"))
    groups = written(groups.join(joined, "label", "left").withColumn("whole", F.coalesce("whole", "label")), "components")
    first = groups.groupBy("whole").agg(F.min("first").alias("first"))
    groups = written(groups.drop("first").join(first, "whole"), "component-ids")
    grouped = spread_join(ranked.select("sk", "copies", "label"), groups, "label", "rows").select("sk", "copies", F.col("first.doc_id").alias("component_id"))
    alone = classes.join(labels, F.col("cid") == F.col("node"), "left_anti").select("sk", "copies", F.col("least.doc_id").alias("component_id"))
    result = written(grouped.union(alone), "class-components")
    full = spread_join(sketch.filter("sk is not null").select("doc_id", "sk", "n_shingles"), result, "sk", "copies")
    empty = sketch.filter("sk is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "n_shingles", "component_id").union(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
