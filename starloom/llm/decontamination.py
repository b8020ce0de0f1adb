"""Benchmark decontamination: MinHash containment search, partitioned by size.

A test item is short and a document may be long, so their Jaccard similarity
says nothing; what counts is the share of the item's five-word shingles that
the document contains. Each shingle gets one 64-bit hash. Items are partitioned
by the power of two their shingle count lies under; each partition has its own
hash threshold, chosen so that its items keep about ``sketch`` minimal hashes.
A document's sketch for a partition is its shingle hashes under the same
threshold. Its length follows the document's, so the share of an item's
sketch found in it estimates the containment without bias, however long the
document is. Pairs whose estimate reaches ``slack`` of the threshold are
candidates; with 16 sketch hashes and slack 0.5 a pair of containment 0.8 is
missed with a chance under 1e-3 for items over 32 shingles, never for shorter
ones, whose sketch is their whole set. Candidates are verified with the
shingles' words.

An item of one to four words has one shingle, all its words. It is contained in a
document in which these words follow one another: documents are also read in
runs of as many words as such items have, for the lengths (four at most) that occur.

Cases: words are lower-cased; a document under five words has one shingle, all
its words, besides those runs. Null and blank texts have
none: they are never found and never searched. Very long texts are read whole. Rows that repeat (doc_id, text)
count as one document; rows that repeat item_id with another text are separate
items. Null ids are kept and compare equal to each other. A containment equal to the threshold
counts. Empty documents or items give no pairs. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import SHINGLE_WORDS, text_key, without, words, written

#: Hash values are compared as fractions of this range.
HASH_RANGE = 1 << 62


def _shingles(w: Column, of) -> Column:
    """of(array of words) for every run of five words; for the whole of a shorter text."""
    n = SHINGLE_WORDS

    def runs(bound: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.size(bound) - (n - 1)), lambda i: of(F.slice(bound, i, n)))
        return F.when(F.size(bound) >= n, many).when(F.size(bound) > 0, F.array(of(bound)))

    return F.transform(F.array(w), runs)[0]  # binds w: the text is split once, not once for each run


def _hash(run: Column) -> Column:
    return F.xxhash64(run)


def _spell(run: Column) -> Column:
    return F.array_join(run, " ")


def hashed(w: Column) -> Column:
    return _shingles(w, _hash)


def spelled(w: Column) -> Column:
    return _shingles(w, _spell)


def _with_short_runs(w: Column, lengths: list[int], shingles, of) -> Column:
    """The shingles, and ``of`` every run of as many words as ``lengths`` say."""
    def runs(bound: Column, n: int) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(bound) - (n - 1)), lambda i: of(F.slice(bound, i, n)))
        return F.when(F.size(bound) >= n, each).otherwise(F.array().cast(f"array<{'bigint' if of is _hash else 'string'}>"))

    if not lengths:
        return shingles(w)
    return F.transform(F.array(w), lambda b: F.when(F.size(b) > 0, F.concat(shingles(b), *[runs(b, n) for n in lengths])))[0]


def _fraction(h: Column) -> Column:
    return h.bitwiseAND(HASH_RANGE - 1) / F.lit(float(HASH_RANGE))


def leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8, sketch: int = 16, slack: float = 0.5,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs (doc_id, tk, item_id, n_shared, n_item, containment) of containment >= threshold.

    ``tk`` identifies the document's text; n_item is the item's distinct shingles.
    """
    base = items.select("item_id", words(F.lower("text")).alias("w"), text_key(F.col("text")).alias("item_tk")).distinct()
    sets = written(base.select("item_id", "item_tk", F.array_distinct(hashed(F.col("w"))).alias("hashes"),
                               F.array_distinct(spelled(F.col("w"))).alias("spelled")).filter("hashes is not null"), "items")
    n_words = F.size("w")
    short = sorted(r[0] for r in base.filter((n_words > 0) & (n_words < SHINGLE_WORDS)).select(n_words).distinct().collect())  # four at most
    # Threshold of the partition with 2^(k-1) < size <= 2^k: sketch / 2^(k-1), at most 1.
    size = F.size("hashes")
    rate = F.least(F.lit(1.0), F.lit(2.0 * sketch) / F.pow(F.lit(2.0), F.ceil(F.log2(size))))
    below = F.filter("hashes", lambda h: _fraction(h) < F.col("rate"))
    sketches = written(
        sets.withColumn("rate", rate).withColumn("low", below)
        .withColumn("rate", F.when(F.size("low") * 2 >= F.least(F.lit(sketch), size), F.col("rate")).otherwise(1.0))
        .withColumn("low", below)
        .select("item_id", "item_tk", F.size("low").alias("n_low"), F.explode("low").alias("h")), "item-sketches")

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    probe = texts.select("doc_id", text_key(F.col("text")).alias("tk"), F.explode(_with_short_runs(words(F.lower("text")), short, hashed, _hash)).alias("h"))
    found = probe.join(sketches, "h").groupBy("doc_id", "tk", "item_id", "item_tk").agg(
        F.count_distinct("h").alias("n"), F.any_value("n_low").alias("n_low"))
    pairs = written(found.filter(F.col("n") >= F.col("n_low") * (threshold * slack)).drop("n", "n_low"), "leak-candidates")

    # Only candidate documents are read as words again.
    keyed = texts.withColumn("tk", text_key(F.col("text")))
    wanted = pairs.select(F.col("doc_id").alias("want_id"), F.col("tk").alias("want_tk")).distinct()
    picked = keyed.join(wanted, keyed["doc_id"].eqNullSafe(wanted["want_id"]) & (keyed["tk"] == wanted["want_tk"]), "left_semi")
    runs = picked.dropDuplicates(["doc_id", "tk"]).select(
        F.col("doc_id").alias("run_id"), F.col("tk").alias("run_tk"),
        F.explode(F.array_distinct(_with_short_runs(words(F.lower("text")), short, spelled, _spell))).alias("shingle"))
    item_runs = sets.select("item_id", "item_tk", F.size("hashes").alias("n_item"), F.explode("spelled").alias("shingle"))
    wanted_runs = pairs.alias("p").join(
        item_runs.alias("i"), F.col("p.item_id").eqNullSafe(F.col("i.item_id")) & (F.col("p.item_tk") == F.col("i.item_tk"))
    ).select("p.doc_id", "p.tk", "p.item_id", "p.item_tk", "n_item", "shingle")
    shared = wanted_runs.join(
        runs, wanted_runs["doc_id"].eqNullSafe(runs["run_id"]) & (wanted_runs["tk"] == runs["run_tk"])
        & (wanted_runs["shingle"] == runs["shingle"]))
    return (
        shared.groupBy("doc_id", "tk", "item_id", "item_tk").agg(F.count("*").alias("n_shared"), F.any_value("n_item").alias("n_item"))
        .withColumn("containment", F.col("n_shared") / F.col("n_item")).filter(F.col("containment") >= threshold).drop("item_tk"))


def clean(docs: DataFrame, items: DataFrame, threshold: float = 0.8, least_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` without the rows that contain a test item of at least ``least_words`` words.

    A shorter item is a common word or phrase; with 1 every document that has it goes.
    """
    telling = items.filter(F.size(words(F.lower("text"))) >= least_words)
    return without(docs, leaks(docs, telling, threshold))
