"""Small documents with the awkward cases, and Python readings of the contracts."""
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use for their own columns.
    T.StructField("score", T.StringType()), T.StructField("tk", T.IntegerType()), T.StructField("_tk", T.StringType()),
    T.StructField("rate", T.StringType()), T.StructField("copies", T.StringType()), T.StructField("n_tokens", T.StringType()),
    T.StructField("shard", T.StringType()), T.StructField("w", T.StringType()), T.StructField("posteriors", T.StringType()),
])
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
BASE = " ".join(f"alpha{i}" for i in range(60))


def case_rows():
    near = BASE.replace("alpha59", "omega")
    texts = [
        (1, BASE), (2, BASE), (3, near), (3, near), (4, None), (5, ""), (6, " \n\t "), (None, BASE + " tail"), (7, LONG),
        (8, "short text"), (8, "another text of that id"), (9, "é" * 50 + " ünïcode space line"), (10, "a b c d e f"),
        (None, None), (11, "line one\nline one\n\nline two"), (12, LONG + " end"), (13, "Short Text"),
    ]
    return [(i, t, "en", "src", len(t or ""), "s", 1, "x", "r", "c", "n", "h", "w", "p") for i, t in texts]


def cases(spark):
    return spark.createDataFrame(case_rows(), DOCS)


def none(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int, extra string")


def items(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id long, text string, tk string")


def word_list(text):
    return (text or "").encode().split()


def shingles(text):
    w = (text or "").lower().encode().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
