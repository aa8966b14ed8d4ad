"""Small tables with the awkward rows every operator must take."""
import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    *[T.StructField(n, T.StringType()) for n in ("id", "ids", "comp", "key", "sig", "_lang", "_quality", "digest", "n", "score", "record")],
])


def docs_frame(spark, rows):
    """rows of (doc_id, text, lang)."""
    return spark.createDataFrame(
        [(d, t, x, "s", None if t is None else len(t), *["x"] * 11) for d, t, x in rows], DOCS)


def prose(seed, n, words="the of and that river stone cloud winter garden letter bridge market silver morning table quiet road".split()):
    r = random.Random(seed)
    return " ".join(r.choice(words) + str(r.randint(0, 400)) for _ in range(n))


LONG = " ".join(f"w{i % 977}x{i // 7}" for i in range(60_000))
EDGE = [
    (1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, "12 34 !!", "en"), (5, LONG, "en"), (6, prose(1, 80), "en"),
    (6, prose(1, 80), "en"), (7, prose(1, 80), "fr"), (None, prose(2, 60), "en"), (None, None, None), (8, "é中文😀\x00 \x85", "fr"),
    (9, "one two three", "en"), (10, "One  two\nthree", "en"), (11, "ʰ" * 300 + " " + "  a   b\n\n c", None),
]
