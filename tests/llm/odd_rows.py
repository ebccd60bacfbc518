"""Small tables with nulls, empty, long and repeated texts, and columns with clashing names."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside
CLASHING = ["key", "n", "size", "a", "b", "digest", "signature", "band", "shard", "plane", "ids", "n_ids", "copies", "mix_id",
            "dropped_id", "quality_score", "chunk", "rid", "sha", "words", "target", "score", "spans", "ghost", "to"]


def words(seed, n, vocabulary=2000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


LONG = words(1, 30_000, 50_000)
PLAIN = words(2, 80)
TEXTS = [
    (1, None), (2, ""), (3, " \n\t\x0b "), (4, "one two"), (5, LONG), (6, PLAIN), (6, PLAIN), (7, PLAIN),
    (8, PLAIN + " tail"), (None, PLAIN), (None, None), (9, "a " * 400), (10, "línea é 漢字 🙂  x ﬁ▁ <s>\n" * 9),
    (11, "x" * 5000), (12, LONG), (6, "other text of the same id " + words(3, 60)),
]


def confused(n=1024):
    """Two different words of ``n`` letters that have equal polynomial hashes modulo 2**64, whatever the base."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)


def odd(spark):
    rows = [(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return frame.withColumns({c: F.lit(-1) for c in CLASHING})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def plain(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
