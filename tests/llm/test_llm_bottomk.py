import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import confused, empty, odd, plain, words
from pyspark.sql import functions as F

from rebasket.llm import bottomk
from rebasket.llm.bottomk import K, containment, distinct_count, edited, merged, pack, resemblance, sketches, unpack


def sketch(*texts):
    return sketches(pa.array([t.encode() for t in texts], pa.large_binary()))


def shingles(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_estimates_are_near_the_truth():
    draw = random.Random(3)
    for n, change in ((60, 5), (2000, 60), (20_000, 900)):
        own = words(n, n, 10_000).split()
        other = list(own)
        for i in draw.sample(range(n), change):
            other[i] = f"x{i}"
        a, b = " ".join(own), " ".join(other[: n * 2 // 3])
        x, y = shingles(a), shingles(b)
        s, t = sketch(a, b)
        assert resemblance(s, t) == pytest.approx(len(x & y) / len(x | y), abs=0.15)
        assert containment(t, s) == pytest.approx(len(x & y) / len(y), abs=0.2)
        assert distinct_count(s) == pytest.approx(len(x), rel=0.3) and len(s) == min(K, len(x))
        whole = sketch(a + " | " + b)[0]
        assert np.isin(merged(s, t), whole).mean() > 0.9  # the join adds four shingles of its own


def test_packing_and_edges():
    empty_, short, same = sketch("", "one two", "one  two\n")
    assert len(empty_) == 0 and len(short) == 1 and pack(short) == pack(same) and len(pack(short)) == 8
    assert np.array_equal(unpack(pack(short)), short) and len(unpack("")) == 0
    assert resemblance(empty_, empty_) == 1 and resemblance(empty_, short) == 0 and containment(empty_, short) == 1


def in_python(rows):
    least = -(1 << 63)
    rows = sorted(((r.doc_id, r.text or "") for r in rows), key=lambda r: (-(least if r[0] is None else r[0]), r[1].encode()))
    out = []
    for (doc, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        changed = edited(text, following)
        s, t, u = sketch(text, changed, following)
        out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), pack(s), pack(t), resemblance(s, t), resemblance(s, u)))
    return sorted(out, key=repr)


CONTRACT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_next_document_across_partitions(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
        assert plain(bottomk.fingerprints(docs).select(CONTRACT)) == in_python(docs.collect())
        assert plain(bottomk.fingerprints(odd(spark)).select(CONTRACT)) == in_python(odd(spark).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_one_row_and_no_row(spark):
    one = spark.createDataFrame([(4, "a b c d e f")], "doc_id long, text string")
    assert plain(bottomk.fingerprints(one).select(CONTRACT)) == in_python(one.collect())
    assert plain(bottomk.fingerprints(empty(spark))) == []


def test_sketches_of_parts_merge(spark):
    parts = spark.createDataFrame([("k" if i % 3 else None, words(i, 60)) for i in range(60)], "kind string, text string")
    found = {r.kind: r.sketch for r in bottomk.merge_sketches(bottomk.sketch_texts(parts), "kind", salts=4).collect()}
    for kind in ("k", None):
        total = np.zeros(0, np.uint64)
        for s in sketch(*(words(i, 60) for i in range(60) if ("k" if i % 3 else None) == kind)):
            total = merged(total, s)
        assert found[kind] == pack(total)
    assert plain(bottomk.merge_sketches(bottomk.sketch_texts(parts.filter(F.lit(False))), "kind")) == []


def test_words_that_a_polynomial_hash_confuses_have_other_fingerprints():
    a, b = confused()
    for x, y in ((a, b), (f"p q {a} r s", f"p q {b} r s")):
        one, other = sketch(x, y)
        assert pack(one) != pack(other) and resemblance(one, other) == 0
