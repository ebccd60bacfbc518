import hashlib
import random
from collections import Counter

import pytest
from odd_rows import LONG, confused, empty, odd, plain, words

from rebasket.llm import substring
from rebasket.llm.substring import WINDOW


def by_hand(rows):
    counts = Counter()
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for _, w in split:
        counts.update(tuple(w[i:i + WINDOW]) for i in range(len(w) - WINDOW + 1))
    out = []
    for i, w in split:
        gone = set()
        for s in range(len(w) - WINDOW + 1):
            if counts[tuple(w[s:s + WINDOW])] > 1:
                gone.update(range(s, s + WINDOW))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert plain(substring.remove_repeats(frame).select("doc_id", "n_words", "n_removed", "kept_sha256")) == by_hand(rows)


def test_passages_of_every_length_at_every_place(spark):
    draw = random.Random(8)
    passages = [words(100 + k, n) for k, n in enumerate((33, 34, 35, 36, 37, 50, 52, 70, 120, 300))]
    rows = []
    for i in range(60):
        parts = [words(1000 + i, draw.randint(0, 60))]
        for _ in range(draw.randint(0, 3)):
            w = draw.choice(passages).split()
            cut = draw.randint(0, 20)
            parts += [" ".join(w[cut:len(w) - draw.randint(0, 20)]), words(draw.randrange(10_000), draw.randint(0, 40))]
        rows.append((i, "  \n".join(parts)))
    check(spark, rows)


def test_repeats_within_a_text_and_branching_passages(spark):
    a, b, c = words(1, 45), words(2, 45), words(3, 45)
    rows = [(1, f"{a} {b}"), (2, f"{a} {c}"), (3, f"{c} {b} {a}"), (4, f"{b} {a} {b} {c}"), (5, "z " * 200), (6, "z " * 36), (7, "y " * 35),
            (8, "p q " * 100), (9, f"{a} {a} {a}"), (10, words(7, 34)), (11, words(7, 34))]
    check(spark, rows)


def test_copies_stand_for_each_other(spark):
    own = words(5, 90)
    rows = [(1, own), (2, own.replace(" ", "\n")), (3, own), (3, own), (None, own), (4, "lead " + own), (5, " ".join(own.split()[20:60]) + " tail")]
    check(spark, rows)


def test_odd_rows_and_empty_tables(spark):
    rows = [(r.doc_id, r.text) for r in odd(spark).collect()] + [(77, LONG[:3000] + " end")]
    check(spark, rows)
    found = substring.remove_repeats(odd(spark))
    assert plain(found) == by_hand([(r.doc_id, r.text) for r in odd(spark).collect()])
    assert plain(substring.remove_repeats(empty(spark))) == []


@pytest.mark.parametrize("path", ["/root/testdata/sf0.001"])
def test_given_documents(spark, path):
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert plain(substring.remove_repeats(docs)) == by_hand([(r.doc_id, r.text) for r in docs.collect()])


def test_words_that_a_polynomial_hash_confuses_are_no_repeat(spark):
    a, b = confused()
    head, tail = words(31, 20), words(32, 14)
    check(spark, [(1, f"{head} {a} {tail}"), (2, f"{head} {b} {tail}"), (3, f"{a} {b}"), (4, f"{head} {b} {tail} end")])
