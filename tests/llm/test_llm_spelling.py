import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from odd_rows import empty, odd, plain

from rebasket.llm import spelling
from rebasket.llm.spelling import Bloom, hashes, matrix, near_pairs, spelling_groups

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def vocabulary(rows):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def near_by_hand(words):
    """By wildcards: words that agree but for one place, or with one character taken out."""
    near = {w: set() for w in words}
    held = {}
    for w in words:
        for i in range(len(w)):
            held.setdefault((w[:i], w[i + 1:]), set()).add(w)
            shorter = w[:i] + w[i + 1:]
            if shorter in near:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in held.values():
        for w in group:
            near[w] |= group - {w}
    return near


def by_hand(rows):
    counts = vocabulary(rows)
    near = near_by_hand(counts)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out, key=repr)


def made(seed, n=400):
    """Texts of words and their misspellings, of skewed counts."""
    draw = random.Random(seed)
    letters = "abcdeéÀ×ÿñz"
    base = ["".join(draw.choice(letters) for _ in range(draw.randint(6, 12))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "ababababab"]

    def changed(w):
        i, kind = draw.randrange(len(w)), draw.randrange(3)
        return w[:i] + w[i + 1:] if kind == 0 else w[:i] + draw.choice(letters) + w[i + (kind == 1):]

    rows = []
    for doc in range(n):
        some = []
        for _ in range(draw.randint(1, 60)):
            w = base[min(int(draw.expovariate(0.12)), len(base) - 1)]
            for _ in range(draw.choice((0, 0, 0, 0, 0, 0, 0, 1, 1, 2))):
                w = changed(w) if w else w
            some.append(w.upper() if draw.random() < 0.1 else w)
        rows.append((draw.choice((doc, doc, -doc, None)), draw.choice([" ", "-", "1", " ", "œ"]).join(some)))
    return rows


def test_groups_agree_with_brute_force(spark):
    rows = made(1)
    expected = by_hand(rows)
    assert len({r[5] for r in expected}) > 5 and any(r[2] != r[1] and r[1] for r in expected)
    found = spelling_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert plain(found) == expected


def test_given_documents_agree_with_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert plain(spelling_groups(docs)) == by_hand([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("shard_bytes,pass_bytes", [(200, 1), (200, 20_000), (1 << 20, 1 << 20)])
def test_every_pair_is_found_whatever_the_shards_and_passes(spark, shard_bytes, pass_bytes):
    words = sorted(vocabulary(made(2, 60)))
    expected = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    found = [tuple(sorted(r)) for r in near_pairs(frame, shard_bytes, pass_bytes).collect()]
    assert len(found) == len(set(found)) and set(found) == expected and expected


def test_filters_hold_what_was_added_and_little_else():
    draw = np.random.default_rng(3)
    words = draw.integers(0, 1 << 63, 20_000).astype(np.uint64)
    bloom = Bloom(len(words))
    bloom.add(words)
    assert len(bloom.holds(words)) == len(words)
    others = draw.integers(0, 1 << 63, 200_000).astype(np.uint64)
    assert len(bloom.holds(others)) < 0.005 * len(others)
    again = Bloom(len(words), bloom.bits.tobytes())
    assert np.array_equal(again.holds(others), bloom.holds(others))
    assert len(set(hashes(matrix(["abcdefg", "bacdefg", "abcdegf", "gfedcba"])).tolist())) == 4


def test_chains_lead_to_the_root_and_ties_to_the_smallest(spark):
    counts = {"baaaaaa": 2, "bbaaaaa": 20, "bbbaaaa": 200, "bbbbaaa": 2000, "bbaaaab": 20, "ccccccc": 2, "ccccccd": 19, "dddddddd": 3}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    formed = spelling.forms(frame, near_pairs(frame.select("word")))
    assert {r.word: r.form for r in formed.collect()} == {
        "baaaaaa": "bbaaaaa", "bbaaaaa": "bbbaaaa", "bbbaaaa": "bbbbaaa", "bbbbaaa": None, "bbaaaab": None, "ccccccc": None, "ccccccd": None, "dddddddd": None}
    assert {r.word: r.root for r in spelling.roots(formed).collect()} == {w: "bbbbaaa" for w in ("baaaaaa", "bbaaaaa", "bbbaaaa")}
    tied = spark.createDataFrame([("aaaaaaa", 2), ("aaaaaab", 30), ("aaaaaaé", 30), ("aaaaaac", 30)], "word string, n long")
    assert {r.word: r.form for r in spelling.forms(tied, near_pairs(tied.select("word"))).collect()}["aaaaaaa"] == "aaaaaab"


def test_odd_rows_long_words_and_empty_tables(spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in odd(spark).collect()]
    assert plain(spelling_groups(odd(spark))) == by_hand(rows)
    assert plain(spelling_groups(empty(spark))) == []
    monkeypatch.setattr(spelling, "_HELD_WORDS", 2)
    long = "ab" * 3000
    many = [(i, f"{long} {long[:-1]}{'cd'[i % 2]} plainword") for i in range(40)] + [(None, None), (3, "")]
    assert plain(spelling_groups(spark.createDataFrame(many, "doc_id long, text string"))) == by_hand(many)
