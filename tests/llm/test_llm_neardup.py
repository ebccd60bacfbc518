import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import confused, empty, odd, plain, words

from rebasket.llm import neardup
from rebasket.llm.components import components
from rebasket.llm.neardup import Bands, band_keys, block_links, linked, residual_links, signatures


def sets_of(texts, width):
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    out = []
    for text in texts:
        w = [x for x in (text or "").translate(upper).translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if x]
        out.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    return out


def by_hand(rows, width, percent):
    ids = [r[0] for r in rows]
    sets = sets_of([r[1] for r in rows], width)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in range(len(rows)):
        for y in range(x):
            common = len(sets[x] & sets[y])
            if common and None not in (ids[x], ids[y]) and 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                a, b = root(ids[x]), root(ids[y])
                parent[max(a, b)] = min(a, b)
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in zip(ids, sets)), key=repr)


def variants(seed, copies, changes, n=120):
    """A text and copies of it with up to ``changes`` words replaced."""
    draw = random.Random(seed)
    own = words(seed, n).split()
    out = []
    for c in range(copies):
        text = list(own)
        for i in draw.sample(range(n), draw.randint(0, changes)):
            text[i] = f"v{draw.randrange(40)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_components_agree_with_brute_force(spark, width, percent):
    texts = [*variants(1, 150, 6), *variants(2, 60, 3), *[words(i, 90) for i in range(10, 40)], *variants(3, 3, 0)]
    random.Random(9).shuffle(texts)
    rows = [(5 * i + 1, t) for i, t in enumerate(texts)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width, percent)
    assert plain(found.select("doc_id", "n_shingles", "component_id", "kept")) == by_hand(rows, width, percent)


def test_odd_rows_and_empty_tables(spark):
    rows = [(r.doc_id, r.text) for r in odd(spark).collect()]
    found = neardup.near_duplicates(odd(spark))
    assert plain(found.select("doc_id", "n_shingles", "component_id", "kept")) == by_hand(rows, 3, 85)
    assert plain(neardup.near_duplicates(empty(spark))) == []
    kept = neardup.deduplicated(odd(spark))
    assert kept.columns == odd(spark).columns
    assert plain(neardup.deduplicated(empty(spark))) == []


def test_components_of_paths_and_stars(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 80)] + [(7, 7), (900, 901), (901, 900)]
    edges += [(draw.randrange(1000, 1100), draw.randrange(1000, 1100)) for _ in range(70)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: root(i) for i in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_no_residual_link_is_lost_across_blocks(spark, monkeypatch):
    bands = Bands(85)
    draw = np.random.default_rng(4)
    own = [np.unique(draw.integers(0, 60, 45).astype(np.uint64)) for _ in range(150)]
    signed = signatures(own, bands.hashes)
    part = draw.integers(0, 9, 150)
    frame = spark.createDataFrame(
        [(i, 1, int(p) * 1000, bytearray(s.tobytes()), bytearray(o.tobytes())) for i, (p, s, o) in enumerate(zip(part, signed, own))],
        "doc_id long, gathered long, component long, signature binary, shingles binary")
    expected = defaultdict(bool)
    for i in range(150):
        for j in range(i):
            if part[i] != part[j] and (signed[i] == signed[j]).sum() >= bands.least_agreement and linked(own[i], own[j], 85):
                expected[j, i] = True
    for block, most in ((4, 1 << 20), (20, 1 << 20), (192, 2000), (192, 1 << 20)):
        monkeypatch.setattr(neardup, "BLOCK_BYTES", most)
        found = {(min(r.a, r.b), max(r.a, r.b)) for r in residual_links(frame, bands, block).collect()}
        assert found == set(expected)


def test_bands_find_what_they_promise():
    for percent in (80, 85, 100):
        bands = Bands(percent)
        miss = (1 - (percent / 100) ** bands.rows) ** bands.number
        assert miss < 5e-7 and bands.hashes <= 128
    with pytest.raises(ValueError):
        Bands(70)
    same = signatures([np.arange(5, dtype=np.uint64)] * 2, Bands(85).hashes)
    assert np.array_equal(*band_keys(same, Bands(85)))
    assert len(block_links(pa.table({
        "doc_id": [1, 2], "component": [1, 1], "side": [0, 0], "signature": [s.tobytes() for s in same],
        "shingles": [np.arange(5, dtype=np.uint64).tobytes()] * 2}), Bands(85))) == 0


def test_deduplicated_decides_by_row(spark):
    a, b, c, d = (words(i, 60) for i in (71, 72, 73, 74))
    rows = [(5, a, "p"), (6, a, "q"), (6, b, "r"), (9, b, "s"), (None, c, "t"), (None, c, "u"), (7, c, "v"),
            (8, d, "w"), (8, d, "x"), (None, None, "y"), (8, " ", "z"), (8, " ", "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, tag string").repartition(5)
    kept = plain(neardup.deduplicated(frame).select("doc_id", "text"))
    assert kept == plain(spark.createDataFrame(
        [(5, a), (6, b), (7, c), (8, d), (None, None), (8, " "), (8, " ")], "doc_id long, text string"))


def test_one_hot_id_does_not_drop_unique_texts(spark):
    many = [(1, words(100 + i, 40)) for i in range(60)]
    near = variants(5, 40, 2)
    rows = [*many, *((20 + i, t) for i, (_, t) in enumerate(many)), *((1 if i % 2 else None, t) for i, t in enumerate(near))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [tuple(r) for r in neardup.deduplicated(frame).collect()]
    ids = [(i, t) for i, (_, t) in enumerate(rows)]
    components = {root for _, _, root, _ in by_hand(ids, 5, 80)}
    assert len(kept) == len(components) and {t for _, t in kept} >= {t for _, t in many}
    assert all(i == 1 for i, _ in kept)


def test_words_that_a_polynomial_hash_confuses_link_nothing(spark):
    a, b = confused()
    rows = [(1, "x y " + a), (2, "x y " + b), (3, "x y " + a + " z"), (4, a), (5, b), (6, a)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert plain(found.select("doc_id", "n_shingles", "component_id", "kept")) == by_hand(rows, 3, 85)
    assert neardup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).count() == 5
