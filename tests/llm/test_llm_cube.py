import random

import numpy as np
import pytest
from odd_rows import empty, odd, plain, words

from rebasket.llm import cube


def targets_by_hand(sizes, most=3):
    """Sources in order, each with its target, by rounds of sharing the excess."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        rest = total - sum(most * sizes[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > most * sizes[s]}
        if not above:
            return {**share, **{s: float(most * sizes[s]) for s in full}}
        full |= above


@pytest.mark.parametrize("seed", range(6))
def test_targets_agree_with_rounds(spark, seed):
    draw = random.Random(seed)
    sizes = {None if i == 3 else f"{'é' if i % 2 else 'Z'}{i}": draw.choice([0, 1, 10, 500, 4000]) for i in range(draw.randint(1, 9))}
    frame = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in cube.source_targets(frame).collect()}
    expected = targets_by_hand(sizes)
    assert found.keys() == expected.keys()
    assert all(found[s] == pytest.approx(expected[s], rel=1e-12, abs=1e-9) for s in found)


def documents(spark, n, partitions):
    draw = random.Random(n)
    rows = [(i, words(i, draw.randint(1, 40)), None if i % 11 == 0 else f"s{(i * i) % 4 if i % 3 else 0}") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(partitions)


def test_totals_balance_over_levels_and_reruns_agree(spark):
    docs = documents(spark, 1500, 3)
    first = cube.mix(docs, chunk=40)
    rows = first.toPandas()
    assert len(rows) == 1500 and (rows.taken <= 3 * rows["size"]).all() and (rows.taken == rows["size"] * rows.copies).all()
    for _, part in rows.groupby("source", dropna=False):
        ratio = part.target.iloc[0] / part.source_size.iloc[0]
        assert abs(part.taken.sum() - part.target.iloc[0]) < 45
        assert abs(part.copies.sum() - len(part) * ratio) < 4
        assert set(part.copies) <= {int(ratio), int(ratio) + 1}
    assert plain(cube.mix(documents(spark, 1500, 7), chunk=40)) == plain(first)


def test_each_document_keeps_its_probability():
    size = [float(s) for s in (3, 8, 8, 20, 31, 5, 12, 40, 2, 9)]
    taken = np.zeros(10)
    for seed in range(3000):
        draw = random.Random(seed)
        p, open_ = [0.3] * 10, list(range(10))
        while len(open_) > 2:
            three = open_[:3]
            own = [p[i] for i in three]
            before = sum(own), sum(x * size[i] for x, i in zip(own, three))
            cube.step(own, [size[i] for i in three], draw)
            after = sum(own), sum(x * size[i] for x, i in zip(own, three))
            assert after[0] == pytest.approx(before[0]) and (after[1] == pytest.approx(before[1]))
            for i, x in zip(three, own):
                p[i] = x
            open_ = [i for i in open_ if 0 < p[i] < 1]
        taken += p
    assert np.abs(taken / 3000 - 0.3).max() < 0.04


def test_odd_rows_and_empty_tables(spark):
    rows = cube.mix(odd(spark)).toPandas()
    assert len(rows) == odd(spark).count() and (rows[rows["size"] == 0].taken == 0).all()
    sizes = rows.groupby("source", dropna=False)["size"].sum()
    expected = targets_by_hand({None if s != s else s: int(v) for s, v in sizes.items()})
    for s, t in zip(rows.source, rows.target):
        assert t == pytest.approx(expected[None if s is None or s != s else s])
    assert plain(cube.mix(empty(spark))) == []
    nothing = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r.target, r.taken) for r in cube.mix(nothing).collect()) == [(0.0, 0), (0.0, 0)]
    mixed = cube.mixed(odd(spark))
    assert mixed.columns == odd(spark).columns and cube.mixed(empty(spark)).collect() == []


def test_mixed_repeats_rows(spark):
    docs = documents(spark, 300, 3)
    copies = {r.doc_id: r.copies for r in cube.mix(docs).collect()}
    seen = {}
    for r in cube.mixed(docs).collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {i: c for i, c in copies.items() if c}


@pytest.mark.parametrize("chunk", [40, 2048])
def test_mixed_takes_each_row_of_a_null_or_repeated_id_as_decided(spark, chunk):
    rows = [(None if i % 2 else 7, f"a{i} b c d" if i % 3 else f"a{i} b", "abc"[i % 3 if i % 5 else 0], i) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, nth long").repartition(4)
    decided = cube.mix(docs, chunk=chunk).toPandas()
    taken = cube.mixed(docs, chunk=chunk).toPandas()
    taken["words"] = taken["text"].str.split().str.len()
    for source, part in decided.groupby("source"):
        own = taken[taken["source"] == source]
        assert own["words"].sum() == pytest.approx(part["target"].iloc[0], abs=10)
        assert set(own.groupby("nth").size()) <= set(part["copies"])
    assert len(taken) == pytest.approx(decided["copies"].sum(), abs=6)
