import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from odd_rows import confused
from rebasket.llm.text import Words, binary_column, equal_words, inner_windows, slices, small_batches, window_hashes

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n\x0b漢 ", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXT, st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, limit):
    column = binary_column(pa.array(texts, pa.string()))
    seen = {}
    row = 0
    for first, part in slices(column, limit):
        found = Words(part)
        for i in range(len(part)):
            expected = re.findall(r"[^\x20\x09-\x0D]+", texts[first + i] or "")
            a, b = found.bounds[i], found.bounds[i + 1]
            assert [bytes(found.data[x:y]).decode() for x, y in zip(found.starts[a:b], found.ends[a:b])] == expected
            for word, value in zip(expected, found.hashes[a:b]):
                assert seen.setdefault(word, value) == value
            row += 1
    assert row == len(texts) and len(set(seen.values())) == len(seen)


def test_window_hashes_depend_on_content_only():
    draw = np.random.default_rng(1)
    hashes = draw.integers(0, 50, 500).astype(np.uint64)
    for width in (2, 5, 9, 35):
        found = window_hashes(hashes, width)
        by_content = {}
        for i, value in enumerate(found):
            assert by_content.setdefault(tuple(hashes[i:i + width]), value) == value
        assert len(set(by_content.values())) == len(by_content)
    assert np.array_equal(window_hashes(np.concatenate([hashes[:9], hashes]), 9)[9:], window_hashes(hashes, 9))


def test_windows_stay_within_a_text():
    bounds = np.array([0, 3, 3, 4, 9])
    assert inner_windows(bounds, 3, 7).tolist() == [True, False, False, False, True, True, True]


def test_hashes_tell_words_apart_that_a_polynomial_confuses():
    pairs = [confused(n) for n in (8, 16, 64, 65, 1024, 4096)]
    column = binary_column(pa.array([" ".join(p) for p in pairs], pa.string()))
    found = Words(column)
    for values in (found.hashes, found.second, found.hashed(2)):
        assert len(set(values.tolist())) == 2 * len(pairs)
    assert not (found.hashes == found.second).any()
    size = found.ends - found.starts
    even, odd = np.arange(0, len(size), 2), np.arange(1, len(size), 2)
    assert not equal_words(found.lanes, found.starts[even], size[even], found.lanes, found.starts[odd], size[odd]).any()
    assert equal_words(found.lanes, found.starts, size, found.lanes, found.starts, size).all()


def test_windows_of_confusing_patterns_differ():
    draw = np.random.default_rng(3)
    x, y = draw.integers(0, 1 << 63, 2).astype(np.uint64)
    for width in (32, 35, 1024, 2048):
        bits = np.array([bin(i).count("1") & 1 for i in range(width)], bool)
        assert window_hashes(np.where(bits, x, y), width)[0] != window_hashes(np.where(bits, y, x), width)[0]


def test_batches_end_at_a_few_megabytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "1234")
        small_batches(spark)
        assert spark.conf.get(key).rstrip("b") == "1234"
        spark.conf.unset(key)
        small_batches(spark)
        assert int(spark.conf.get(key).rstrip("b")) == 4 << 20
    finally:
        spark.conf.set(key, before)
