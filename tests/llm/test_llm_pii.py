import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from odd_rows import empty, odd, plain

from rebasket.llm import pii
from rebasket.llm.pii import KINDS, all_spans, decode, lattice, luhn, marginals, matches, redacted, regions, written

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def by_hand(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            fits = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fits:
                found.append((*m.span(), kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.+-_% 01249()éٳ\n", max_size=60))
def test_base_spans_are_the_patterns(text):
    assert matches(text)[0] == by_hand(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([
    "a.b@c.de", "x@y", "@", "10.20.30.40", "300.1.1.1", "4111 1111 1111 1111", "4111111111111112", "+1 (269) 555-3296", "+49 1", "word", "é", "  ", "\n",
    "1.2.3.4.5.6.7.8", "0000000000000000", "a@b.c@d.e"]), max_size=9))
def test_base_spans_of_likely_things(parts):
    text = " ".join(parts)
    assert matches(text)[0] == by_hand(text)
    assert matches("".join(parts))[0] == by_hand("".join(parts))


@pytest.fixture(scope="module")
def weights():
    draw = random.Random(1)

    def card():
        while True:
            digits = "4" + "".join(draw.choices("0123456789", k=15))
            if luhn(digits):
                return digits

    texts = []
    for i in range(120):
        texts += [f"write to ab{i}.c@mail{i % 7}.example.com today", f"host {draw.randint(1, 255)}.{draw.randint(1, 255)}.0.{i} is up",
                  f"paid with {card()} there", f"call +1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)} now", f"version {i}.0 of 20{i % 99:02d}"]
    return pii.fitted(texts)


def test_neighbours_that_the_patterns_lose_are_added(weights):
    text = "ring +1 (269) 555-3296 4111111111111111 soon"
    base, every = all_spans(text, weights)
    assert base == [] and written(every) == "phone:5:22,card:23:39"
    text = "é 10.2.3.4 +1 (269) 555-3296 4111111111111111 and a@b.co"
    base, every = all_spans(text, weights)
    assert set(base) <= set(every) and [s[2] for s in every] == ["ip", "phone", "card", "email"]


def test_clean_texts_stay_clean(weights):
    for text in ("", "no digits", "Version 2.0 of 2019.", "4111111111111112", "token e4b4111111111111112ff", "1 2 3 4 5", "x@y", "999.1.2.3", "@ + ()"):
        assert all_spans(text, weights) == ([], [])


def test_decoding_is_the_best_of_all_segmentations():
    draw = np.random.default_rng(3)
    text = "+1 269 555 4111 1.2.3.4"
    bounds, segments = lattice(text, 0, len(text))
    for _ in range(20):
        weights = draw.normal(0, 1, len(pii._FEATURES))
        value = {s[:3]: weights[s[3]].sum() for s in segments}
        spans = [(s, (bounds[s[0]], bounds[s[1]], KINDS[s[2]])) for s in segments if s[2] >= 0]

        def total(chosen):
            inside = {k for s, _ in chosen for k in range(s[0], s[1])}
            return sum(value[s[:3]] for s, _ in chosen) + sum(value[k, k + 1, -1] for k in range(len(bounds) - 1) if k not in inside)

        def fits(chosen):
            return all(x[0][1] <= y[0][0] for x, y in itertools.combinations(sorted(chosen, key=lambda c: c[0][0]), 2))

        best = max(total(c) for n in range(3) for c in itertools.combinations(spans, n) if fits(c))
        found = decode(text, 0, len(text), weights)
        assert total([c for c in spans if c[1] in found]) >= best - 1e-9


def test_marginals_agree_with_enumeration():
    text = "+12 3 4"
    bounds, segments = lattice(text, 0, len(text))
    draw = np.random.default_rng(1)
    scores = draw.normal(0, 1, len(segments)).tolist()
    paths = [((), 0)]
    done = []
    while paths:
        path, at = paths.pop()
        if at == len(bounds) - 1:
            done.append(path)
        paths += [((*path, k), s[1]) for k, s in enumerate(segments) if s[0] == at]
    chance = np.zeros(len(segments))
    for path in done:
        for k in path:
            chance[k] += np.exp(sum(scores[x] for x in path))
    total = sum(np.exp(sum(scores[x] for x in path)) for path in done)
    assert np.allclose(marginals(len(bounds), segments, scores), chance / total)


def test_long_runs_take_linear_time(weights):
    for text in ("1" * 200_000, "a" * 200_000, "1 " * 50_000, "1." * 50_000, "+" * 100_000, "a@" * 20_000, "+1" * 20_000):
        all_spans(text, weights)


def test_regions_and_redaction():
    assert [("a 1 2\n3 b").__getitem__(slice(*r)) for r in regions("a 1 2\n3 b")] == ["1 2", "3"]
    spans = [(2, 9, "phone"), (5, 13, "card"), (15, 17, "ip")]
    assert redacted("x +1234567890  ipy", spans) == "x [PHONE]  [IP]y"
    assert list(itertools.chain(regions(""))) == []


def test_odd_rows_and_empty_tables(spark, weights):
    from pyspark.sql import functions as F

    extra = spark.createDataFrame([(70, "a@b.cd 漢 1.2.3.4", "en", "s", 3), (70, "a@b.cd 漢 1.2.3.4", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = odd(spark).unionByName(extra.withColumns({c: F.lit(-1) for c in odd(spark).columns[5:]}))
    for r in pii.find_pii(docs, weights).join(docs.select(F.col("doc_id").alias("i"), "text").distinct(), F.col("doc_id").eqNullSafe(F.col("i"))).collect():
        if r.doc_id not in (None, 6):
            base = by_hand(r.text or "")
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in base) for k in KINDS]
            assert r.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest()
    clean = pii.redact(docs, weights)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert {r.text for r in clean.filter("doc_id = 70").collect()} == {"[EMAIL] 漢 [IP]"}
    assert clean.filter("text is null").count() == docs.filter("text is null").count()
    assert clean.filter("n_chars <> char_length(text)").count() == 0
    assert plain(pii.find_pii(empty(spark))) == [] and plain(pii.redact(empty(spark))) == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in pii.find_pii(docs).collect():
        base = by_hand(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest()
        assert set(written(base).split(",")) <= set(r.spans.split(",")) or not base
