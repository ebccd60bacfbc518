import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from odd_rows import confused, empty, odd, plain
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rebasket.llm import wavelet
from rebasket.llm.text import Words
from rebasket.llm.wavelet import Encoder, Plane, WaveletMatrix, matrix_of
from rebasket.session import fresh_path

PATH, SIZE = public_tokenizers.path("word_bpe_49k.json"), 49408
library = Tokenizer.from_file(PATH)


def matrix(ids, planes=16):
    return WaveletMatrix([Plane(b, o, len(ids), z) for b, o, z in WaveletMatrix.rows(np.array(ids, "<u4"), planes)], len(ids))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=1500))
def test_access_count_and_places(ids):
    m = matrix(ids, 6)
    assert m.decode().tolist() == ids
    for token in set(ids) | {41, 99}:
        places = [i for i, x in enumerate(ids) if x == token]
        assert m.count(token) == len(places)
        if places:
            assert [m.locate(token, k) for k in (0, len(places) // 2, len(places) - 1)] == [places[0], places[len(places) // 2], places[-1]]
    for i in range(0, len(ids), 97):
        assert m.access(i) == ids[i] and m.count(ids[i], i, i + 1) == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abAB'sSdtl.,!é ÀĳΣσİ漢9² ×÷<|>́ \x1c​", max_size=40), max_size=4))
def test_ids_are_the_librarys(texts):
    texts = [*texts, "a<|endoftext|>b <|startoftext|> DON'T we'LL"]
    found, ends = Encoder(PATH).encode(pa.array([t.encode() for t in texts], pa.large_binary()), 1)
    start = 0
    for text, end in zip(texts, ends.tolist()):
        assert found[start:end].tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]
        start = end


def expected(frame):
    rows = frame.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    rows = [(r.doc_id, r.text or "") for r in sorted(rows, key=lambda r: (-(1 << 63) if r.doc_id is None else r.doc_id, r.h))]
    out, start = [], 0
    for doc, text in rows:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_odd_rows_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_BYTES", 20_000)
    assert plain(wavelet.token_files(odd(spark), PATH, SIZE)) == expected(odd(spark))
    assert plain(wavelet.token_files(empty(spark), PATH, SIZE)) == []


def test_given_documents_by_shards(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    monkeypatch.setattr(wavelet, "SHARD_BYTES", 30_000)
    out = fresh_path(spark, "tokens")
    wavelet.write_shards(docs, PATH, SIZE, out)
    assert plain(wavelet.read_documents(spark, out)) == expected(docs)
    part = spark.read.parquet(out).filter("shard = 2 and part = 0").first().asDict()
    m = matrix_of(part)
    ids = m.decode()
    token = int(ids[5])
    assert m.access(5) == token and m.count(token) == int((ids == token).sum())
    assert len(spark.read.parquet(out).inputFiles()) > 10
    encoded = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]
    places = sorted((d, k) for d, own in encoded for k, x in enumerate(own) if x == token)
    assert sorted((r.doc_id, r.place) for r in wavelet.occurrences(spark, out, token).collect()) == places
    assert wavelet.occurrences(spark, out, SIZE - 1).collect() == []


def test_words_that_a_polynomial_hash_confuses_keep_their_ids(spark):
    a, b = confused()
    rows = [(1, "x y " + a, "s"), (2, "x y " + b, "s"), (3, a, "s"), (3, b + " " + a, "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    assert plain(wavelet.token_files(frame, PATH, SIZE)) == expected(frame)


def test_words_of_one_hash_are_told_apart_by_their_bytes(monkeypatch):
    weak = Words.hashed
    monkeypatch.setattr(Words, "hashed", lambda self, seed: weak(self, seed) >> np.uint64(63 if seed < 3 else 0))
    model = Encoder(PATH)
    for texts in (["one two three one"], ["four five six", "two " + "x" * 90 + " " + "x" * 89 + "y"], ["one six"] * 3):
        found, ends = model.encode(pa.array([t.encode() for t in texts], pa.large_binary()), 1)
        assert found.tolist() == [i for t in texts for i in [*library.encode(t, add_special_tokens=False).ids, 1]]
    assert model.seed == 3


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        Encoder(public_tokenizers.path("byte_bpe_50k.json"))
