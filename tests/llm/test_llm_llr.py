import re
from collections import Counter

import numpy as np
from odd_rows import empty, labels_of, odd, plain

from rebasket.llm import llr

TINY = "/root/testdata/sf0.001"


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_rules_agree_with_brute_force(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    found = {r.doc_id: tuple(r[c] for c in COUNTS) for r in llr.judge(docs, np.zeros(1 << llr.BITS)).collect()}
    assert found == {r.doc_id: by_hand(r.text) for r in docs.collect()}


def test_counts_cover_every_document_and_scores_are_means(spark):
    docs, labels = (spark.read.parquet(f"{TINY}/{t}.parquet") for t in ("documents", "labels"))
    ratio = llr.fit(docs, labels)
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    import pyarrow as pa
    from rebasket.llm.text import Words

    corpus, trusted, per = np.ones(1 << llr.BITS), np.zeros(1 << llr.BITS), {}
    for r in docs.collect():
        buckets = llr.features(Words(pa.array([r.text.encode()], pa.large_binary())))[0]
        counts = np.bincount(buckets, minlength=1 << llr.BITS)
        corpus += counts
        trusted += counts * (r.doc_id in good)
        per[r.doc_id] = buckets
    corpus /= corpus.sum()
    trusted += llr.PRIOR * len(corpus) * corpus
    expected = np.log(trusted / trusted.sum()) - np.log(corpus)
    assert np.allclose(ratio, expected)
    rows = llr.judge(docs, ratio).collect()
    assert all(abs(r.score - expected[per[r.doc_id]].mean()) < 1e-9 for r in rows if len(per[r.doc_id]))
    assert all(r.kept == (not r.base_failed and r.score >= llr.THRESHOLD) for r in rows)


def test_junk_goes_and_clean_stays(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = llr.quality_rules(docs, labels).join(labels, "doc_id").filter("not base_failed").toPandas()
    assert found[found.quality == 1].kept.mean() > 0.999
    assert found[found.quality == 0].kept.mean() < 0.1


def test_odd_rows_and_empty_tables(spark):
    labels = labels_of(spark, [(6, 1, 0), (6, 1, 0), (9, 0, 0), (11, None, 0), (None, 1, 0)])
    found = llr.quality_rules(odd(spark), labels).collect()
    expected = sorted(((r.doc_id, *by_hand(r.text)) for r in odd(spark).collect()), key=repr)
    assert sorted(((r.doc_id, *(r[c] for c in COUNTS)) for r in found), key=repr) == expected
    assert all(r.score == 0 and not r.kept for r in found if r.n_words == 0)
    assert plain(llr.quality_rules(empty(spark), labels)) == []
    assert len(llr.quality_rules(odd(spark), labels_of(spark, [])).collect()) == len(found)
