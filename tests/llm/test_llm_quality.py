import math

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import empty, labels_of, odd, plain
from pyspark.sql import functions as F

from rebasket.llm import quality
from rebasket.llm.quality import Fit, Net, fitted, gradient, head, padded, pooled_block, raw, scores

SMALL = "/root/testdata/sf0.01"


def forward(net, texts):
    laid, bounds = padded(*raw(pa.array(texts, pa.large_binary())))
    return head(net, pooled_block(net, laid, bounds, 0, int(bounds[-1])), bounds)[-1], laid, bounds


def test_gradient_agrees_with_differences():
    net = Net(Fit(filters=3, hidden=4, embedding=4))
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    texts, label = [b"some bytes " * 70, b"other", b"!!! ### " * 40], np.array([1.0, 0.0, 1.0])

    def loss():
        p = forward32(net, texts)
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    def forward32(n, t):
        n32 = Net(Fit(filters=3, hidden=4, embedding=4))
        n32.w = {k: v.astype(np.float32) for k, v in n.w.items()}
        return forward(n32, t)[0].astype(float)

    n32 = Net(Fit(filters=3, hidden=4, embedding=4))
    n32.w = {k: v.astype(np.float32) for k, v in net.w.items()}
    _, laid, bounds = forward(n32, texts)
    found = gradient(n32, laid, bounds, label)
    for name in ("last", "dense", "filters", "shift", "bytes"):
        flat = net.w[name].reshape(-1)
        at = int(np.argmax(np.abs(found[name].reshape(-1))))
        flat[at] += 1e-3
        up = loss()
        flat[at] -= 2e-3
        down = loss()
        flat[at] += 1e-3
        assert found[name].reshape(-1)[at] == pytest.approx((up - down) / 2e-3, rel=0.15, abs=2e-3)


def test_a_score_does_not_depend_on_neighbours():
    net = Net(Fit())
    texts = [b"", b"a", b"b" * 255, b"c" * 256, b"d" * 257, b"e" * 70_000, bytes(range(1, 200)) * 9]
    together = scores(net, pa.array(texts, pa.large_binary()))
    alone = [float(scores(net, pa.array([t], pa.large_binary()))[0]) for t in texts]
    assert np.allclose(together, alone, atol=1e-5)
    assert len(scores(net, pa.array([], pa.large_binary()))) == 0


def test_one_label_or_none_still_answers():
    assert scores(fitted([b"x"], [1], Fit()), pa.array([b"y"], pa.large_binary()))[0] > 0.99
    assert scores(fitted([b"x"], [0], Fit()), pa.array([b"y"], pa.large_binary()))[0] < 0.01
    assert scores(fitted([], [], Fit()), pa.array([b"y"], pa.large_binary()))[0] > 0.99


def test_held_out_texts_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = found[found.quality == 1].score, found[found.quality == 0].score
    wins = (good.to_numpy()[:, None] > bad.to_numpy()[None, :]).mean()
    assert wins > 0.95 and (good >= 0.5).mean() > 0.9


def test_held_out_labels_are_never_used(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(quality.fold() == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    few = Fit(per_label=40, rounds=1)
    part = docs.filter("doc_id < 60")
    a = plain(quality.classify(part, labels, few))
    assert a == plain(quality.classify(part, flipped, few))


def test_odd_rows_and_empty_tables(spark):
    labels = labels_of(spark, [(6, 1, 0), (6, 0, 0), (9, 0, 0), (11, None, 0), (None, 1, 0)])
    found = quality.classify(odd(spark), labels, Fit(per_label=5, rounds=1))
    rows = found.collect()
    assert len(rows) == odd(spark).count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert plain(quality.classify(empty(spark), labels, Fit())) == []
    assert quality.good(odd(spark), labels_of(spark, [])).columns == odd(spark).columns


def score_by_hand(net, text):
    """The network over one text in plain loops."""
    w = {k: v.astype(float).tolist() for k, v in net.w.items()}
    filters, per = len(w["filters"][0]), len(w["bytes"][0])
    cells = max(1, -(-(len(text) + 7) // 256))
    padded = text + bytes(cells * 256 + 8 - len(text))
    high = []
    for cell in range(cells):
        best = [-1e30] * filters
        for at in range(cell * 256, cell * 256 + 256, 2):
            if cell == cells - 1 and at >= cell * 256 + 250:
                continue  # the filter would leave the text's cells
            for f in range(filters):
                total = sum(w["bytes"][padded[at + k]][e] * w["filters"][k * per + e][f] for k in range(8) for e in range(per))
                best[f] = max(best[f], total)
        high.append(best)
    pairs = [(high[i], high[i + 1]) for i in range(cells - 1)] or [(high[0], high[0])]
    chunks = [[max(0.0, max(a[f], b[f]) + w["shift"][f]) for f in range(filters)] for a, b in pairs]
    both = [sum(c[f] for c in chunks) / len(chunks) for f in range(filters)] + [max(c[f] for c in chunks) for f in range(filters)]
    hidden = [max(0.0, sum(x * w["dense"][i][h] for i, x in enumerate(both)) + w["dense_shift"][h]) for h in range(len(w["last"]))]
    return 1 / (1 + math.exp(-(sum(x * y for x, y in zip(hidden, w["last"])) + w["last_shift"][0])))


def test_scores_are_those_of_a_naive_convolution():
    small = Fit(embedding=3, filters=4, hidden=5, rounds=2)
    texts = [b"", b"a", b"word " * 50, bytes(range(256)) * 2, "ñ漢 x".encode() * 90, b"z" * 249, b"z" * 250, b"ab" * 700]
    net = quality.fitted([b"good text here", b"#$% junk"] * 6, [1, 0] * 6, small)
    found = quality.scores(net, pa.array(texts, pa.large_binary()))
    assert len(set(np.round(found, 4))) > 3
    for text, value in zip(texts, found):
        assert value == pytest.approx(score_by_hand(net, text), abs=1e-4)
