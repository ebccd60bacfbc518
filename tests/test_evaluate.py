import math
import random

import pytest
from helpers import rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from rebasket.functions.decisions import above, rounded, verdict
from rebasket.operators import running
from rebasket.operators.evaluate import (
    pr_auc,
    pr_curve,
    pr_interpolated,
    quantiles,
    roc_auc,
    roc_curve,
    score_density,
    score_distribution,
)
from rebasket.operators.submission import decide, submission
from rebasket.operators.tuning import best, tuning_results


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "s double, y int")


def test_tied_scores_count_half(spark):
    frame = scored(spark, [(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1)])
    assert roc_auc(frame, "s", "y").first().auc == 0.875


def test_auc_needs_both_classes_and_judged_rows(spark):
    assert roc_auc(scored(spark, [(0.1, 1), (0.2, 1)]), "s", "y").first().auc is None
    frame = scored(spark, [(0.1, 0), (0.9, 1), (None, 1), (0.5, None)])
    assert roc_auc(frame, "s", "y").first().asDict() == {"positives": 1, "negatives": 1, "auc": 1.0}


def test_curves_agree_with_brute_force_and_spark(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(0, 400) / 400, int(rng.random() < 0.3)) for _ in range(3000)]
    frame = scored(spark, pairs)
    p = sum(y for _, y in pairs)
    n = len(pairs) - p
    expected = []
    for t in sorted({s for s, _ in pairs}):
        tp = sum(y for s, y in pairs if s >= t)
        fp = sum(1 - y for s, y in pairs if s >= t)
        expected.append((t, tp, fp, tp / p, fp / n, tp / (tp + fp)))
    assert rows(roc_curve(frame, "s", "y")) == sorted((e[:5] for e in expected), key=repr)
    assert rows(pr_curve(frame, "s", "y")) == sorted(
        ((e[0], e[1], e[2], e[5], e[3]) for e in expected), key=repr)
    wins = sum((a > b) + (a == b) / 2 for a, y in pairs if y for b, z in pairs if not z)
    auc = roc_auc(frame, "s", "y").first().auc
    assert math.isclose(auc, wins / (p * n))
    exact = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(frame)
    assert math.isclose(auc, exact)


def test_density_integrates_to_one(spark):
    frame = scored(spark, [(0.0, 0), (0.04, 0), (0.5, 0), (1.0, 1), (0.99, 1)])
    found = score_distribution(frame, "s", "y", bins=20)
    assert rows(found, "label", "bin", "n") == [(0, 0, 2), (0, 10, 1), (1, 19, 2)]
    for r in found.groupBy("label").agg((F.sum("density") / 20).alias("area")).collect():
        assert math.isclose(r.area, 1.0)


def test_threshold_is_strict_and_nan_is_no(spark):
    frame = spark.createDataFrame([(float("nan"),), (None,), (0.21,), (0.2100001,)], "p double")
    assert [r[0] for r in frame.select(above("p", 0.21)).collect()] == [0, 0, 0, 1]
    assert [r[0] for r in frame.select(verdict("p", 0.2)).collect()] == [
        "Customer is unlikely to buy this product!"] * 2 + ["Customer is likely to buy this product!"] * 2


def test_halves_round_to_even(spark):
    frame = spark.createDataFrame([(0.5,), (1.5,), (0.51,)], "p double")
    assert [r[0] for r in frame.select(rounded("p")).collect()] == [0, 2, 1]


DECIDED = "order_id long, product_id long, prob double"


@pytest.mark.parametrize("given, expected", [
    ([(1, 10, 0.9), (1, 9, 0.8), (1, 100, 0.7), (1, 7, 0.1)], [(1, "9 10 100")]),
    ([(1, 10, 0.9), (2, 9, 0.8)], [(1, "10"), (2, "9")]),
    ([(1, 10, 0.1), (2, 9, None)], [(1, "None"), (2, "None")]),
    ([(3, 10, 0.1), (2, 9, 0.5), (2, 9, 0.5)], [(2, "9"), (3, "None")]),
])
def test_submission(spark, given, expected):
    result = submission(decide(spark.createDataFrame(given, DECIDED)))
    assert [tuple(r) for r in result.collect()] == expected


def test_tuning_results_are_ordered_and_matched_by_key(spark):
    grid = spark.createDataFrame([(0, 0.1), (1, 0.05), (2, 0.3)], "row int, eta double")
    metrics = spark.createDataFrame([(2, 0.7), (0, 0.7), (1, 0.9)], "row int, auc double")
    high = tuning_results(grid, metrics, ["row"], "auc")
    assert [tuple(r) for r in high.collect()] == [(1, 0.05, 0.9), (0, 0.1, 0.7), (2, 0.3, 0.7)]
    low = tuning_results(grid, metrics, ["row"], "auc", best_is="min")
    assert [tuple(r) for r in best(low).collect()] == [(0, 0.1, 0.7)]


def test_gaps_in_scores_are_left_out(spark):
    nan = float("nan")
    frame = scored(spark, [(0.1, 0), (0.2, 1), (nan, 0), (None, 0), (-0.2, 0), (1.3, 1)])
    assert roc_auc(frame, "s", "y").first().asDict() == {"positives": 2, "negatives": 2, "auc": 1.0}
    found = score_distribution(frame, "s", "y", bins=20)
    assert rows(found, "label", "bin", "n") == [(0, 0, 1), (0, 2, 1), (1, 19, 1), (1, 4, 1)]


def test_decide_takes_nan(spark):
    frame = spark.createDataFrame([(float("nan"),), (None,), (0.5,), (1.5,)], "prob double")
    assert rows(decide(frame), "decision", "rounded") == [(0, None), (0, None), (1, 0), (1, 2)]


def some_scores(n=900, seed=7):
    rng = random.Random(seed)
    return [(rng.randint(0, 60) / 60 if rng.random() < 0.7 else rng.random(), int(rng.random() < 0.3)) for _ in range(n)]


def pr_at(pairs, tp):
    """Precision where the highest scores hold ``tp`` positives, false ones in proportion."""
    t = f = 0
    for s in sorted({s for s, _ in pairs}, reverse=True):
        pos, neg = sum(y for x, y in pairs if x == s), sum(1 - y for x, y in pairs if x == s)
        if pos and t < tp <= t + pos:
            return tp / (tp + f + neg / pos * (tp - t))
        t, f = t + pos, f + neg


@pytest.mark.parametrize("per_block", [500_000, 40])
def test_interpolated_precision_and_its_area(spark, monkeypatch, per_block):
    monkeypatch.setattr(running, "ROWS_PER_BLOCK", per_block)
    pairs = some_scores()
    p = sum(y for _, y in pairs)
    frame = scored(spark, [*pairs, (None, 1), (float("nan"), 0), (0.5, None)])
    found = {r.point: r for r in pr_interpolated(frame, "s", "y", points=50).collect()}
    assert sorted(found) == list(range(51))
    for k in range(1, 51):
        assert found[k].recall == k / 50 and found[k].precision == pytest.approx(pr_at(pairs, k * p / 50))
    steps = 20_000
    area = sum(pr_at_many(pairs, [(i + 0.5) * p / steps for i in range(steps)])) / steps
    r = pr_auc(frame, "s", "y").first()
    assert (r.positives, r.negatives) == (p, len(pairs) - p) and r.pr_auc == pytest.approx(area, abs=1e-4)


def pr_at_many(pairs, tps):
    points, t, f = [], 0, 0
    for s in sorted({s for s, _ in pairs}, reverse=True):
        pos, neg = sum(y for x, y in pairs if x == s), sum(1 - y for x, y in pairs if x == s)
        points.append((t, f, pos, neg))
        t, f = t + pos, f + neg
    out, at = [], 0
    for tp in tps:
        while not points[at][0] < tp <= points[at][0] + points[at][2]:
            at += 1
        t, f, pos, neg = points[at]
        out.append(tp / (tp + f + neg / pos * (tp - t)))
    return out


def test_precision_recall_at_the_edges(spark):
    assert pr_auc(scored(spark, [(0.9, 1), (0.8, 1), (0.1, 0)]), "s", "y").first().pr_auc == 1.0
    assert pr_auc(scored(spark, [(0.1, 0), (0.2, 0)]), "s", "y").first().pr_auc is None
    assert pr_interpolated(scored(spark, [(0.1, 0), (0.2, 0)]), "s", "y").collect() == []
    assert pr_interpolated(scored(spark, []), "s", "y").collect() == []
    worst = {r.point: r.precision for r in pr_interpolated(scored(spark, [(0.9, 0), (0.1, 1)]), "s", "y", 4).collect()}
    assert worst[0] == 0.0 and worst[4] == 0.5 and worst[2] == pytest.approx(0.5 / 1.5)


@pytest.mark.parametrize("per_block", [500_000, 25])
def test_quantiles_are_exact(spark, per_block):
    pairs = some_scores(501)
    frame = scored(spark, pairs)
    found = {r.y: r for r in quantiles(frame, "s", ["y"], {"q1": 0.25, "m": 0.5, "q3": 0.75, "low": 0.0, "high": 1.0}, per_block).collect()}
    for y in (0, 1):
        values = sorted(s for s, z in pairs if z == y)
        for name, q in (("q1", 0.25), ("m", 0.5), ("q3", 0.75), ("low", 0.0), ("high", 1.0)):
            rank = (len(values) - 1) * q
            low, high = values[math.floor(rank)], values[math.ceil(rank)]
            assert found[y][name] == pytest.approx(low + (rank - math.floor(rank)) * (high - low))
        assert found[y].n == len(values)


def test_density_is_the_kernel_sum_and_integrates_to_about_one(spark):
    pairs = some_scores(400)
    found = score_density(scored(spark, [*pairs, (None, 1), (float("nan"), 0)]), "s", "y", points=128).collect()
    assert len(found) == 256
    low, high = min(s for s, _ in pairs), max(s for s, _ in pairs)
    step = (high - low) / 127
    for y in (0, 1):
        own = sorted(s for s, z in pairs if z == y)
        n, mean = len(own), sum(own) / len(own)
        sd = math.sqrt(sum((s - mean) ** 2 for s in own) / (n - 1))

        def quarter(q):
            rank = (n - 1) * q
            a, b = own[math.floor(rank)], own[math.ceil(rank)]
            return a + (rank - math.floor(rank)) * (b - a)

        width = 0.9 * min(sd, (quarter(0.75) - quarter(0.25)) / 1.34) * n ** -0.2
        grid = {r.point: r for r in found if r.label == y}
        for k in (0, 17, 64, 127):
            centres = [low + round((s - low) / step) * step for s in own]
            exact = sum(math.exp(-((low + k * step - c) / width) ** 2 / 2) for c in centres) / (n * width * math.sqrt(2 * math.pi))
            assert grid[k].score == pytest.approx(low + k * step) and grid[k].density == pytest.approx(exact, rel=0.02)
        assert 0.85 < sum(r.density for r in grid.values()) * step < 1.01


def test_density_of_one_value_and_of_nothing(spark):
    found = score_density(scored(spark, [(0.5, 1)] * 4 + [(0.5, 0)]), "s", "y", points=8).collect()
    assert {r.label for r in found} == {0, 1} and len({r.score for r in found}) == 1
    assert score_density(scored(spark, []), "s", "y").collect() == []
