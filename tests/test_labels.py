import pytest
from helpers import ORDER_SCHEMA, rows, same
from pyspark.sql import functions as F

from rebasket.functions.keys import hash_number
from rebasket.operators import labels
from rebasket.operators.labels import (
    candidate_orders,
    holdout,
    labelled,
    random_holdout,
    random_sample,
    sample,
    split_train_test,
    train_lines,
)
from rebasket.plans.matrix import feature_matrix, labelled_matrix

LINES = "order_id long, product_id long, reordered int, user_id long"


def test_missing_eval_set_is_no_candidate(spark):
    orders = spark.createDataFrame(
        [(1, 1, None, 1, None), (2, 1, "prior", 2, 1.0), (3, 1, "train", 3, 1.0)], ORDER_SCHEMA)
    assert rows(candidate_orders(orders)) == [(1, 3, "train")]


def test_labels_fill_train_only_and_never_add_rows(spark):
    features = spark.createDataFrame([(1, 5), (1, 6), (2, 5)], "user_id long, product_id long")
    candidates = spark.createDataFrame([(1, 30, "train"), (2, 31, "test")],
                                       "user_id long, order_id long, eval_set string")
    lines = spark.createDataFrame([(30, 5, 1, 1), (30, 5, 0, 1)], LINES)
    found = labelled(features, candidates, lines)
    assert rows(found, "user_id", "product_id", "order_id", "reordered") == [
        (1, 5, 30, 1), (1, 6, 30, 0), (2, 5, 31, None)]


def test_early_and_late_candidate_join_agree(tiny):
    lines = train_lines(tiny.order_products_train, tiny.orders)
    late = labelled(feature_matrix(tiny), candidate_orders(tiny.orders), lines)
    same(labelled_matrix(tiny), late)


def test_row_count_is_that_of_the_candidate_join(small):
    matrix = feature_matrix(small)
    expected = matrix.join(candidate_orders(small.orders), "user_id").count()
    assert labelled_matrix(small).count() == expected == 39914


def test_train_and_test_rows(small):
    train, test = split_train_test(labelled_matrix(small))
    assert train.where("reordered is null").count() == 0
    assert "reordered" not in test.columns
    assert {"user_id", "product_id", "order_id"} <= set(test.columns)


def test_holdout_is_a_repeatable_partition(small):
    train = split_train_test(labelled_matrix(small))[0].select("user_id", "product_id")
    kept, held = holdout(train)
    assert (kept.count(), held.count()) == (24054, 5909)
    assert kept.join(held, ["user_id", "product_id"], "left_semi").count() == 0
    same(held, holdout(train.repartition(13))[1])
    other = holdout(train, seed=7)[1]
    assert other.join(held, ["user_id", "product_id"], "left_semi").count() < held.count()


def test_samples_keep_their_share(spark):
    wide = spark.range(20000).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("product_id"))
    assert 1700 < sample(wide).count() < 2300
    assert 1700 < random_sample(wide).count() < 2300
    kept, rest = random_holdout(wide)
    assert kept.count() + rest.count() == 20000 and 15500 < kept.count() < 16500


def keyed_rows(spark, keys):
    return spark.createDataFrame([(u, p, i, i % 3) for i, (u, p) in enumerate(keys)], "user_id long, product_id long, i int, reordered int")


@pytest.mark.parametrize("bits", [2, 15])
def test_exact_split_takes_the_least_hashes(spark, monkeypatch, bits):
    monkeypatch.setattr(labels, "_LEVEL_BITS", bits)
    frame = keyed_rows(spark, [(u, p) for u in range(30) for p in range(20)]).repartition(4)
    number = {(r.user_id, r.product_id): r.n for r in frame.select("user_id", "product_id", hash_number(labels.PAIR, 5).alias("n")).collect()}
    order = sorted(number, key=number.get)
    for count in (0, 1, 37, 599, 600, 9999):
        kept, rest = labels.exact_split(frame, count, seed=5)
        assert {(r.user_id, r.product_id) for r in kept.collect()} == set(order[:count])
        assert kept.count() + rest.count() == 600 and kept.columns == frame.columns == rest.columns


def test_exact_split_cuts_repeated_keys(spark):
    frame = keyed_rows(spark, [(1, 1)] * 500 + [(2, p) for p in range(40)] + [(None, None)] * 30).repartition(7)
    for count in (1, 100, 333, 531, 569):
        kept, rest = labels.exact_split(frame, count)
        assert (kept.count(), rest.count()) == (count, 570 - count)
        assert kept.select("i").intersect(rest.select("i")).isEmpty()
    assert labels.exact_sample(frame, 0.1).count() == 57
    held = labels.exact_holdout(frame, 100)
    assert [h.count() for h in held] == [470, 100]
    assert labels.exact_sample(frame.limit(0)).count() == 0


@pytest.mark.parametrize("per_block", [None, 13])
def test_folds_share_every_label_evenly(spark, per_block):
    frame = keyed_rows(spark, [(u, p) for u in range(40) for p in range(7)])
    frame = frame.withColumn("reordered", F.when(F.col("i") < 200, 0).when(F.col("i") < 279, 1))
    dealt = labels.label_folds(frame, 3, per_block=per_block)
    assert sorted(dealt.columns) == sorted([*frame.columns, "fold"]) and dealt.count() == 280
    for label in (0, 1, None):
        counts = [r["count"] for r in dealt.where(F.col("reordered").eqNullSafe(F.lit(label))).groupBy("fold").count().collect()]
        assert max(counts) - min(counts) <= 1
    same(dealt, labels.label_folds(frame.repartition(5), 3, per_block=7))
