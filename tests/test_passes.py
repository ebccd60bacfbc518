"""Rows are scored once for a log by round, and labels join narrow rows."""

import math

import pytest
from pyspark.sql import functions as F

from rebasket.functions.ratios import FEATURES
from rebasket.operators import labels
from rebasket.operators.model import fit, round_log, score
from rebasket.plans.matrix import labelled_matrix


@pytest.fixture(scope="module")
def bought(spark):
    """Rows whose label follows from one feature, but for some."""
    rows = spark.range(400).select(
        F.col("id").alias("user_id"), (F.col("id") % 7).alias("product_id"), F.col("id").alias("order_id"),
        *[((F.col("id") * (i + 3)) % 11).cast("double").alias(c) for i, c in enumerate(FEATURES)])
    odd = F.col("user_id") % 13 == 0
    return rows.withColumn(labels.LABEL, F.when(odd, 1 - (F.col(FEATURES[0]) > 5).cast("int")).otherwise((F.col(FEATURES[0]) > 5).cast("int")))


def test_a_log_by_round_scores_the_rows_once(bought):
    model = fit(bought, {"nrounds": 3, "max_depth": 3, "eta": 0.3})
    log = round_log(model, bought)
    # what is left to run reads stored counts, so no row meets a tree again
    assert "Generate" not in log._jdf.queryExecution().optimizedPlan().toString()
    last = {r["round"]: r for r in log.collect()}[3]
    errors = [(r["prob"] - r[labels.LABEL]) ** 2 for r in score(model, bought, [labels.LABEL]).collect()]
    assert last["rmse"] == pytest.approx(math.sqrt(sum(errors) / len(errors)))


def _outer_joins(node):
    found = [node] if node.nodeName() == "Join" and node.joinType().toString() == "LeftOuter" else []
    children = node.children()
    return found + [join for i in range(children.size()) for join in _outer_joins(children.apply(i))]


def test_labels_join_the_pair_rows_before_the_features_widen_them(tiny):
    rows = labelled_matrix(tiny)
    joins = _outer_joins(rows._jdf.queryExecution().optimizedPlan())
    assert [join.left().output().size() < len(FEATURES) / 2 for join in joins] == [True]
    assert rows.columns == [*labels.PAIR, *[c for c in rows.columns if c not in (*labels.PAIR, labels.LABEL)], labels.LABEL]
