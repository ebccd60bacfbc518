"""The whole run on a user's own tables: features, model, recommendations.

Each step stores what later steps read, under one output folder:

    order_products_prior/ purchases/ pairs/ user_features_1/ user_features_2/
    up_features/ prd_features/ features_join/ feature_store/ labelled/ model/ scores/
    evaluation/ submission/
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from rebasket.functions.decisions import SUBMISSION_THRESHOLD
from rebasket.operators.evaluate import roc_auc
from rebasket.operators.features import (
    derive_features,
    features_join,
    line_features,
    pair_summary,
    purchases,
    user_features_1,
)
from rebasket.operators.labels import (
    LABEL,
    candidate_orders,
    holdout,
    labelled,
    split_train_test,
    train_lines,
)
from rebasket.operators.model import SIMPLE_FIT, fit, score
from rebasket.operators.prior import order_products_prior
from rebasket.operators.submission import decide, submission
from rebasket.sources.files import export_csv, write_feature_store, write_prior


def _write(rows: DataFrame, path: str, *by: str) -> DataFrame:
    """Store and read back; partitioned rows are gathered by their partition first."""
    (rows.hint("rebalance", *by) if by else rows).write.mode("overwrite").partitionBy(*by).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def build_features(orders: DataFrame, order_products: DataFrame, out: str) -> DataFrame:
    """All feature tables; returns the stored joined features with the ratios.

    The prior lines are written once, clustered by user and product, and read
    once: a row per user, product and order, then a row per user and product,
    from which the three line features follow. The joined table is written once
    and read by training, scoring and the feature store.
    """
    prior = write_prior(order_products_prior(orders, order_products), f"{out}/order_products_prior")
    pairs = _write(pair_summary(_write(purchases(prior), f"{out}/purchases")), f"{out}/pairs")
    users, pair_rows, products = line_features(pairs)
    uf1 = _write(user_features_1(orders), f"{out}/user_features_1")
    uf2 = _write(users, f"{out}/user_features_2")
    up = _write(pair_rows, f"{out}/up_features")
    prd = _write(products, f"{out}/prd_features")
    matrix = _write(derive_features(features_join(up, prd, uf1, uf2)), f"{out}/features_join")
    write_feature_store(matrix, f"{out}/feature_store")
    return matrix


def train_model(matrix: DataFrame, orders: DataFrame, order_products_train: DataFrame, out: str,
                params: dict | None = None) -> tuple[PipelineModel, DataFrame]:
    """Label, hold out, fit, save; returns the model and its AUC.

    One half of the holdout tells the fit when to stop, the other half judges it.
    """
    lines = train_lines(order_products_train, orders)
    rows = _write(labelled(matrix, candidate_orders(orders), lines), f"{out}/labelled", "eval_set")
    kept, held = holdout(split_train_test(rows)[0])
    judge, stop = holdout(held, percent=50, seed=2)
    model = fit(kept, params or SIMPLE_FIT, validation=stop)
    model.write().overwrite().save(f"{out}/model")
    return model, _write(roc_auc(score(model, judge, keep=[LABEL]), "prob", LABEL), f"{out}/evaluation")


def recommend(spark: SparkSession, out: str, threshold: float = SUBMISSION_THRESHOLD) -> DataFrame:
    """Score the test rows of a finished training run; write scores and the
    per-order list, which is also returned."""
    _, test = split_train_test(spark.read.parquet(f"{out}/labelled"))
    model = PipelineModel.load(f"{out}/model")
    scores = _write(decide(score(model, test), threshold=threshold), f"{out}/scores")
    result = submission(scores)
    export_csv(result, f"{out}/submission", mode="overwrite")
    return result
