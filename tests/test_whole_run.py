from helpers import rows, same
from pyspark.sql import functions as F

from rebasket.plans.matrix import feature_matrix, labelled_matrix
from rebasket.plans.whole_run import build_features, recommend, train_model
from rebasket.sources.files import read_feature_store


def test_whole_run(spark, tiny, tmp_path):
    out = str(tmp_path)
    matrix = build_features(tiny.orders, tiny.order_products, out)
    same(matrix, feature_matrix(tiny))
    assert read_feature_store(spark, f"{out}/feature_store").count() == matrix.count()

    params = {"nrounds": 2, "max_depth": 3, "eta": 0.3}
    _, quality = train_model(matrix, tiny.orders, tiny.order_products_train, out, params)
    assert 0 <= quality.first().auc <= 1
    same(spark.read.parquet(f"{out}/labelled"), labelled_matrix(tiny))

    result = recommend(spark, out, threshold=0.05)
    test_orders = labelled_matrix(tiny).where("eval_set = 'test'").select("order_id").distinct()
    assert rows(result.select("order_id")) == rows(test_orders)
    written = spark.read.csv(f"{out}/submission", header=True, schema="order_id long, products string")
    same(written, result)
    chosen = spark.read.parquet(f"{out}/scores").where(F.col("decision") == 1)
    listed = result.where("products <> 'None'").select(F.explode(F.split("products", " ")).alias("p"))
    assert listed.count() == chosen.count()
