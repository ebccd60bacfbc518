"""Every job as a query over one data folder: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebasket.functions.keys import PAIR, hash_bucket
from rebasket.functions.packing import unpack
from rebasket.functions.ratios import FEATURES
from rebasket.operators import evaluate, features, labels, model, prior, submission, tuning
from rebasket.plans.matrix import feature_matrix, joined_features, labelled_matrix
from rebasket.plans.retail import Shop, prior_with_repeats, shop
from rebasket.session import fresh_path, stored
from rebasket.sources import catalog, files
from rebasket.sources.schemas import ORDERS
from rebasket.streaming import refresh, requests

Query = Callable[[SparkSession, str], DataFrame]

# The score the checks use: one SQL can compute as well.
SCORE = "up_order_rate_since_first_order"


def _train(s: Shop) -> DataFrame:
    return labels.split_train_test(labelled_matrix(s))[0]


def _test(s: Shop) -> DataFrame:
    return labels.split_train_test(labelled_matrix(s))[1]


def _on_shop(job: Callable[[Shop], DataFrame]) -> Query:
    return lambda spark, sf_dir: job(shop(spark, sf_dir))


# --- sources and sinks -------------------------------------------------------

def profile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.profile(catalog.read_all(spark, catalog.discover(spark, sf_dir)))


def csv_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders to gzip CSV, then through the converter."""
    base = fresh_path(spark, "csv")
    shop(spark, sf_dir).orders.write.csv(f"{base}/raw", header=True, compression="gzip")
    table = files.csv_to_parquet(spark, f"{base}/raw", ORDERS, f"{base}/orders", ["eval_set"])
    return table.select("order_id", "user_id", "eval_set", "order_number", "days_since_prior_order")


def export_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined features to CSV with header and back."""
    rows = joined_features(shop(spark, sf_dir))
    path = fresh_path(spark, "features-join")
    files.export_csv(rows, path)
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    return files.read_csv(spark, path, schema)


def export_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The train rows as headerless CSV, label first, and back by position."""
    path = fresh_path(spark, "train-csv")
    files.export_training_csv(_train(shop(spark, sf_dir)), path)
    schema = "reordered int, " + ", ".join(f"{c} double" for c in FEATURES)
    return files.read_csv(spark, path, schema, header=False)


def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "store")
    return files.write_feature_store(feature_matrix(shop(spark, sf_dir)), path).drop("user_bucket")


def feature_store_unpacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = files.feature_store(feature_matrix(shop(spark, sf_dir)))
    return store.withColumns(unpack("feature", FEATURES)).drop("feature")


# --- purchase ranks with ties ------------------------------------------------

def _repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return prior_with_repeats(lineitem, shop(spark, sf_dir).orders)


def product_seq_time_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.product_seq_time(_repeats(spark, sf_dir))


def product_seq_time_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranks with the order numbers of a pair cut into small blocks."""
    return features.product_seq_time(_repeats(spark, sf_dir), orders_per_block=4)


def prd_features_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.prd_features(_repeats(spark, sf_dir))


# --- evaluation and decisions with a SQL score -------------------------------

def _decided(s: Shop) -> DataFrame:
    scored = _test(s).select("user_id", "product_id", "order_id", F.col(SCORE).alias("prob"))
    return submission.decide(scored)


def _with_gaps(rows: DataFrame) -> DataFrame:
    """The SQL score as ``prob``, for some users missing, not a number, below 0 or above 1."""
    kind = F.col("user_id") % 7
    gaps = (
        F.when(kind == 0, F.lit(None)).when(kind == 1, float("nan")).when(kind == 2, -0.2).when(kind == 3, 1.3)
        .otherwise(F.col(SCORE))
    )
    return rows.withColumn("prob", gaps.cast("double"))


def _decided_gaps(s: Shop) -> DataFrame:
    scored = _with_gaps(_test(s)).select("user_id", "product_id", "order_id", "prob")
    return submission.decide(scored).drop("prob")


SHRINKAGE = [0, 1, 2, 4]


def _shrunk(k: int):
    """The score pulled towards the product's reorder ratio by k imagined orders."""
    since_first = F.col("user_orders") - F.col("up_first_order") + F.lit(1 + k)
    return (F.col("up_orders") + F.lit(k) * F.col("prod_reorder_ratio")) / since_first


def tuning_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shrinkage grid with the AUC of each row, best first."""
    train = stored(_train(shop(spark, sf_dir)).select(
        "up_orders", "user_orders", "up_first_order", "prod_reorder_ratio", labels.LABEL), "train")
    grid = spark.createDataFrame([(i, k) for i, k in enumerate(SHRINKAGE)], "row int, k int")
    metrics = [
        evaluate.roc_auc(train.withColumn("prob", _shrunk(k)), "prob", labels.LABEL).select(
            F.lit(i).alias("row"), "auc")
        for i, k in enumerate(SHRINKAGE)
    ]
    results = tuning.tuning_results(grid, reduce(DataFrame.unionAll, metrics), ["row"], "auc")
    return results.withColumn("auc_shown", F.round("auc", 3))


def tuning_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuning.best(tuning_results(spark, sf_dir))


# --- exact counts, folds, curves and densities --------------------------------

# Margins SQL can compute as well: running sums of shares of features, exact in binary.
STEPS = {"up_orders": 1.0, "up_orders_since_last_order": -0.25, "user_orders": 0.125, "prod_orders": 0.0009765625, "up_first_order": -0.5}
LOG_FOLDS, LOG_PATIENCE = 3, 2


def _exact_holdout(s: Shop) -> DataFrame:
    """Which side every train row is on, 20,000 rows held out."""
    kept, held = labels.exact_holdout(_train(s))
    return kept.withColumn("held", F.lit(False)).unionByName(held.withColumn("held", F.lit(True)))


def _margins(s: Shop) -> DataFrame:
    """Train rows as if scored by two models of five rounds in three folds."""
    train = stored(_train(s).select(*dict.fromkeys([*PAIR, labels.LABEL, *STEPS])), "train").withColumn("own", hash_bucket(PAIR, LOG_FOLDS).cast("int"))
    steps = [F.col(c).cast("double") * F.lit(w) for c, w in STEPS.items()]
    sums = [[reduce(lambda x, y: x + y, some[:i + 1]) for i in range(len(some))] for some in (steps, steps[::-1])]
    both = train.select("own", labels.LABEL, F.posexplode(F.array(*(F.array(*m) for m in sums))).alias("row", "margins"))
    return both.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(LOG_FOLDS - 1)))).select(
        "row", "fold", (F.col("own") == F.col("fold")).alias("test"), labels.LABEL, "margins")


def round_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuning.round_auc(_margins(shop(spark, sf_dir)))


def best_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuning.least_and_best(tuning.mean_log(round_auc(spark, sf_dir)), LOG_PATIENCE)


def score_density(s: Shop) -> DataFrame:
    found = evaluate.score_density(_train(s), SCORE, labels.LABEL)
    return found.withColumns({"score": F.round("score", 6), "density": F.round("density", 6)})


def crawl_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed in two steps and crawled after each: partitions and a column come later."""
    orders = shop(spark, sf_dir).orders
    base = fresh_path(spark, "lake")
    database = base.rsplit("/", 1)[-1].replace("-", "_")
    prior_orders = orders.where(F.col("eval_set") == "prior")
    prior_orders.drop("days_since_prior_order").write.partitionBy("eval_set").parquet(f"{base}/orders")
    catalog.crawl(spark, base, database)
    orders.where(F.col("eval_set") != "prior").write.mode("append").partitionBy("eval_set").parquet(f"{base}/orders")
    catalog.crawl(spark, base, database)
    return spark.table(f"{database}.orders").select(
        "order_id", "user_id", "eval_set", "order_number", "days_since_prior_order")


# --- models ------------------------------------------------------------------
#
# The tables' own labels do not follow from the features, so these jobs run on a planted
# label, which any sound model finds and SQL can state.

def _planted(s: Shop) -> tuple[DataFrame, DataFrame]:
    """(train rows with the planted label, test rows)."""
    rows = stored(labelled_matrix(s), "labelled")
    train, test = labels.split_train_test(rows)
    return train.withColumn(labels.LABEL, (F.col("up_orders") >= 2).cast("int")), test


def fit_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit all published rounds on the train rows, score the test rows, decide."""
    train, test = _planted(shop(spark, sf_dir))
    return submission.decide(model.score(model.fit(train, model.SIMPLE_FIT), test)).drop("prob")


def model_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC of the model's own scores on the rows it was fitted on and on those held out."""
    train, _ = _planted(shop(spark, sf_dir))
    kept, held = labels.exact_holdout(train, 1000)
    fitted = model.fit(kept, model.SIMPLE_FIT)
    both = kept.withColumn("side", F.lit("train")).unionByName(held.withColumn("side", F.lit("held")))
    measured = evaluate.roc_auc(model.score(fitted, both, ["side", labels.LABEL]), "prob", labels.LABEL, by=["side"])
    return measured.select("side", "positives", "negatives", (F.col("auc") > 0.9).alias("good"))


def fit_with_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model cut to its best round decides as the planted rule does."""
    train, test = _planted(shop(spark, sf_dir))
    kept, held = labels.holdout(train)
    fitted = model.fit(kept, model.SIMPLE_FIT, validation=held, patience=5)
    return submission.decide(model.score(fitted, test)).select("user_id", "product_id", "order_id", "decision")


def _marked(results: DataFrame, metric: str, good) -> DataFrame:
    return results.withColumn("good", good).drop(metric)


def tune_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _planted(shop(spark, sf_dir))
    return _marked(tuning.tune_grid(train)[1], "auc", F.col("auc") > 0.9)


def tune_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of the published grid over its first 20 rounds."""
    train, _ = _planted(shop(spark, sf_dir))
    log = tuning.tune_rounds(train, shared=tuning.GRID_SHARED | {"nrounds": 20})
    return log.select("row", "fold", "round", (F.col("test_auc") > 0.9).alias("test_good"), (F.col("train_auc") > 0.9).alias("train_good"))


def _in_ranges():
    return reduce(lambda x, y: x & y, [F.col(n).between(low, high) for n, (low, high) in tuning.RANGES.items()])


def tune_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, held = labels.holdout(_planted(shop(spark, sf_dir))[0])
    results = tuning.tune_random(kept, held, shared=model.BASE_FIT | {"validation_tol": 0.0})[1]
    return results.select("row", _in_ranges().alias("in_ranges"), (F.col("rmse") < 0.4).alias("good"))


def tune_model_based(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials of 30 rounds each."""
    kept, held = labels.holdout(_planted(shop(spark, sf_dir))[0])
    results = tuning.tune_model_based(kept, held, shared=model.BASE_FIT | {"nrounds": 30})[1]
    return results.select(
        "row", _in_ranges().alias("in_ranges"), F.col("best_round").between(1, 30).alias("round_kept"), (F.col("rmse") < 0.4).alias("good"))


# --- requests and refresh ----------------------------------------------------

def _third(landed: DataFrame) -> int:
    """A third of the landed files, so that a stream over them takes three batches."""
    files_landed = landed.select(F.input_file_name().alias("f")).distinct().count()
    return max(1, -(-files_landed // 3))


def request_bodies(s: Shop) -> DataFrame:
    """A request per line of the orders to predict, some of pairs never bought
    before, and unreadable ones: a word as user, or no product."""
    open_orders = s.orders.where(F.col("eval_set") != "prior")
    lines = s.order_products.join(open_orders, "order_id")
    known = lines.select(F.concat_ws(",", "user_id", "product_id").alias("body"))
    empty = s.orders.join(s.order_products, "order_id", "left_anti")
    words = empty.select(F.concat_ws(",", "eval_set", "user_id").alias("body"))
    short = empty.select(F.col("user_id").cast("string").alias("body"))
    return known.unionAll(words).unionAll(short)


def request_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = shop(spark, sf_dir)
    arrived = stored(request_bodies(s), "requests")
    found = requests.lookup(arrived, files.feature_store(feature_matrix(s)))
    return _unpacked(found)


def _unpacked(found: DataFrame) -> DataFrame:
    return found.withColumns(unpack("feature", FEATURES)).drop("feature")


def request_lookup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookups, the requests arriving as text files."""
    s = shop(spark, sf_dir)
    base = fresh_path(spark, "requests")
    store = files.write_feature_store(feature_matrix(s), f"{base}/store")
    request_bodies(s).write.text(f"{base}/landing")
    arriving = requests.request_stream(spark, f"{base}/landing", _third(spark.read.text(f"{base}/landing")))
    requests.lookup_stream(arriving, store, f"{base}/out", f"{base}/state").awaitTermination()
    return _unpacked(spark.read.parquet(f"{base}/out").drop("batch_id"))


def request_lookup_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookups from the store written by user bucket."""
    s = shop(spark, sf_dir)
    store = files.write_feature_store(feature_matrix(s), fresh_path(spark, "store"))
    return _unpacked(requests.lookup_stored(stored(request_bodies(s), "requests"), store))


def request_lookup_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookups as a stream joined with the store, in two runs of one checkpoint."""
    s = shop(spark, sf_dir)
    base = fresh_path(spark, "joined")
    store = files.write_feature_store(feature_matrix(s), f"{base}/store")
    bodies = stored(request_bodies(s), "requests")
    for part in (0, 1):
        bodies.where(F.pmod(F.xxhash64("body"), F.lit(2)) == part).write.mode("append").text(f"{base}/landing")
        arriving = requests.request_stream(spark, f"{base}/landing", _third(spark.read.text(f"{base}/landing")))
        requests.lookup_joined(arriving, store, f"{base}/out", f"{base}/state").awaitTermination()
    return _unpacked(spark.read.parquet(f"{base}/out"))


def _planted_model(s: Shop):
    return model.fit(_planted(s)[0], model.SIMPLE_FIT)


def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, store the features, answer the requests as a stream."""
    s = shop(spark, sf_dir)
    base = fresh_path(spark, "answers")
    fitted = _planted_model(s)
    store = files.write_feature_store(feature_matrix(s), f"{base}/store")
    request_bodies(s).write.text(f"{base}/landing")
    arriving = requests.request_stream(spark, f"{base}/landing", _third(spark.read.text(f"{base}/landing")))
    requests.score_stream(arriving, store, fitted, f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("batch_id", "prob")


def score_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that carry the 18 values: those of all test rows, some cut short, some with a word."""
    s = shop(spark, sf_dir)
    packed = files.feature_store(stored(_test(s), "test")).select("user_id", F.col("feature").alias("body"))
    short = packed.where(F.col("user_id") % 3 == 0).select(F.expr("substring_index(body, ',', 17)").alias("body"))
    word = packed.where(F.col("user_id") % 3 == 1).select(F.concat(F.lit("many,"), F.expr("substring_index(body, ',', -17)")).alias("body"))
    bodies = packed.select("body").unionAll(short).unionAll(word)
    return requests.score_vectors(bodies, _planted_model(s)).drop("prob")


def refresh_on_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines landed as files, refreshed in three micro-batches; the joined features."""
    s = shop(spark, sf_dir)
    base = fresh_path(spark, "refresh")
    _land(prior.orders_with_lines(s.orders, s.order_products, eval_set=None), f"{base}/landing")
    _arrive(spark, base, _third(spark.read.parquet(f"{base}/landing")))
    return refresh.read_joined(spark, f"{base}/out")


def _land(rows: DataFrame, landing: str) -> None:
    """Files of whole orders."""
    rows.hint("rebalance", "order_id").write.mode("append").parquet(landing)


def _arrive(spark: SparkSession, base: str, files_per_batch: int | None = None) -> None:
    refresh.refresh_on_arrival(
        spark, f"{base}/landing", f"{base}/state", f"{base}/out", buckets=16, files_per_batch=files_per_batch).awaitTermination()


def refresh_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth user's orders land twice, in one batch and again in a later one, around a compaction."""
    s = shop(spark, sf_dir)
    base = fresh_path(spark, "redelivered")
    landed = prior.orders_with_lines(s.orders, s.order_products, eval_set=None)
    again = landed.where(F.col("user_id") % 5 == 0)
    _land(landed, f"{base}/landing")
    _land(again, f"{base}/landing")
    _arrive(spark, base)
    refresh.compact(spark, f"{base}/out", buckets=16)
    _land(again, f"{base}/landing")
    _arrive(spark, base)
    return refresh.read_joined(spark, f"{base}/out")


def refresh_closed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's last prior order lands as the open one first, and lands again closed with the next one."""
    s = shop(spark, sf_dir)
    base = fresh_path(spark, "closed")
    landed = prior.orders_with_lines(s.orders, s.order_products, eval_set=None)
    closing = s.orders.where(F.col("eval_set") == "prior").groupBy("user_id").agg(F.max("order_number").alias("closing"))
    dated = landed.join(closing, "user_id", "left")
    last = F.col("order_number") == F.col("closing")
    before = dated.where(F.col("eval_set") == "prior").withColumn("eval_set", F.when(last, "train").otherwise(F.col("eval_set")))
    _land(before.select(landed.columns), f"{base}/landing")
    _arrive(spark, base)
    _land(dated.where(last | (F.col("eval_set") != "prior")).select(landed.columns), f"{base}/landing")
    _arrive(spark, base)
    return refresh.read_joined(spark, f"{base}/out")


def queries() -> dict[str, Query]:
    return {
        "profile_tables": profile_tables,
        "csv_to_parquet": csv_to_parquet,
        "products": _on_shop(lambda s: s.products),
        "orders_derived": _on_shop(lambda s: s.orders),
        "order_products_derived": _on_shop(lambda s: s.order_products),
        "orders_with_lines": _on_shop(lambda s: prior.orders_with_lines(s.orders, s.order_products)),
        "orders_with_lines_preview": _on_shop(lambda s: prior.preview(
            prior.orders_with_lines(s.orders, s.order_products), ["order_id", "product_id"], 20)),
        "order_products_prior": _on_shop(lambda s: prior.order_products_prior(s.orders, s.order_products)),
        "user_features_1": _on_shop(lambda s: features.user_features_1(s.orders)),
        "user_features_2": _on_shop(lambda s: features.user_features_2(s.order_products_prior)),
        "up_features": _on_shop(lambda s: features.up_features(s.order_products_prior)),
        "product_seq_time": _on_shop(lambda s: features.product_seq_time(s.order_products_prior)),
        "product_seq_time_ties": product_seq_time_ties,
        "product_seq_time_hot": product_seq_time_hot,
        "prd_features": _on_shop(lambda s: features.prd_features(s.order_products_prior)),
        "prd_features_ties": prd_features_ties,
        "features_join": _on_shop(joined_features),
        "feature_matrix": _on_shop(feature_matrix),
        "train_lines": _on_shop(lambda s: labels.train_lines(s.order_products_train, s.orders)),
        "candidate_orders": _on_shop(lambda s: labels.candidate_orders(s.orders)),
        "labelled": _on_shop(labelled_matrix),
        "train_rows": _on_shop(_train),
        "test_rows": _on_shop(_test),
        "holdout_fit": _on_shop(lambda s: labels.holdout(_train(s))[0]),
        "holdout_validation": _on_shop(lambda s: labels.holdout(_train(s))[1]),
        "sample": _on_shop(lambda s: labels.sample(_train(s))),
        "roc_auc": _on_shop(lambda s: evaluate.roc_auc(_train(s), SCORE, labels.LABEL)),
        "roc_curve": _on_shop(lambda s: evaluate.roc_curve(_train(s), SCORE, labels.LABEL)),
        "pr_curve": _on_shop(lambda s: evaluate.pr_curve(_train(s), SCORE, labels.LABEL)),
        "score_distribution": _on_shop(
            lambda s: evaluate.score_distribution(_train(s), SCORE, labels.LABEL)),
        "roc_auc_gaps": _on_shop(lambda s: evaluate.roc_auc(_with_gaps(_train(s)), "prob", labels.LABEL)),
        "score_distribution_gaps": _on_shop(
            lambda s: evaluate.score_distribution(_with_gaps(_train(s)), "prob", labels.LABEL)),
        "decide_gaps": _on_shop(_decided_gaps),
        "decide": _on_shop(_decided),
        "submission": _on_shop(lambda s: submission.submission(_decided(s))),
        "tuning_results": tuning_results,
        "tuning_best": tuning_best,
        "export_features": export_features,
        "export_training": export_training,
        "feature_store": feature_store,
        "feature_store_unpacked": feature_store_unpacked,
        "fit_and_score": fit_and_score,
        "fit_with_patience": fit_with_patience,
        "model_auc": model_auc,
        "tune_grid": tune_grid,
        "tune_rounds": tune_rounds,
        "tune_random": tune_random,
        "tune_model_based": tune_model_based,
        "round_auc": round_auc,
        "best_rounds": best_rounds,
        "sample_exact": _on_shop(lambda s: labels.exact_sample(_train(s))),
        "holdout_exact": _on_shop(_exact_holdout),
        "folds": _on_shop(lambda s: labels.label_folds(_train(s))),
        "score_density": _on_shop(score_density),
        "pr_interpolated": _on_shop(lambda s: evaluate.pr_interpolated(_train(s), SCORE, labels.LABEL)),
        "pr_auc": _on_shop(lambda s: evaluate.pr_auc(_train(s), SCORE, labels.LABEL)),
        "crawl_again": crawl_again,
        "request_lookup": request_lookup,
        "request_lookup_stored": request_lookup_stored,
        "request_lookup_joined": request_lookup_joined,
        "score_vectors": score_vectors,
        "request_lookup_stream": request_lookup_stream,
        "score_requests": score_requests,
        "refresh_on_arrival": refresh_on_arrival,
        "refresh_redelivered": refresh_redelivered,
        "refresh_closed_orders": refresh_closed_orders,
    }
