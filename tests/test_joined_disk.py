"""Joined lookups leave no shuffle files behind."""

import pytest

from rebasket.functions.packing import pack
from rebasket.functions.ratios import FEATURES
from rebasket.streaming import requests
from rebasket.streaming.requests import SHUFFLES_GO, lookup_joined, request_stream


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


@pytest.fixture
def shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_shuffle_files_of_a_batch_go_with_it(spark, tmp_path, shuffled):
    rows = [(u, p, *[float(u + p)] * len(FEATURES)) for u in range(20) for p in range(5)]
    store = spark.createDataFrame(rows, "user_id long, product_id long, " + ", ".join(f"{c} double" for c in FEATURES))
    store.select("user_id", "product_id", pack(FEATURES).alias("feature")).write.parquet(f"{tmp_path}/store")
    asked = ["1,2", "1,2", "19,4", "77,1", "many,1", "3", "5,0", ""]
    spark.createDataFrame([(a,) for a in asked], "body string").repartition(4).write.text(f"{tmp_path}/landing")
    before = shuffle_files(spark)
    query = lookup_joined(request_stream(spark, f"{tmp_path}/landing", 1), spark.read.parquet(f"{tmp_path}/store"), f"{tmp_path}/out", f"{tmp_path}/state")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 1
    assert not shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLES_GO) == "false"
    found = spark.read.parquet(f"{tmp_path}/out").collect()
    status = {r.body: r.status for r in found}
    assert len(found) == len(asked) and status["1,2"] == status["19,4"] == status["5,0"] == "ok"
    assert status["77,1"] == "unknown_key" and status["many,1"] == status["3"] == status[""] == "bad_request"
    plain = requests.lookup(spark.createDataFrame([(a,) for a in asked], "body string"), spark.read.parquet(f"{tmp_path}/store"))
    assert sorted((r.body, r.status, r.feature) for r in found if r.feature) == sorted((r.body, r.status, r.feature) for r in plain.collect() if r.feature)
