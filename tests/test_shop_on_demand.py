"""Shop tables come when asked for, shuffles follow the rows, joined lookups take few batches."""

import datetime
from pathlib import Path

from pyspark.sql import functions as F

from helpers import rows
from rebasket.operators.running import running_totals
from rebasket.plans import queries
from rebasket.plans.retail import shop
from rebasket.session import ROWS_PER_PARTITION, size_shuffles


def _star(spark, base):
    day = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([(1, "red nut"), (2, "blue nut")], "p_partkey long, p_name string").write.parquet(f"{base}/part.parquet")
    spark.createDataFrame(
        [(1, 1, day), (2, 1, day + datetime.timedelta(3)), (3, 2, day)],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{base}/orders.parquet")
    spark.createDataFrame(
        [(1, 1, 1, 1), (2, 1, 1, 2), (2, 2, 1, 1), (3, 2, 1, 1)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(f"{base}/lineitem.parquet")
    return str(base)


def _stored(s):
    return {p.name for p in Path(s.where.removeprefix("file:")).iterdir()}


def test_a_table_is_derived_when_asked_for(spark, tmp_path):
    s = shop(spark, _star(spark, tmp_path))
    assert rows(s.products, "product_id", "product_name") == [(1, "blue nut"), (2, "red nut")]
    assert _stored(s) == {"products"}
    assert rows(s.orders, "order_id", "eval_set", "order_number", "days_since_prior_order") == [
        (1, "prior", 1, None), (2, "train", 2, 3.0), (3, "train", 1, None)]
    assert _stored(s) == {"products", "orders"}
    assert rows(s.order_products_prior, "order_id", "product_id", "reordered") == [(1, 2, 0)]
    assert rows(s.order_products) == [(1, 2, 1, 0), (2, 1, 1, 0), (2, 2, 2, 1), (3, 1, 1, 0)]


def test_shuffles_follow_the_rows(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "12")
    size_shuffles(own, 12 * ROWS_PER_PARTITION)
    assert own.conf.get("spark.sql.shuffle.partitions") == "12"
    size_shuffles(own, 12 * ROWS_PER_PARTITION + 1)
    assert own.conf.get("spark.sql.shuffle.partitions") == "13"
    size_shuffles(own, 5)
    assert own.conf.get("spark.sql.shuffle.partitions") == "13"


def test_missing_keys_of_any_type_are_a_group_of_their_own(spark):
    day = datetime.date(1970, 1, 1)
    frame = spark.createDataFrame(
        [(day, "0", 1), (day, "0", 2), (None, "0", 1), (None, None, 1), (None, None, 2), (day, None, 3)],
        "d date, k string, at int").withColumn("one", F.lit(1))
    found = running_totals(frame, ["d", "k"], F.col("at") - 1, ["at"], ["one"])
    assert found.columns == [*frame.columns, "one_total", "one_before"]
    assert rows(found, "d", "k", "at", "one_before", "one_total") == sorted([
        (day, "0", 1, 0, 2), (day, "0", 2, 1, 2), (None, "0", 1, 0, 1),
        (None, None, 1, 0, 2), (None, None, 2, 1, 2), (day, None, 3, 0, 1)], key=repr)


def test_joined_lookups_take_few_batches_whatever_the_files(spark, tmp_path, monkeypatch):
    bodies, stream, seen = queries.request_bodies, queries.requests.request_stream, []
    monkeypatch.setattr(queries, "request_bodies", lambda s: bodies(s).repartition(16))

    def landed(frame, name):
        return frame

    def noted(spark, landing, files_per_batch=None):
        seen.append((len(list(Path(landing.removeprefix("file:")).glob("part-*"))), files_per_batch))
        return stream(spark, landing, files_per_batch)

    monkeypatch.setattr(queries, "stored", landed)
    monkeypatch.setattr(queries.requests, "request_stream", noted)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        queries.request_lookup_joined(spark, "/root/testdata/sf0.001").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(seen) == 2 and max(n for n, _ in seen) > 12
    assert all(n <= 3 * per_batch for n, per_batch in seen)
