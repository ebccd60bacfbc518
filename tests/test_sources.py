import pytest
from helpers import rows, same
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rebasket.functions.keys import user_bucket
from rebasket.functions.packing import pack, request_key, unpack
from rebasket.functions.ratios import FEATURES
from rebasket.plans.matrix import feature_matrix, joined_features
from rebasket.session import fresh_path
from rebasket.sources import catalog, files
from rebasket.sources.schemas import ORDERS


def test_profile_finds_reads_and_counts(spark, tmp_path):
    one = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    one.write.parquet(str(tmp_path / "store" / "one"))
    one.repartition(3).write.parquet(str(tmp_path / "store" / "two.parquet"))
    paths = catalog.discover(spark, str(tmp_path / "store"))
    assert set(paths) == {"one", "two"}
    tables = catalog.read_all(spark, paths)
    facts = rows(catalog.profile(tables))
    assert facts == [("one", "a", "int", 2, 0), ("one", "b", "string", 2, 1),
                     ("two", "a", "int", 2, 0), ("two", "b", "string", 2, 1)]
    catalog.register(tables)
    assert spark.sql("select count(*) from two").first()[0] == 2


def test_csv_schema_is_inferred_when_asked(spark, tmp_path):
    spark.createDataFrame([(1, 2.5)], "a int, b double").write.csv(str(tmp_path / "t"), header=True)
    table = catalog.read_all(spark, {"t": str(tmp_path / "t")}, "csv")["t"]
    assert table.dtypes == [("a", "int"), ("b", "double")]


def test_gzip_csv_becomes_partitioned_parquet(spark, tiny, tmp_path):
    orders = tiny.orders
    orders.coalesce(1).write.csv(str(tmp_path / "raw"), header=True, compression="gzip")
    table = files.csv_to_parquet(spark, str(tmp_path / "raw"), ORDERS, str(tmp_path / "out"), ["eval_set"])
    same(table, orders)
    assert sorted(p.name for p in (tmp_path / "out").glob("eval_set=*")) == [
        "eval_set=prior", "eval_set=test", "eval_set=train"]
    plan = table.where("eval_set = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(eval_set" in plan


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("order_id,user_id,eval_set,order_number,days_since_prior_order\nx,1,prior,1,\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, str(tmp_path / "bad.csv"), ORDERS).collect()


def test_export_modes(spark, tiny, tmp_path):
    joined = joined_features(tiny)
    path = str(tmp_path / "joined")
    files.export_csv(joined, path)
    with pytest.raises(AnalysisException, match="(?i)already exists"):
        files.export_csv(joined, path)
    files.export_csv(joined, path, mode="overwrite")
    schema = ", ".join(f"{c} {t}" for c, t in joined.dtypes)
    same(files.read_csv(spark, path, schema), joined)


def test_training_export_is_label_first_and_test_export_has_no_label(spark, tmp_path):
    frame = spark.createDataFrame([(1, *[float(i) for i in range(18)])], ["reordered", *FEATURES])
    files.export_training_csv(frame, str(tmp_path / "train"))
    assert spark.read.text(str(tmp_path / "train")).first()[0] == "1," + ",".join(
        str(float(i)) for i in range(18))
    files.export_training_csv(frame.drop("reordered"), str(tmp_path / "test"))
    assert spark.read.text(str(tmp_path / "test")).first()[0].startswith("0.0,1.0,")


def test_packed_vector_keeps_positions(spark):
    frame = spark.createDataFrame([(1, None, 2.5), (None, None, None)], "a int, b double, c double")
    packed = frame.select(pack(["a", "b", "c"]).alias("feature"))
    assert rows(packed) == [(",,",), ("1,,2.5",)]
    back = packed.select(*[c.alias(n) for n, c in unpack("feature", ["a", "b", "c"]).items()])
    assert rows(back) == [(1.0, None, 2.5), (None, None, None)]


def test_request_keys(spark):
    frame = spark.createDataFrame([("12,7",), ("abc,1",), ("7",), (" 3 , 4 ",), ("",)], "body string")
    keys = frame.select("body", request_key("body", 0), request_key("body", 1))
    assert {r[0]: (r[1], r[2]) for r in keys.collect()} == {
        "12,7": (12, 7), "abc,1": (None, 1), "7": (7, None), " 3 , 4 ": (3, 4), "": (None, None)}


def test_feature_store_lookup_reads_few_buckets(spark, tiny):
    matrix = feature_matrix(tiny)
    store = files.write_feature_store(matrix, fresh_path(spark, "store"), buckets=8)
    assert store.count() == matrix.count()
    user = matrix.first().user_id
    bucket = spark.range(1).select(F.lit(user).alias("user_id")).select(user_bucket(8)).first()[0]
    one = store.where((F.col("user_bucket") == bucket) & (F.col("user_id") == user))
    assert one.count() == matrix.where(F.col("user_id") == user).count()
    assert "PartitionFilters: [isnotnull(user_bucket" in one._jdf.queryExecution().executedPlan().toString()


def test_scores_without_header(spark, tmp_path):
    (tmp_path / "scores.csv").write_text("0.25\n0.5\n")
    assert rows(files.read_scores(spark, str(tmp_path / "scores.csv"))) == [(0.25,), (0.5,)]


def test_swapped_header_fails(spark, tmp_path):
    spark.createDataFrame([(1, 2, "prior", 3, 4.0)], "user_id long, order_id long, eval_set string, order_number long, days double").write.csv(
        str(tmp_path / "swapped"), header=True)
    with pytest.raises(Exception, match="CSV header|headers"):
        files.read_csv(spark, str(tmp_path / "swapped"), ORDERS).collect()


def test_root_name_again_below_the_root(spark, tmp_path):
    root = tmp_path / "shopx"
    spark.range(3).write.parquet(str(root / "orders" / "shopx" / "part=1"))
    assert catalog.discover(spark, str(root)) == {"orders": f"{root}/orders"}


def tables_of(spark, database):
    return {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()}


def test_a_second_crawl_takes_up_what_is_new(spark, tmp_path):
    root = str(tmp_path / "lake")
    first = spark.range(40).selectExpr("id AS a", "id % 2 AS part")
    first.write.partitionBy("part").parquet(f"{root}/one")
    assert catalog.crawl(spark, root, "crawled") == {"one": ["created", "partitions", "statistics"]}
    assert catalog.crawl(spark, root, "crawled") == {}
    more = spark.range(10).selectExpr("id AS a", "cast(id AS double) AS b", "7L AS part")
    more.write.mode("append").partitionBy("part").parquet(f"{root}/one")
    spark.range(3).write.parquet(f"{root}/two")
    changed = catalog.crawl(spark, root, "crawled")
    assert changed == {"one": ["column b", "partitions", "statistics"], "two": ["created", "statistics"]}
    table = spark.table("crawled.one")
    assert rows(table.where("part = 7").select("a", "b")) == sorted(((i, float(i)) for i in range(10)), key=repr)
    assert table.where("b is null").count() == 40 and table.count() == 50
    plan = table.where("part = 7")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    facts = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED crawled.one").collect()}
    assert "50 rows" in facts["Statistics"] and facts["Type"] == "EXTERNAL"
    spark.sql("DROP TABLE crawled.one")
    assert spark.read.parquet(f"{root}/one").count() == 50


def test_statistics_change_a_join(spark, tmp_path):
    root = str(tmp_path / "lake")
    spark.range(200_000).selectExpr("id AS k", "id % 1000 AS v", "uuid() AS pad").write.parquet(f"{root}/big")
    spark.range(200_000).selectExpr("id AS k", "id AS w", "uuid() AS pad").write.parquet(f"{root}/other")
    names = ("spark.sql.cbo.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}

    def plan():
        few = spark.table("measured.other").where("w < 100").select("k", "w")
        joined = spark.table("measured.big").join(few, "k")
        return joined._jdf.queryExecution().executedPlan().toString()

    catalog.crawl(spark, root, "measured")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.cbo.enabled", "false")
        assert "BroadcastHashJoin" not in plan()
        spark.conf.set("spark.sql.cbo.enabled", "true")
        assert "BroadcastHashJoin" in plan()
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
