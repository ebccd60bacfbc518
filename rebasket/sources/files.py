"""CSV in, Parquet and CSV out.

Sinks write one file per task. A result is never pulled into one task to get
one file; readers take the folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rebasket.functions.keys import user_bucket
from rebasket.functions.packing import pack
from rebasket.functions.ratios import FEATURES

STORE_BUCKETS = 64
STORE = "user_id bigint, product_id bigint, feature string, user_bucket int"


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """Plain or gzip CSV under a fixed schema; a malformed row fails the job.

    So does a header whose names are not the schema's, in its order: columns are
    never taken by position from a file that names them.
    """
    return spark.read.csv(path, schema=schema, header=header, mode="FAILFAST", enforceSchema=not header)


def csv_to_parquet(spark: SparkSession, path: str, schema: str, out: str,
                   partition_by: list[str] | None = None) -> DataFrame:
    """Convert CSV to Parquet and return the written table.

    A gzip file cannot be split, so its rows are spread over the tasks right
    after the scan. The rebalance also gathers each partition value into files
    of the advisory size and splits a large value over several tasks.
    """
    by = partition_by or []
    rows = read_csv(spark, path, schema).hint("rebalance", *by)
    rows.write.mode("overwrite").partitionBy(*by).parquet(out)
    return spark.read.schema(schema).parquet(out)


def write_prior(prior: DataFrame, out: str) -> DataFrame:
    """Store the prior lines as a Parquet table, clustered by user for the feature jobs.

    The lines of a pair meet in one scan task, so the partial aggregates of the
    feature jobs shuffle about one row per pair instead of one per line. The
    rebalance splits a user, or copies of one line, that exceed a file.
    """
    order = ["user_id", "product_id", "order_number"]
    clustered = prior.hint("rebalance", "user_id").sortWithinPartitions(*order)
    clustered.write.mode("overwrite").parquet(out)
    return prior.sparkSession.read.schema(prior.schema).parquet(out)


def export_csv(rows: DataFrame, path: str, mode: str = "errorifexists", header: bool = True) -> None:
    """CSV folder with a header in each file; by default an existing path is an error."""
    rows.write.mode(mode).csv(path, header=header)


def export_training_csv(rows: DataFrame, path: str, label: str = "reordered",
                        features: list[str] = FEATURES, mode: str = "overwrite") -> None:
    """Headerless CSV, label first, then the model vector; unlabelled rows have features only."""
    columns = [label, *features] if label in rows.columns else features
    rows.select(*columns).write.mode(mode).csv(path, header=False)


def feature_store(rows: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Key columns and the packed model vector, for lookups by user and product."""
    return rows.select("user_id", "product_id", pack(features).alias("feature"))


def write_feature_store(rows: DataFrame, path: str, features: list[str] = FEATURES,
                        buckets: int = STORE_BUCKETS) -> DataFrame:
    """Store by user bucket: a lookup reads only the buckets its users fall in."""
    store = feature_store(rows, features).withColumn("user_bucket", user_bucket(buckets))
    store.hint("rebalance", "user_bucket").write.mode("overwrite").partitionBy("user_bucket").parquet(path)
    return read_feature_store(rows.sparkSession, path)


def read_feature_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE).parquet(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Headerless one-column score files."""
    return spark.read.csv(path, schema="prob double", header=False, mode="FAILFAST")
