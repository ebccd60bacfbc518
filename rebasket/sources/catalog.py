"""Find the tables under a folder, register them as views or catalog tables, and profile them."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebasket.session import shared_dir


def discover(spark: SparkSession, root: str, suffix: str = "parquet") -> dict[str, str]:
    """Table name -> path of every file or folder of this format right under ``root``.

    Spark lists the files and reads no content; the name right under the root
    is cut from the whole path of the root, and only distinct names return to
    the driver.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{suffix}")
        .load(root)
        .select("path")
    )
    # Listed paths carry a scheme, the root may not: the root's first place in the path starts it.
    name = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root.rstrip("/"))
    start = F.instr(F.col("path"), f"{name}/") + F.lit(len(name) + 1)
    below = F.expr("path").substr(start, F.length("path"))
    entry = F.substring_index(below, "/", 1).alias("entry")
    entries = [r.entry for r in files.select(entry).distinct().collect()]
    return {e.removesuffix(f".{suffix}"): f"{root.rstrip('/')}/{e}" for e in sorted(entries)}


def read_all(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet",
             **options: str) -> dict[str, DataFrame]:
    """Read each path; Parquet brings its schema, for CSV it is inferred."""
    if fmt == "csv":
        options = {"header": "true", "inferSchema": "true", **options}
    return {name: spark.read.format(fmt).options(**options).load(path) for name, path in paths.items()}


def register(tables: dict[str, DataFrame]) -> None:
    """Name the tables as views for SQL."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def profile(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: type, rows and NULLs of its table; one scan per table."""

    def columns_of(name: str, table: DataFrame) -> DataFrame:
        counts = table.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(table.columns)],
        )
        facts = [
            F.struct(F.lit(c).alias("column"), F.lit(kind).alias("type"), F.col(f"_{i}").alias("nulls"))
            for i, (c, kind) in enumerate(table.dtypes)
        ]
        return counts.select(
            F.lit(name).alias("table"), "rows", F.explode(F.array(*facts)).alias("fact")
        ).select("table", "fact.column", "fact.type", "rows", "fact.nulls")

    return reduce(DataFrame.unionAll, [columns_of(n, t) for n, t in tables.items()])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _partition_columns(spark: SparkSession, path: str, columns: list[str]) -> list[str]:
    """The columns that come from folder names: a read that ignores folders does not have them."""
    inside = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(path).columns
    return [c for c in columns if c not in inside]


def crawl(spark: SparkSession, root: str, database: str) -> dict[str, list[str]]:
    """Make or renew an external catalog table for every Parquet file or folder right under ``root``.

    Returns what changed, by table: 'created', 'partitions', 'column <name>', 'statistics'. A second
    crawl takes up new tables, new partitions and new columns; rows of older
    files are NULL there. Row counts and column statistics are computed
    for tables whose files changed, so that the planner can use them. The data stays where
    it is; whether tables outlive the session is up to its catalog.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION '{shared_dir(spark)}/{database}'")
    changed: dict[str, list[str]] = {}
    for name, path in discover(spark, root).items():
        table = f"{_quoted(database)}.{_quoted(name)}"
        found = spark.read.option("mergeSchema", "true").parquet(path)
        by = _partition_columns(spark, path, found.columns)
        notes = []
        if not spark.catalog.tableExists(f"{database}.{name}"):
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in found.schema.fields)
            cut = f" PARTITIONED BY ({', '.join(map(_quoted, by))})" if by else ""
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{cut} LOCATION '{path}'")
            notes.append("created")
        else:
            known = {c.lower() for c in spark.table(table).columns}
            new = [f for f in found.schema.fields if f.name.lower() not in known]
            if new:
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'{_quoted(f.name)} {f.dataType.simpleString()}' for f in new)})")
            notes += [f"column {f.name}" for f in new]
        if by:
            before = spark.sql(f"SHOW PARTITIONS {table}").count()
            spark.sql(f"MSCK REPAIR TABLE {table}")
            if spark.sql(f"SHOW PARTITIONS {table}").count() > before:
                notes.append("partitions")
        spark.catalog.refreshTable(f"{database}.{name}")
        bytes_now = _bytes(spark, path)
        held = spark.sql(f"SHOW TBLPROPERTIES {table}").where("key = 'crawled.bytes'").first()
        if notes or held is None or held["value"] != str(bytes_now):
            spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('crawled.bytes' = '{bytes_now}')")
            notes.append("statistics")
        if notes:
            changed[name] = notes
    return changed


def _bytes(spark: SparkSession, path: str) -> int:
    """The size of all files under a path, as Spark lists them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0] or 0
