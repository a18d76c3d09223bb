"""Readers and writers for files and catalog tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from holdfast.sources.schemas import SOURCE_TABLES, schema_of


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and NULL are one notion of missing here; keep NULL only."""
    return df.select(
        *[
            F.when(~F.isnan(_quoted(f.name)), F.col(_quoted(f.name))).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(_quoted(f.name))
            for f in df.schema.fields
        ]
    )


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_source_tables(
    spark: SparkSession, data_dir: str, schemas: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """Parquet where present, CSV where it is not, and a table that has neither is left out."""
    found = {}
    for name, ddl in (schemas or SOURCE_TABLES).items():
        schema = schema_of(ddl)
        for reader, path in (
            (read_parquet, f"{data_dir}/{name}.parquet"),
            (read_csv, f"{data_dir}/{name}.csv"),
        ):
            if _exists(spark, path):
                found[name] = nan_to_null(reader(spark, path, schema))
                break
    return found


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Whole catalog table, DATE columns widened to timestamps."""
    df = spark.read.table(table)
    return df.select(
        *[
            F.col(_quoted(f.name)).cast("timestamp").alias(f.name)
            if isinstance(f.dataType, T.DateType)
            else F.col(_quoted(f.name))
            for f in df.schema.fields
        ]
    )


def run_sql(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """A SQL query over catalog tables and the frames passed by name (``{name}`` in the text)."""
    return spark.sql(sql, **frames)


def table_info(spark: SparkSession, table: str) -> DataFrame:
    """One row: name, column count and verified row count."""
    df = spark.read.table(table)
    return df.agg(F.count(F.lit(1)).alias("num_rows")).select(
        F.lit(table).alias("table"), F.lit(len(df.columns)).alias("num_columns"), "num_rows"
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_json_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def load_table(df: DataFrame, table: str, write_mode: str = "truncate") -> int:
    """Write with disposition truncate, append or empty; returns the row count read back."""
    spark = df.sparkSession
    if write_mode == "truncate":
        df.write.mode("overwrite").saveAsTable(table)
    elif write_mode == "append":
        df.write.mode("append").saveAsTable(table)
    elif write_mode == "empty":
        if spark.catalog.tableExists(table) and not spark.read.table(table).isEmpty():
            raise ValueError(f"table {table} already holds rows")
        df.write.mode("append").saveAsTable(table)
    else:
        raise ValueError(f"unknown write mode {write_mode!r}")
    return spark.read.table(table).count()


def load_tables(spark: SparkSession, data_dir: str, targets: dict[str, str]) -> DataFrame:
    """Load ``<data_dir>/<name>.parquet`` into each target table; a missing file raises."""
    for name in targets:
        if not _exists(spark, f"{data_dir}/{name}.parquet"):
            raise FileNotFoundError(f"{data_dir}/{name}.parquet")
    counts = [
        (table, load_table(read_parquet(spark, f"{data_dir}/{name}.parquet"), table))
        for name, table in targets.items()
    ]
    return spark.createDataFrame(counts, "table string, rows bigint")


def range_bucket(column: str, step: int):
    """Lower end of the integer range a value falls in, for range-partitioned layouts."""
    return (F.floor(F.col(column) / step) * step).cast("bigint")


def write_clustered(
    df: DataFrame,
    path: str,
    partition: str,
    bucket,
    cluster_by: Iterable[str] = (),
    mode: str = "overwrite",
    rows_per_file: int = 5_000_000,
) -> None:
    """Folder per bucket, rows ordered by the cluster columns inside each file.

    Rows are dealt out by ranges of bucket, cluster columns and a hash of the row, so a hot bucket is
    spread over as many writers as its share of the rows asks for.
    """
    cluster = [F.col(_quoted(c)) for c in cluster_by]
    laid_out = df.withColumn(partition, bucket)
    row = F.xxhash64(*[F.col(_quoted(c)) for c in df.columns])
    (
        laid_out.repartitionByRange(F.col(_quoted(partition)), *cluster, row)
        .sortWithinPartitions(F.col(_quoted(partition)), *cluster)
        .write.mode(mode)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(partition)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Catalog table in buckets by key, one file each, sorted by the key.

    Tables with the same number of buckets are joined, and grouped, by the key without a shuffle; Spark
    still runs a sort over each bucket, which finds the rows in order. Rows
    of one key lie in one bucket, so a key with a large share of the rows should be salted in the join instead.
    """
    (
        df.repartition(buckets, F.col(_quoted(key)))
        .sortWithinPartitions(F.col(_quoted(key)))
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException:
        return False
