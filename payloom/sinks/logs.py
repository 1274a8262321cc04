"""Audit and error log tables."""

from __future__ import annotations

import traceback

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the two log tables.
AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("flattened_at", T.TimestampType()),
    T.StructField("config_name", T.StringType()),
    T.StructField("source_table", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
])
ERROR_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_timestamp", T.TimestampType()),
    T.StructField("pipeline_step", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("error_traceback", T.StringType()),
])


def _create(spark: SparkSession, table: str, schema: T.StructType) -> None:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")


def create_logs(spark: SparkSession, audit: str, errors: str) -> None:
    """Create both logs once, before any run writes to them."""
    _create(spark, audit, AUDIT_SCHEMA)
    _create(spark, errors, ERROR_SCHEMA)


def audit_row(source_rows: DataFrame, run_id: str, key: str, source: str) -> DataFrame:
    """One audit row with the newest load time among the rows that were processed."""
    return source_rows.agg(F.max("ingested_at").cast("timestamp").alias("ingested_at")).select(
        F.lit(run_id).alias("run_id"), F.current_timestamp().alias("flattened_at"),
        F.lit(key).alias("config_name"), F.lit(source).alias("source_table"), "ingested_at")


def log_audit(source_rows: DataFrame, table: str, run_id: str, key: str, source: str) -> None:
    audit_row(source_rows, run_id, key, source).write.format("parquet").mode("append").saveAsTable(table)


def log_error(spark: SparkSession, table: str, run_id: str, step: str, error: BaseException) -> None:
    text = "".join(traceback.format_exception(error))
    row = spark.createDataFrame([(run_id, step, str(error), text)],
                                "run_id string, pipeline_step string, error_message string, error_traceback string")
    row.select("run_id", F.current_timestamp().alias("run_timestamp"), "pipeline_step", "error_message",
               "error_traceback").write.format("parquet").mode("append").saveAsTable(table)
