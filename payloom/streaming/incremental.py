"""The incremental load as a stream: the checkpoint takes the place of the watermark columns."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from payloom.plans.spec import Pipeline
from payloom.plans.tables import Shapes, pipeline_tables, table_name
from payloom.sinks import logs
from payloom.sinks.tables import write_all

BRONZE_SCHEMA = T.StructType([
    T.StructField("ingested_from", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("l0payload", T.VariantType()),
    T.StructField("l1element", T.StringType()),
    T.StructField("payload", T.VariantType()),
])


def load_stream(stream: DataFrame, pipe: Pipeline, checkpoint: str, shapes: Shapes | None = None, audit: str | None = None) -> None:
    """Flatten everything a bronze stream has not delivered yet, then stop.

    Batches go through the sink of batch runs: each is a load of its own, so
    one that is run again after a lost driver or executor leaves no duplicates,
    and tables take on new fields and wider types as batches bring them. Pass
    ``shapes`` to skip inference per batch, ``audit`` to note each batch there
    once its tables are written.
    """
    name = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, batch_id: int) -> None:
        # Every table reads the batch; kept, the source files are read once.
        batch.persist()
        try:
            tables = pipeline_tables(pipe, batch, shapes, spread=pipe.spread)
            key = f"stream-{name}@{batch_id}"
            write_all({table_name(pipe, suffix): df for suffix, df in tables.items()}, pipe.source, "append", key)
            if audit:
                logs.log_audit(batch, audit, key, pipe.name, pipe.source)
        finally:
            batch.unpersist()

    query = (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def run_available(spark: SparkSession, pipe: Pipeline, source: str, checkpoint: str,
                  shapes: Shapes | None = None, files_per_batch: int | None = None, audit: str | None = None) -> None:
    """``load_stream`` over the bronze Parquet files under ``source`` that arrived since the last call."""
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    load_stream(reader.parquet(source), pipe, checkpoint, shapes, audit)


def drop_repeats(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First arrival per key within ``delay`` of event time, with bounded state."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
