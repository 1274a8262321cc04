"""Which loads of a source were processed, so that rows which arrive late are loaded too.

A high-water mark forgets rows whose load time lies below it. The ledger has
one row per key, source id and load time; what a source has and the ledger
lacks is due, wherever it lies in time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.operators.frontier import kept_level
from payloom.sinks.tables import write_table

LOADED = ("ingested_from", "ingested_at")
SCHEMA = "audit_key string, ingested_from string, ingested_at timestamp"


def create_ledger(spark: SparkSession, ledger: str) -> None:
    if not spark.catalog.tableExists(ledger):
        write_table(spark.createDataFrame([], SCHEMA), ledger, load="created")


def _same() -> Column:
    return F.col("ingested_from").eqNullSafe(F.col("__from")) & F.col("ingested_at").eqNullSafe(F.col("__at"))


def _renamed(loads: DataFrame) -> DataFrame:
    return loads.select(F.col("ingested_from").alias("__from"), F.col("ingested_at").alias("__at"))


def new_loads(bronze: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """(ingested_from, ingested_at) of the source's loads that the ledger lacks for a key.

    Reads two columns of the source, one row per load after the map side, and
    joins these with the ledger: the join's exact, and Spark puts a Bloom filter of the smaller side before it where that pays.
    """
    loads = bronze.select("ingested_from", F.col("ingested_at").cast("timestamp").alias("ingested_at")).distinct()
    return loads.join(_renamed(ledger.filter(F.col("audit_key") == key)), _same(), "left_anti")


def due(bronze: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """The loads that are due, fixed in the shared folder: all tables of a run see the same ones, whatever arrives meanwhile."""
    return kept_level(new_loads(bronze, ledger, key), "due")


def rows_of(bronze: DataFrame, loads: DataFrame) -> DataFrame:
    """The source's rows of the given loads."""
    return bronze.join(_renamed(loads), _same(), "left_semi")


def note(loads: DataFrame, ledger: str, key: str, load: str) -> int:
    """Enter loads as processed. Noting one load again leaves no second rows."""
    return write_table(loads.select(F.lit(key).alias("audit_key"), *LOADED), ledger, load=load)
