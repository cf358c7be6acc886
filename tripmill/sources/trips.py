"""Readers of the monthly trip file and of the zone lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.sources.schema import check_columns


def read_month(spark: SparkSession, uri: str, year: int) -> DataFrame:
    """A month's Parquet file with its path in ``_source_file``; its columns are checked, its schema is its own."""
    trips = spark.read.parquet(uri)
    check_columns(trips.columns, year)
    return trips.select("*", F.col("_metadata.file_path").alias("_source_file"))


def read_zones(spark: SparkSession, uri: str) -> DataFrame:
    """The zone lookup: a CSV file with a header, read as text and cast here."""
    zones = spark.read.option("header", True).csv(uri)
    return zones.select(F.col("LocationID").try_cast("int").alias("LocationID"), "Borough", "Zone", "service_zone")
