"""Bronze: source rows as they came, with where they came from and who they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import identity
from tripmill.sources.files import SourceFile


def with_identity(trips: DataFrame, year: Column | int) -> DataFrame:
    """row_id, business_trip_key and identity_policy_version, under each row's policy. No shuffle."""
    return with_business(with_row_id(trips, year), year)


def with_row_id(trips: DataFrame, year: Column | int) -> DataFrame:
    if identity.FEE_COLUMN not in trips.columns and not (isinstance(year, int) and year < identity.FEE_YEAR):
        trips = trips.withColumn(identity.FEE_COLUMN, F.lit(None).cast("double"))
    return trips.withColumn("row_id", identity.row_id(year, dict(trips.dtypes)))


def with_business(trips: DataFrame, year: Column | int) -> DataFrame:
    """business_trip_key and identity_policy_version."""
    return trips.withColumns({"business_trip_key": identity.business_key(dict(trips.dtypes)), "identity_policy_version": identity.policy_column(year)})


def with_source(trips: DataFrame, source: SourceFile) -> DataFrame:
    """The seven columns that say which file and run a row is of."""
    given = {
        "_source_uri": F.lit(source.uri),
        "_source_year": F.lit(source.year),
        "_source_month": F.lit(source.month),
        "_source_checksum": F.lit(source.checksum),
        "_ingestion_run_id": F.lit(source.run_id),
        "_ingested_at": F.current_timestamp(),
    }
    return trips.withColumns(given)


def profile_zones(zones: DataFrame) -> DataFrame:
    """row_count, distinct_ids, null_ids: what must be positive, equal and zero."""
    return zones.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("LocationID").alias("distinct_ids"), F.count_if(F.col("LocationID").isNull()).alias("null_ids"))
