"""Silver and quarantine: every bronze row is one or the other, with a reason for the latter.

Rows of equal identity are found by counting row_ids alone. Only those of
identities that occur again are numbered, as narrow rows of their place in the bronze
files (``row_file`` and ``row_index``), and joined back by it; so no trip is shuffled
for the sake of the few that come twice, and an identity with very many copies is
numbered in blocks. Rows without a place, of frames that are no table, are numbered
by one window over whole rows.

The zones are a lookup of a few hundred rows; they are broadcast if they are counted
to be as few as that, so trips are not shuffled by their zones, which are hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions import quality


#: Zones that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 10_000
#: Copies whose numbers are broadcast at most, about 200 bytes each; of more, rows are joined by a shuffle.
BROADCAST_COPIES = 500_000
#: Where a row of a stored table is: its file, and its number there.
PLACE = ("row_file", "row_index")
#: Copies of one trip are numbered in blocks of 2 ** BLOCK_BITS rows of a file.
BLOCK_BITS = 20


def with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """pickup_zone_id and dropoff_zone_id: the trip's zones where the lookup has them."""
    known = zones.select(F.col("LocationID").try_cast("int").alias("zone_id")).where("zone_id is not null").distinct()
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    for own, zone in (("PULocationID", "pickup_zone_id"), ("DOLocationID", "dropoff_zone_id")):
        side = known.withColumnRenamed("zone_id", zone)
        trips = trips.join(side, trips[own].try_cast("int") == side[zone], "left")
    return trips


def with_reason(joined: DataFrame) -> DataFrame:
    return joined.withColumn("reason_code", quality.reason())


def numbered(reasoned: DataFrame, order: tuple[str, ...] = ("_source_file", "_ingested_at")) -> DataFrame:
    """_trip_row_number among the rows of one row_id, valid or not."""
    if not {*PLACE} <= {*reasoned.columns}:
        return reasoned.withColumn("_trip_row_number", F.row_number().over(Window.partitionBy("row_id").orderBy(*order)))
    return renumbered(reasoned, repeated(reasoned, order))


def renumbered(rows: DataFrame, again: DataFrame) -> DataFrame:
    """rows with _trip_row_number: as ``again`` (see ``repeated``) has it, else 1."""
    again = again.select(*(F.col(c).alias(f"_{c}") for c in PLACE), F.col("_trip_row_number").alias("_again"))
    joined = rows.join(again, [F.col(c) == F.col(f"_{c}") for c in PLACE], "left")
    return joined.select(*rows.columns, F.coalesce("_again", F.lit(1)).alias("_trip_row_number"))


def repeated(rows: DataFrame, order: tuple[str, ...] = ("_source_file", "_ingested_at")) -> DataFrame:
    """row_file, row_index and _trip_row_number of the rows that are not the first of their identity.

    Numbers within blocks of rows that lie together, and blocks by their counts.
    """
    narrow = rows.select("row_id", *order, *PLACE)
    twice = narrow.groupBy("row_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row_id")
    block = [*order, "row_file", "_block"]
    found = narrow.join(twice, "row_id", "left_semi").withColumn("_block", F.shiftright("row_index", BLOCK_BITS))
    sizes = found.groupBy("row_id", *block).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("row_id").orderBy(*block)) - F.col("n")
    keys = ["row_id", *block]
    offsets = sizes.select(*(F.col(k).alias(f"o_{k}") for k in keys), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy("row_index"))
    placed = found.withColumn("_inside", inside).join(offsets, [F.col(k).eqNullSafe(F.col(f"o_{k}")) for k in keys])
    return placed.select(*PLACE, (F.col("_before") + F.col("_inside")).cast("int").alias("_trip_row_number")).where("_trip_row_number > 1")


def with_duplicates(rows: DataFrame) -> DataFrame:
    """A valid row that is not the first of its identity is a duplicate."""
    again = F.col("reason_code").isNull() & (F.col("_trip_row_number") > 1)
    return rows.withColumn("reason_code", F.when(again, F.lit(quality.DUPLICATE)).otherwise(F.col("reason_code")))


def classify(bronze: DataFrame, zones: DataFrame, order: tuple[str, ...] = ("_source_file", "_ingested_at")) -> DataFrame:
    """bronze with its zones, reason_code (null: silver) and _trip_row_number.

    Rows are numbered first: what follows from a row need not be shuffled with it.
    """
    return classify_numbered(numbered(bronze, order), zones)


def classify_numbered(rows: DataFrame, zones: DataFrame) -> DataFrame:
    """The same, of rows that have their _trip_row_number."""
    return with_duplicates(with_reason(with_zones(rows, zones)))


def judged(rows: DataFrame, zones: DataFrame, order: tuple[str, ...] = ("_source_file", "_ingested_at")) -> DataFrame:
    """The same, with rows judged before they are numbered.

    What only the rules look at is not shuffled then if the reader of the result does not want it.
    """
    return with_duplicates(numbered(with_reason(with_zones(rows, zones)), order))


def _seconds(name: str) -> Column:
    return F.unix_timestamp(F.col(name).cast("timestamp"))


def silver(classified: DataFrame) -> DataFrame:
    """Valid trips in the silver columns (the fee only where the source has it)."""
    columns = [
        "row_id",
        "business_trip_key",
        "identity_policy_version",
        F.col("hvfhs_license_num").alias("operator_code"),
        "request_datetime",
        "pickup_datetime",
        "dropoff_datetime",
        F.col("PULocationID").try_cast("int").alias("pickup_zone_id"),
        F.col("DOLocationID").try_cast("int").alias("dropoff_zone_id"),
        "trip_miles",
        F.col("trip_time").try_cast("bigint").alias("trip_time_seconds"),
        F.col("base_passenger_fare").alias("passenger_fare"),
        *("tolls sales_tax tips driver_pay shared_request_flag shared_match_flag".split()),
        F.col("_source_year").alias("source_year"),
        F.col("_source_month").alias("source_month"),
        F.col("_ingestion_run_id").alias("ingestion_run_id"),
        ((_seconds("dropoff_datetime") - _seconds("pickup_datetime")) / 60).alias("trip_duration_minutes"),
        F.to_date("pickup_datetime").alias("pickup_date"),
        F.hour("pickup_datetime").alias("pickup_hour"),
    ]
    if "cbd_congestion_fee" in classified.columns:
        columns.append(F.col("cbd_congestion_fee").cast("double"))
    return classified.where("reason_code is null").select(*columns)


def quarantine(classified: DataFrame) -> DataFrame:
    return classified.where("reason_code is not null").drop("_trip_row_number", *PLACE)


def count_columns() -> list[Column]:
    """Bronze, silver and quarantine rows, each counted by itself."""
    reason = F.col("reason_code")
    return [F.count(F.lit(1)).alias("bronze_count"), F.count_if(reason.isNull()).alias("silver_count"), F.count_if(reason.isNotNull()).alias("quarantine_count")]


def counts(classified: DataFrame) -> DataFrame:
    return classified.agg(*count_columns())


def by_reason(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reason_code").agg(F.count(F.lit(1)).alias("trips")).orderBy("reason_code")


def other_policy(bronze: DataFrame, expected: Column | str) -> DataFrame:
    """Rows of another identity policy, or of none."""
    expected = F.lit(expected) if isinstance(expected, str) else expected
    return bronze.where(~F.col("identity_policy_version").eqNullSafe(expected))
