"""Gold: three dimensions, one fact and two marts over silver.

Sums of money and distance are exact: doubles are added as decimals, in whole
millionths, so a result does not depend on the order in which tasks finish.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.identity import FEE_COLUMN, FEE_YEAR, is_millionths, millionths
from tripmill.sources.schema import FACT


def _date_key(day: Column) -> Column:
    """The day's digits as a number; as one without a text from year 1 on, where both are the same."""
    number = F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)
    return F.when(F.year(day) > 0, number).otherwise(F.date_format(day, "yyyyMMdd").cast("int"))


def dim_date(silver: DataFrame) -> DataFrame:
    """The days on which trips began; the week begins on Sunday, day 1."""
    day = F.col("calendar_date")
    days = silver.select(F.col("pickup_date").alias("calendar_date")).where(day.isNotNull()).distinct()
    return days.select(
        _date_key(day).alias("date_key"),
        day,
        F.year(day).alias("calendar_year"),
        F.month(day).alias("calendar_month"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "E").alias("day_name"),
    )


def dim_operator(silver: DataFrame) -> DataFrame:
    return silver.where("operator_code is not null").select("operator_code").distinct()


def dim_zone(zones: DataFrame) -> DataFrame:
    return zones.where("LocationID is not null").select(F.col("LocationID").cast("int").alias("zone_id"), F.col("Borough").alias("borough"), F.col("Zone").alias("zone_name"), "service_zone")


def fct_trips(silver: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """One row for each silver row, of one month if that is given. The fee is null before its first year."""
    if year is not None:
        silver = silver.where((F.col("source_year") == year) & (F.col("source_month") == month))
    fee = F.lit(None).cast("double")
    if FEE_COLUMN in silver.columns and (year is None or year >= FEE_YEAR):
        fee = F.col(FEE_COLUMN) if year else F.when(F.col("source_year") >= FEE_YEAR, F.col(FEE_COLUMN))
    made = {"pickup_date_key": _date_key(F.col("pickup_date")), FEE_COLUMN: fee}
    return silver.select(*(made[n].alias(n) if n in made else F.col(n) for n, _ in FACT.columns))


def upsert(target: DataFrame, source: DataFrame, key: str = "row_id") -> DataFrame:
    """target with source's rows in place of those of equal key; nothing is deleted."""
    return target.join(source, key, "left_anti").unionByName(source)


#: Millionths are added in two parts of up to this many bits, each for 2 ** 33 rows at least.
HALF_BITS = 30


def _sum(name: str) -> Column:
    """The sum of a column's values as decimal(18,6), added as whole numbers: of decimals, each sum would make objects of every row."""
    value = F.col(name)
    n = F.when(is_millionths(value), millionths(value)).otherwise((value.cast("decimal(18,6)") * 1_000_000).cast("bigint"))
    high, low = (F.sum(x).cast("decimal(20,0)") for x in (F.shiftright(n, HALF_BITS), n.bitwiseAND(F.lit(2**HALF_BITS - 1))))
    return ((high * F.lit(2**HALF_BITS) + low) * F.lit("0.000001").cast("decimal(6,6)")).cast("double")


def _mean(name: str) -> Column:
    return _sum(name) / F.count(name)


def _month_key() -> list[Column]:
    return [F.col("source_year").cast("string"), F.lit("-"), F.lpad(F.col("source_month").cast("string"), 2, "0"), F.lit("-")]


def mart_hourly_zone_demand(fact: DataFrame) -> DataFrame:
    """Trips of each month, day, hour and pickup zone."""
    keys = ["source_year", "source_month", "pickup_date_key", "pickup_hour", "pickup_zone_id"]
    rows = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("trip_count"), _sum("trip_miles").alias("total_trip_miles"), _mean("passenger_fare").alias("average_passenger_fare"), _sum("driver_pay").alias("total_driver_pay"))
    text = lambda c: F.col(c).cast("string")
    key = F.concat(*_month_key(), text("pickup_date_key"), F.lit("-"), F.lpad(text("pickup_hour"), 2, "0"), F.lit("-"), text("pickup_zone_id"))
    return rows.select(key.alias("hourly_zone_key"), "*")


def mart_operator_metrics(fact: DataFrame) -> DataFrame:
    """Trips and money of each month and operator."""
    rows = fact.groupBy("source_year", "source_month", "operator_code").agg(
        F.count(F.lit(1)).alias("trip_count"),
        _mean("passenger_fare").alias("average_passenger_fare"),
        _sum("passenger_fare").alias("total_passenger_fare"),
        _sum("driver_pay").alias("total_driver_pay"),
        _sum("tips").alias("total_tips"),
        _mean("trip_miles").alias("average_trip_miles"),
    )
    return rows.select(F.concat(*_month_key(), F.col("operator_code")).alias("operator_month_key"), "*")


#: Which models each model is built from.
DEPENDS = {
    "dim_date": ("silver_trips",),
    "dim_operator": ("silver_trips",),
    "dim_zone": ("bronze_taxi_zones",),
    "fct_trips": ("silver_trips",),
    "mart_hourly_zone_demand": ("fct_trips",),
    "mart_operator_metrics": ("fct_trips",),
}


def check_graph(relations: dict[str, DataFrame], folders: dict[str, str], depends: dict[str, tuple[str, ...]] | None = None) -> None:
    """Refuses models that read other relations than they should (DEPENDS, unless said otherwise).

    folders: of the relations that models are built from. What a model reads is
    taken from the files of its own plan; only names of files pass the driver.
    """
    for model, sources in (DEPENDS if depends is None else depends).items():
        files = relations[model].inputFiles()
        read = {name for name, folder in folders.items() if any(f"{_path(folder)}/" in _path(f) for f in files)}
        if read - set(sources) or (files and read != set(sources)):
            raise ValueError(f"{model} reads {sorted(read)} instead of {sorted(sources)}")


def _path(uri: str) -> str:
    """A URI without its scheme and authority, which plans write in other ways."""
    return re.sub("^[a-z][a-z0-9+.-]*:(//[^/]*)?", "", uri.rstrip("/"))


def build(silver: DataFrame, zones: DataFrame, fact: DataFrame | None = None) -> dict[str, DataFrame]:
    """All relations by name, with those they are built from."""
    fact = fct_trips(silver) if fact is None else fact
    return {
        "bronze_taxi_zones": zones,
        "silver_trips": silver,
        "dim_date": dim_date(silver),
        "dim_operator": dim_operator(silver),
        "dim_zone": dim_zone(zones),
        "fct_trips": fact,
        "mart_hourly_zone_demand": mart_hourly_zone_demand(fact),
        "mart_operator_metrics": mart_operator_metrics(fact),
    }
