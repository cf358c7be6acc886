"""Trips and zones made from the order tables of the test data, with planted defects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import small_methods


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip for each order line; some defective, some twice; all of 2024 and 2025."""
    small_methods(spark)
    line, order = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders"))
    # a test table can be one row group, hence one task; dealt by the join's key, the work after it is spread
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    h = F.pmod(F.col("l_orderkey") * 7 + F.col("l_partkey") * 3 + F.col("l_linenumber"), F.lit(1000)).alias("h")
    within = lambda a, b: F.col("h").between(a, b)
    # what comes twice is doubled as a line: a generator copies each row it sees, and trips are wide
    copies = F.explode(F.when(within(900, 909), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")
    line = line.select("*", h).select("*", copies).drop("_copy").repartition(parts, "l_orderkey")
    # orders are the few narrow rows of the two: a table of a part's orders is looked up, and no line is sorted
    t = line.join(order.select("o_orderkey", "o_orderdate").hint("shuffle_hash"), line["l_orderkey"] == F.col("o_orderkey"))
    minutes = lambda m: F.col("o_orderdate") + F.expr("interval '1' minute") * m.cast("int")
    base = F.col("o_orderkey") % 1440
    null = F.lit(None)
    number = F.col("l_linenumber")

    def bad(value: Column, wrong: Column, a: int, b: int) -> Column:
        return F.when(within(a, b), wrong).otherwise(value)

    dispatching = F.concat(F.lit("B"), F.lpad((F.col("l_partkey") % 1000).cast("string"), 5, "0"))
    year = (F.lit(2024) + F.col("o_orderkey") % 2).cast("int")
    return t.select(
        F.concat(F.lit("HV000"), (F.col("l_suppkey") % 4 + 2).cast("string")).alias("hvfhs_license_num"),
        dispatching.alias("dispatching_base_num"),
        F.when(number % 3 == 0, null).when(number % 3 == 1, "").otherwise(dispatching).alias("originating_base_num"),
        minutes(base).alias("request_datetime"),
        F.when(number % 2 == 0, null).otherwise(minutes(base)).alias("on_scene_datetime"),
        F.when(F.col("h") == 1, null).otherwise(minutes(base + F.when(within(2, 9), -5).otherwise(number))).alias("pickup_datetime"),
        minutes(base + number + F.when(within(10, 19), -10).otherwise(F.col("l_quantity"))).alias("dropoff_datetime"),
        F.when(within(20, 29), null).when(within(30, 39), 999).otherwise(F.col("l_partkey") % 25).cast("int").alias("PULocationID"),
        F.when(within(40, 49), 998).otherwise(F.col("l_suppkey") % 25).cast("int").alias("DOLocationID"),
        F.when(within(50, 54), float("nan")).when(within(55, 59), float("inf")).when(within(60, 64), -1.0).otherwise(F.col("l_quantity")).alias("trip_miles"),
        bad(F.col("l_quantity") * 60, F.lit(-60), 65, 69).cast("bigint").alias("trip_time"),
        bad(F.col("l_extendedprice"), -F.col("l_extendedprice"), 70, 74).alias("base_passenger_fare"),
        bad(F.col("l_tax"), F.lit(-0.5), 75, 79).alias("tolls"),
        F.col("l_discount").alias("bcf"),
        bad(F.col("l_tax"), F.lit(-0.5), 80, 84).alias("sales_tax"),
        F.lit(2.75).cast("double").alias("congestion_surcharge"),
        F.lit(0.0).cast("double").alias("airport_fee"),
        bad(F.col("l_discount"), F.lit(-0.5), 85, 89).alias("tips"),
        bad(F.col("l_extendedprice") * F.lit(0.7), F.lit(-0.5), 90, 94).alias("driver_pay"),
        F.col("l_returnflag").alias("shared_request_flag"),
        F.col("l_linestatus").alias("shared_match_flag"),
        F.lit("N").alias("access_a_ride_flag"),
        F.lit("N").alias("wav_request_flag"),
        F.lit("N").alias("wav_match_flag"),
        F.when(year >= 2025, (F.col("h") % 4) * F.lit(0.25).cast("double")).alias("cbd_congestion_fee"),
        year.alias("_source_year"),
        F.month("o_orderdate").alias("_source_month"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("nation", "region"))
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    return joined.select(F.col("n_nationkey").alias("LocationID"), F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone"), F.lit("Boro Zone").alias("service_zone"))
