"""A session with the settings the pipeline relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC makes timestamp text the same everywhere; adaptive execution sizes
#: shuffles and splits hot keys at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # wide rows make methods that the JVM runs without compiling them; Spark then takes its split, compiled form
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def small_methods(spark: SparkSession) -> None:
    """The last of the settings, for a session that was made elsewhere."""
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, SETTINGS[name])


def session(app: str = "tripmill", **more: str) -> SparkSession:
    return SparkSession.builder.appName(app).config(map=SETTINGS | more).getOrCreate()
