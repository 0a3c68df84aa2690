"""Seed lookups shipped with the project, and a reader for seed CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# These seed rows must equal the reference's seed files.
CAPACITY_TIERS = [
    # tier_name, min_docks, max_docks, description
    ("micro", 1, 9, "Very small station typically in low-density areas"),
    ("small", 10, 19, "Standard neighbourhood station"),
    ("medium", 20, 34, "Busy neighbourhood or transit hub station"),
    ("large", 35, 54, "High-traffic station near major transit or attractions"),
    ("hub", 55, 999, "Major hub station at transit terminals or high-density destinations"),
]
BIKE_TYPES = [
    # vehicle_type_id, bike_type, is_electric, typical_range_miles, description
    ("classic", "Classic Bike", False, None, "Standard pedal bike available at all stations"),
    ("electric_bike", "Electric Bike", True, 30, "Pedal-assist e-bike with motor support up to 20mph"),
    ("cargo_bike", "Cargo Bike", False, None, "Larger bike designed for carrying loads"),
]
BOROUGHS = [
    # borough_name, region_name, population_2020, area_sq_miles
    ("Manhattan", "NYC District", 1694251, 22.8),
    ("Brooklyn", "NYC District", 2736074, 69.4),
    ("Queens", "NYC District", 2405464, 108.7),
    ("Bronx", "NYC District", 1472654, 42.0),
    ("Staten Island", "NYC District", 495747, 57.5),
    ("Jersey City", "NYC District", 292449, 14.8),
    ("Hoboken", "NYC District", 60000, 1.3),
]

TIERS_SCHEMA = "tier_name string, min_docks int, max_docks int, description string"
BIKE_TYPES_SCHEMA = ("vehicle_type_id string, bike_type string, is_electric boolean, "
                     "typical_range_miles int, description string")
BOROUGHS_SCHEMA = "borough_name string, region_name string, population_2020 long, area_sq_miles double"
INTERVENTIONS_SCHEMA = "station_id string, intervention_date date, intervention_type string, notes string"


def capacity_tiers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CAPACITY_TIERS, TIERS_SCHEMA)


def bike_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BIKE_TYPES, BIKE_TYPES_SCHEMA)


def boroughs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BOROUGHS, BOROUGHS_SCHEMA)


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a seed CSV (header row) with an explicit schema; no inference."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_interventions(spark: SparkSession, path: str) -> DataFrame:
    """Intervention seed; station ids stay strings (UUIDs and digits mix)."""
    return read_seed(spark, path, INTERVENTIONS_SCHEMA)


def region_population(boroughs_df: DataFrame) -> DataFrame:
    """Boroughs rolled up to the region they belong to."""
    from pyspark.sql import functions as F
    return boroughs_df.groupBy("region_name").agg(
        F.count(F.lit(1)).alias("boroughs"),
        F.sum("population_2020").alias("population_2020"),
        F.sum("area_sq_miles").alias("area_sq_miles"))


def with_bike_type(bikes_df: DataFrame, types_df: DataFrame) -> DataFrame:
    """Bike attributes from the bike-type seed (a few rows, broadcast); unknown types keep NULLs."""
    from pyspark.sql import functions as F
    t = types_df.select("vehicle_type_id", "bike_type", "is_electric", "typical_range_miles")
    return bikes_df.join(F.broadcast(t), "vehicle_type_id", "left")
