"""Coordinates of the circuits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Event slug -> (latitude, longitude).
CIRCUITS = {
    "bahrain": (26.0325, 50.5106),
    "saudi_arabian": (21.6319, 39.1044),
    "australian": (-37.8497, 144.9680),
    "japanese": (34.8431, 136.5407),
    "chinese": (31.3389, 121.2197),
    "miami": (25.9581, -80.2389),
    "emilia_romagna": (44.3439, 11.7167),
    "monaco": (43.7347, 7.4206),
    "canadian": (45.5000, -73.5228),
    "spanish": (41.5700, 2.2611),
    "austrian": (47.2197, 14.7647),
    "british": (52.0786, -1.0169),
    "hungarian": (47.5789, 19.2486),
    "belgian": (50.4372, 5.9714),
    "dutch": (52.3888, 4.5409),
    "italian": (45.6156, 9.2811),
    "azerbaijan": (40.3725, 49.8533),
    "singapore": (1.2914, 103.8644),
    "united_states": (30.1328, -97.6411),
    "mexico_city": (19.4042, -99.0907),
    "sao_paulo": (-23.7036, -46.6997),
    "las_vegas": (36.1162, -115.1745),
    "qatar": (25.4900, 51.4542),
    "abu_dhabi": (24.4672, 54.6031),
    "french": (43.2506, 5.7917),
}


def coordinates(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{slug}', {lat}D, {lng}D)" for slug, (lat, lng) in CIRCUITS.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS circuits(event, circuit_lat, circuit_lng)")


def with_coordinates(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add the coordinates of ``event``; an unknown event gets NULLs, or fails the job when ``strict``."""
    # The list is a constant of this module, so its size is known: broadcast.
    joined = df.join(F.broadcast(coordinates(df.sparkSession)), "event", "left")
    if not strict:
        return joined
    message = F.concat(F.lit("no coordinates for event "), F.col("event"))
    known = F.when(F.col("circuit_lat").isNull(), F.raise_error(message)).otherwise(F.col("circuit_lat"))
    return joined.withColumn("circuit_lat", known.cast("double"))
