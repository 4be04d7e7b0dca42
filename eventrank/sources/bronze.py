"""The calendar binding as raw session files: text instead of numbers, null tokens, two spellings, wrong values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrank.sources import binding


def _text(c: Column) -> Column:
    return c.cast("string")


def _every(n: int, remainder: int = 0) -> Column:
    return F.col("k") % n == remainder


def _session_name() -> Column:
    session, year = F.col("session"), F.col("event_year")
    return (
        F.when(session == "R", "Race")
        .when(session == "Q", "Qualifying")
        .when((session == "S") & (year < 1997), "Sprint Shootout")
        .when((session == "S") & (year == 1997), "Sprint Qualifying")
        .when(session == "S", "Sprint")
        .when(session == "SS", "Sprint Shootout")
        .when(session == "SQ", "Sprint Qualifying")
        .when(year >= 2000, "Demo")
        .otherwise("Practice 1")
    )


def bronze_results(spark: SparkSession, folder: str) -> DataFrame:
    df = binding.results(spark, folder).withColumn("k", F.col("driver_number") + F.col("event_number"))
    number, finish = F.col("driver_number"), F.col("finishing_position")
    noise = 0.0004
    nanos = lambda c: (c * 1000000000).cast("bigint")
    return df.select(
        _text(number).alias("DriverNumber"),
        F.concat(F.lit("D "), _text(number)).alias("BroadcastName"),
        F.col("abbreviation").alias("Abbreviation"),
        F.col("driver_id").alias("DriverId"),
        F.lit("Driver").alias("FirstName"),
        F.when(_every(7), "").otherwise(_text(number)).alias("LastName"),
        F.col("full_name").alias("FullName"),
        F.when(_every(2), "None").otherwise("http://x").alias("HeadshotUrl"),
        F.when(_every(3), "null").otherwise("C1").alias("CountryCode"),
        F.col("team_name").alias("TeamName"),
        F.col("team_color").alias("TeamColor"),
        F.col("team_id").alias("TeamId"),
        F.when(finish.isNull() & _every(2), "r").when(finish.isNull(), "R").when(_every(5), "nan")
        .otherwise(F.concat(_text(finish), F.lit(".0"))).alias("Position"),
        F.when(F.col("is_retired") & _every(4), "R").when(_every(13), "W").otherwise(_text(finish))
        .alias("ClassifiedPosition"),
        F.when(_every(6), "").otherwise(F.concat(_text(F.col("grid_starting_position")), F.lit(".0"))).alias("GridPosition"),
        nanos(F.col("q1_seconds")).alias("Q1"),
        nanos(F.col("q2_seconds")).alias("Q2"),
        nanos(F.col("q3_seconds")).alias("Q3"),
        nanos(F.col("time_seconds")).alias("Time"),
        (F.col("q1_seconds") + noise).alias("Q1_seconds"),
        (F.col("q2_seconds") + noise).alias("Q2_seconds"),
        (F.col("q3_seconds") + noise).alias("Q3_seconds"),
        (F.col("time_seconds") + noise).alias("Time_seconds"),
        F.when(_every(11), "n/a").otherwise(_text(F.col("points"))).alias("Points"),
        F.when(_every(10), "NULL").when(F.col("is_retired"), "Accident").otherwise("  Finished ").alias("Status"),
        F.when(_every(8), "NULL").when(_every(9), "0").otherwise(_text(F.col("laps"))).alias("Laps"),
        _session_name().alias("session_name"),
        "event_name", "event_year", "event", "session",
        F.col("event_year").alias("season"),
    )


def bronze_laps(spark: SparkSession, folder: str) -> DataFrame:
    number, lap = F.col("driver_number"), F.col("lap_number")
    df = binding.laps(spark, folder).withColumn("k", lap + number + F.col("speed_st").cast("int"))
    noise = 0.0003
    flag = lambda c: F.when(c, "True").when(~c, "False")
    return df.select(
        F.concat(_text(number), F.lit(".0")).alias("DriverNumber"),
        F.concat(F.lit("D"), F.lpad(_text(number), 2, "0")).alias("Driver"),
        F.concat(F.lit("Team "), _text(number % 10)).alias("Team"),
        lap.cast("double").alias("LapNumber"),
        F.when(_every(7), "nan").otherwise(_text(lap % 3 + 1)).alias("Stint"),
        F.when(_every(5), "").otherwise(_text(F.col("speed_st").cast("int"))).alias("TyreLife"),
        F.when(_every(11), "x").otherwise(_text(lap)).alias("Position"),
        F.when(_every(13), "None").when(_every(2), "12").otherwise("1").alias("TrackStatus"),
        F.lower("compound").alias("Compound"),
        F.when(F.col("deleted"), "track limits").otherwise("None").alias("DeletedReason"),
        (F.col("lap_time_seconds") * 1000000000).cast("bigint").alias("LapTime"),
        (F.col("lap_time_seconds") + 3600 + noise).alias("Time_seconds"),
        (F.col("lap_time_seconds") + noise).alias("LapTime_seconds"),
        (lap * 100 + 0.0004).alias("LapStartTime_seconds"),
        F.col("sector1_time_seconds").alias("Sector1Time_seconds"),
        F.col("sector2_time_seconds").alias("Sector2Time_seconds"),
        (F.col("sector3_time_seconds") + F.when(_every(9), 0.2).otherwise(0.0)).alias("Sector3Time_seconds"),
        F.when(_every(10), 5400.1).alias("PitInTime_seconds"),
        F.when(_every(10, 1), 5500.2).alias("PitOutTime_seconds"),
        *[(lap * 10.0 + i).alias(f"Sector{i}SessionTime_seconds") for i in (1, 2, 3)],
        (F.col("speed_fl") + 1).alias("SpeedI1"),
        _text(F.col("speed_fl")).alias("SpeedI2"),
        F.col("speed_fl").alias("SpeedFL"),
        F.col("speed_st").alias("SpeedST"),
        F.when(_every(4), "").when(_every(2), "True").otherwise("0").alias("IsPersonalBest"),
        F.when(_every(3), "1").otherwise("false").alias("FreshTyre"),
        flag(F.col("deleted")).alias("Deleted"),
        F.when(_every(6), "True").otherwise("False").alias("FastF1Generated"),
        F.col("is_accurate").alias("IsAccurate"),
        F.when(_every(17), "no date").otherwise(
            F.concat(_text(F.col("event_year")), F.lit("-"), F.lpad(_text(F.col("event_number")), 2, "0"), F.lit("-05 12:00:00"))
        ).alias("LapStartDate"),
        _session_name().alias("session_name"),
        "event_name", "event_year", "event", "session",
        F.col("event_year").alias("season"),
    )
