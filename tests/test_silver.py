from eventrank.plans import silver
from eventrank.schemas import SILVER_LAP_COLUMNS, SILVER_RESULT_COLUMNS

RESULTS = (
    "DriverNumber string, Position string, ClassifiedPosition string, GridPosition string, Laps string, Status string,"
    " session_name string, Time_seconds double, Q1_seconds double, Q2_seconds double, Q3_seconds double"
)


def results(spark, *rows):
    df = spark.createDataFrame([(str(i), *r, None, None, None, None) for i, r in enumerate(rows)], RESULTS)
    return silver.silver_results(df).orderBy("driver_number").collect()


def test_result_cases(spark):
    winner, retired, late, null, zero, shootout, unknown = results(
        spark,
        ("1", "1", "2", "57", "Finished", "Race"),
        ("R", "R", "5", "12", "Accident", "Race"),
        ("18", "R", "9", "3", "Engine", "Race"),
        ("nan", "", "None", "null", "NULL", "Race"),
        ("20", None, "20", "0", None, "Race"),
        ("3", None, None, None, None, "Sprint Shootout"),
        ("4", None, None, None, None, "Demo"),
    )
    assert winner.position_change == 1 and winner.is_classified and not winner.is_retired and winner.has_race_data
    assert retired.finishing_position is None and retired.is_retired and retired.position_change is None
    assert late.is_retired and late.finishing_position == 18 and not late.is_classified
    assert (null.finishing_position, null.classified_position, null.grid_starting_position, null.laps, null.status) == (None,) * 5
    assert not null.is_retired and not null.has_race_data
    assert not zero.has_race_data and zero.laps == 0
    assert shootout.session_type == "sprint_shootout" and shootout.is_sprint and not shootout.is_qualifying
    assert unknown.session_type == "unknown" and unknown.position_change is None


def test_missing_result_columns_become_null(spark):
    df = spark.createDataFrame([("44", "Race")], "DriverNumber string, session_name string")
    out = silver.silver_results(df)
    assert set(SILVER_RESULT_COLUMNS) <= set(out.columns)
    row = out.first()
    assert row.driver_number == 44 and row.finishing_position is None and not row.has_complete_race_data


LAPS = (
    "DriverNumber double, LapTime_seconds double, Sector1Time_seconds double, Sector2Time_seconds double,"
    " Sector3Time_seconds double, PitInTime_seconds double, PitOutTime_seconds double, Deleted string,"
    " IsAccurate boolean, Compound string, session_name string, FastF1Generated string, fastf1_generated string"
)


def laps(spark, *rows):
    df = spark.createDataFrame([(float(i), *r) for i, r in enumerate(rows)], LAPS)
    return silver.silver_laps(df).orderBy("driver_number").collect()


def test_lap_cases(spark):
    clean, unknown, mismatch, partial, bare, pit, deleted = laps(
        spark,
        (90.0, 30.0, 30.0, 30.0, None, None, "False", True, "soft", "Practice 1", "True", None),
        (91.5, 30.5, 30.5, 30.5, None, None, None, None, "MEDIUM", "Practice 1", "True", "false"),
        (90.0, 30.0, 30.0, 30.2, None, None, "False", True, "HARD", "Practice 1", None, None),
        (90.0, None, 30.0, 30.0, None, None, "False", True, "HARD", "Practice 1", None, None),
        (90.0, None, None, None, None, None, "False", True, None, "Practice 1", None, None),
        (110.0, 30.0, 40.0, 40.0, 5400.1, None, "False", True, "SOFT", "Practice 1", None, None),
        (88.0004, 29.0, 29.0, 30.0, None, 5.0, "True", True, "SOFT", "Practice 1", None, None),
    )
    assert clean.compound == "SOFT" and not clean.sector_time_mismatch and clean.total_sector_time_seconds == 90.0
    assert clean.fastf1_generated is True and unknown.fastf1_generated is False
    assert unknown.deleted is None and unknown.is_accurate is None and unknown.compound == "MEDIUM"
    assert mismatch.sector_time_mismatch and not partial.sector_time_mismatch
    assert partial.total_sector_time_seconds == 60.0 and bare.total_sector_time_seconds is None
    assert pit.is_pit_lap and not clean.is_pit_lap and deleted.is_pit_lap
    assert deleted.deleted is True and deleted.lap_time_seconds == 88.0


def test_lap_columns(spark):
    df = spark.createDataFrame([("Race",)], "session_name string")
    assert silver.silver_laps(df).columns[: len(SILVER_LAP_COLUMNS)] == SILVER_LAP_COLUMNS
