import pytest
from pyspark.sql import functions as F

from eventrank.functions.values import parse_utc
from eventrank.operators import weather
from eventrank.schemas import PAYLOAD_SCHEMA
from eventrank.sources.lake import read_json


def payload(spark, tmp_path, **parts):
    """One payload file that spans several lines, read with the payload schema."""
    import json

    document = {"metadata": {"event_partition_key": "2025_Monaco_Grand_Prix", "EventName": "Monaco Grand Prix",
                             "event_year": 2025, "race_dt_utc": "2025-05-25T12:30:00Z",
                             "qualifying_dt_utc": "2025-05-24T14:00:00Z"}, **parts}
    path = tmp_path / "forecast_window.json"
    path.write_text(json.dumps(document, indent=2))
    return read_json(spark, str(path), PAYLOAD_SCHEMA, whole_files=True)


def hours(df, at="2025-05-25T12:30:00Z"):
    return df.select(*weather.nearest_hour("open_meteo_response.hourly", parse_utc(F.lit(at)), "race_hour")).first()


def test_tie_takes_the_earlier_hour(spark, tmp_path):
    hourly = {"time": ["bad", "2025-05-25T12:00", "2025-05-25T13:00"], "temperature_2m": [1.0, 20.1, 20.5], "rain": [9.0]}
    row = hours(payload(spark, tmp_path, open_meteo_response={"hourly": hourly}))
    assert (row.race_hour_temperature_c, row.race_hour_timestamp_utc) == (20.1, "2025-05-25T12:00:00Z")
    assert (row.race_hour_offset_minutes, row.race_hour_rain_mm, row.race_hour_wind_speed_kmh) == (-30, None, None)


@pytest.mark.parametrize("hourly", [{"time": []}, {"time": ["bad"]}, {}])
def test_no_usable_hour(spark, tmp_path, hourly):
    row = hours(payload(spark, tmp_path, open_meteo_response={"hourly": hourly}))
    assert set(row) == {None}


@pytest.mark.parametrize(
    "time, sums, want",
    [
        (["2025-05-24", "2025-05-25"], [7.0, 2.0], 2.0), (["2025-05-23", "2025-05-24"], [7.0, 3.0], 3.0),
        (["2025-05-25"], [None], 0.0), ([], [], 0.0), (["2025-05-24", "2025-05-25"], [7.0], 0.0),
    ],
)
def test_daily_pick(spark, tmp_path, time, sums, want):
    df = payload(spark, tmp_path, open_meteo_response={"daily": {"time": time, "precipitation_sum": sums}})
    day = parse_utc(F.col("metadata.race_dt_utc"))
    row = df.select(*weather.daily_features("open_meteo_response.daily", day)).first()
    assert row.precipitation_sum_mm == want and row.temperature_max_c is None


def test_missing_parts_are_null(spark, tmp_path):
    df = payload(spark, tmp_path)
    pointers = spark.createDataFrame(
        [("2025_Monaco_Grand_Prix", 2025, "Monaco Grand Prix", "live")],
        "event_partition_key string, event_year int, EventName string, forecast_source string",
    )
    row = weather.silver_forecast(pointers, df).first()
    assert (row.event, row.forecast_source, row.precipitation_sum_mm, row.race_hour_offset_minutes) == ("monaco", "live", None, None)


@pytest.mark.parametrize(
    "hour, offset, aligned, message",
    [
        ("2025-05-25T12:00:00Z", -30, True, "aligned, -30 minutes off"),
        ("2025-05-25T12:00:00Z", None, True, "aligned, 0 minutes off"),
        ("2025-05-25T12:00:00Z", 61, False, "the hour is 61 minutes off"),
        ("2025-05-25T13:00:00Z", 30, False, "the hour begins at 13, the race within hour 12"),
        ("2025-05-24T12:00:00Z", 0, False, "the hour is of 2025-05-24, the race of 2025-05-25"),
        ("soon", 0, False, "the race hour 'soon' is no time"),
        (None, None, False, "no race hour is stored"),
    ],
)
def test_race_hour_alignment(spark, hour, offset, aligned, message):
    df = spark.createDataFrame(
        [(2025, "monaco", "2025-05-25T12:30:00Z", hour, offset)],
        "event_year int, event string, race_dt_utc string, race_hour_timestamp_utc string, race_hour_offset_minutes int",
    )
    row = weather.race_hour_alignment(df).first()
    assert (row.aligned, row.message) == (aligned, message)


def test_qualifying_hour_alignment(spark):
    rows = [(1, "2025-05-24T14:10:00Z", "2025-05-24T14:00:00Z", -10), (2, "2025-05-24T14:10:00Z", "2025-05-24T14:00:00Z", 5),
            (3, "2025-05-24T14:10:00Z", "2025-05-24T13:00:00Z", -70), (4, None, None, None)]
    df = spark.createDataFrame(
        [(y, "e", q, h, o) for y, q, h, o in rows],
        "event_year int, event string, qualifying_dt_utc string, qualifying_hour_timestamp_utc string, qualifying_hour_offset_minutes int",
    )
    got = {r.event_year: (r.offset_matches, r.in_range) for r in weather.qualifying_hour_alignment(df).collect()}
    assert got == {1: (True, True), 2: (False, True), 3: (True, False), 4: (False, False)}
