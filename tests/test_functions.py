import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventrank.functions import text
from eventrank.functions import values as v
from eventrank.sources.coordinates import with_coordinates


def column(spark, inputs, build, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]


def test_snake_names(spark):
    names = ["DriverNumber", "IsPersonalBest", "Time_seconds", "Q1", "SpeedI1", "FastF1Generated", "Sector1SessionTime"]
    want = ["driver_number", "is_personal_best", "time_seconds", "q1", "speed_i1", "fast_f1_generated", "sector1_session_time"]
    assert [text.snake_name(n) for n in names] == want
    assert column(spark, names, text.snake_case) == want


def test_slugs(spark):
    names = ["Monaco Grand Prix", "São Paulo Grand Prix", "Mexico City Grand Prix", "United States Grand Prix", "  A--b  ", None]
    want = ["monaco", "sao_paulo", "mexico_city", "united_states", "a_b", ""]
    assert column(spark, names, text.event_slug) == want


def test_event_key_round_trip(spark):
    keys = ["2025_Monaco_Grand_Prix", "2024_Race"]
    assert column(spark, keys, text.event_key_year) == [2025, 2024]
    assert column(spark, keys, text.event_key_name) == ["Monaco Grand Prix", "Race"]


def test_session_types(spark):
    names = ["Sprint Shootout", "Sprint Qualifying", "Practice 2", "Race", "R", "Qualifying", "Q1", "Sprint", "s", "Demo", None]
    want = ["sprint_shootout", "sprint_qualifying", "practice", "race", "race", "qualifying", "qualifying", "sprint",
            "sprint", "unknown", None]
    assert column(spark, names, text.session_type) == want


def test_session_abbreviations(spark):
    assert column(spark, ["Practice 3", "Sprint Shootout", "warm up"], text.session_abbreviation) == ["P3", "SS", "W"]
    kinds = ["qualifying", "sprint_qualifying", "sprint_shootout", "sprint", "other", None]
    assert column(spark, kinds, text.prediction_session) == ["Q", "SQ", "SS", "S", "Q", "Q"]


def test_tokens_flags_numbers(spark):
    assert column(spark, ["", "nan", "None", "null", "NULL", "x"], text.null_if_token) == [None] * 5 + ["x"]
    assert column(spark, ["True", "false", "1", "0", "yes", None], v.parse_bool) == [True, False, True, False, None, None]
    assert column(spark, ["3.0", "7", "R", "nan", "", None], v.to_int) == [3, 7, None, None, None, None]


def test_rounding_is_half_to_even(spark):
    assert column(spark, [0.0005, 0.0015, 1.2344], v.round_ms, "double") == [0.0, 0.002, 1.234]


def test_utc_texts(spark):
    texts = ["2025-05-24T14:00:00Z", "2018-03-23 01:00:00", "2026-03-08 15:00:00+11:00", "2025-05-25T13:00", "soon", None]
    got = column(spark, texts, v.parse_utc)
    assert got == [dt.datetime(2025, 5, 24, 14), dt.datetime(2018, 3, 23, 1), dt.datetime(2026, 3, 8, 4),
                   dt.datetime(2025, 5, 25, 13), None, None]


def test_utc_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = column(spark, ["2025-05-24T14:00:00Z"], lambda c: v.format_utc(v.parse_utc(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2025-05-24T14:00:00Z"]


def test_minutes_are_cut_toward_zero(spark):
    pairs = [("2025-01-01T12:00:00Z", "2025-01-01T12:20:59Z"), ("2025-01-01T13:00:00Z", "2025-01-01T12:00:30Z")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(v.minute_offset(v.parse_utc(F.col("a")), v.parse_utc(F.col("b")))).collect()]
    assert got == [-20, 59]


def test_wet_threshold(spark):
    assert column(spark, [0.99, 1.0, None], v.is_wet, "double") == [False, True, False]


def test_sectors(spark):
    rows = [(30.0, 30.0, 30.0, 90.0), (30.0, 30.0, 30.2, 90.0), (None, 30.0, 30.0, 90.0), (None, None, None, 90.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, lap double")
    s = [F.col(c) for c in "abc"]
    got = [tuple(r) for r in df.select(v.total_sectors(*s), v.sector_mismatch(*s, F.col("lap"))).collect()]
    assert got == [(90.0, False), (90.2, True), (60.0, False), (None, False)]


def test_unknown_circuit(spark):
    df = spark.createDataFrame([("monaco",), ("nowhere",)], "event string")
    assert {r["event"]: r["circuit_lat"] for r in with_coordinates(df).collect()} == {"monaco": 43.7347, "nowhere": None}
    with pytest.raises(Exception, match="no coordinates for event nowhere"):
        with_coordinates(df, strict=True).collect()
