import pytest

from eventrank.operators import decisions, tracking

ROW = (
    "event_partition_key string, session_name_abr string, event_year int, event_number int, EventName string,"
    " session_name string, session_date_utc string, event_format string, data_loaded boolean,"
    " s3_results_location string, s3_laps_location string, circuit_lat double, circuit_lng double"
)


def row(key, session, date="2025-05-24T14:00:00Z", loaded=None, results=None, year=2025, lat=1.0, lng=2.0):
    return (key, session, year, 1, "Some Grand Prix", session, date, "conventional", loaded, results, None, lat, lng)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def test_upsert(spark):
    stored = frame(spark, row("a", "Q", loaded=True, results="s3://x/q"), row("a", "R"), row("b", "Q", loaded=False))
    new = spark.createDataFrame(
        [("a", "Q", 2025, "first", 1), ("a", "Q", 2025, "last", 2), ("c", "R", 2025, "new", 1), ("", "R", 2025, "no key", 1),
         ("c", " ", 2025, "no session", 1)],
        "event_partition_key string, session_name_abr string, event_year int, session_name string, version int",
    )
    merged = {(r[0], r[1]): r for r in tracking.upsert(stored, new, "version").collect()}
    assert set(merged) == {("a", "Q"), ("a", "R"), ("b", "Q"), ("c", "R")}
    assert merged["a", "Q"].session_name == "last" and merged["a", "Q"].data_loaded
    assert merged["a", "Q"].s3_results_location == "s3://x/q"
    assert merged["c", "R"].data_loaded is False and merged["a", "R"].data_loaded is None
    again = tracking.upsert(tracking.upsert(stored, new, "version"), new, "version")
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.values()))


def test_one_key_with_most_rows(spark):
    rows = [("hot", "Q", i) for i in range(2000)] + [("cold", "Q", 1)]
    latest = tracking.latest_rows(spark.createDataFrame(rows, "event_partition_key string, session_name_abr string, v int"), "v")
    assert {r[0]: r.v for r in latest.collect()} == {"hot": 1999, "cold": 1}


def test_update_and_landing(spark):
    stored = frame(spark, row("a", "Q"), row("a", "R", loaded=False))
    keys = "event_partition_key string, session_name_abr string"
    landed = tracking.landed_sessions(
        spark.createDataFrame([("a", "Q"), ("a", "R")], keys), spark.createDataFrame([("a", "Q"), ("z", "Q")], keys)
    )
    got = {r.session_name_abr: r.data_loaded for r in tracking.update(stored, landed).collect()}
    assert got == {"Q": True, "R": False}


def test_backlog_order(spark):
    rows = frame(
        spark, row("a", "Q", "2024-01-01T00:00:00Z", year=2024), row("b", "Q", "2025-02-01T00:00:00Z"),
        row("c", "Q", "2025-03-01T00:00:00Z", loaded=False), row("d", "Q", "2025-01-01T00:00:00Z", loaded=True),
        row("e", "Q", "2023-01-01T00:00:00Z", year=None), row("f", "Q", "2030-01-01T00:00:00Z", year=2030),
    )
    got = [r[0] for r in tracking.load_backlog(rows, "2026-01-01T00:00:00Z").collect()]
    assert got == ["c", "b", "a", "e"]
    assert [r[0] for r in tracking.load_backlog(rows, None, limit=1).collect()] == ["f"]


def test_forecast_pointer_choice(spark):
    schema = (
        "event_partition_key string, session_name_abr string, event_year int, EventName string,"
        " s3_historical_weather_forecast_location string, s3_live_weather_forecast_location string"
    )
    rows = [("a", "R", 1, "A", "h", "l"), ("b", "R", 1, "B", "", "l"), ("c", "R", 1, "C", None, None), ("d", "Q", 1, "D", "h", None)]
    got = {r[0]: (r.s3_key, r.forecast_source) for r in tracking.forecast_pointers(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": ("h", "historical"), "b": ("l", "live")}


def test_windows(spark):
    rows = frame(
        spark,
        row("both", "Q", "2025-05-24T14:00:00Z", lat=None), row("both", "R", "2025-05-25T13:00:00Z", lat=5.0),
        row("only_q", "Q"), row("turned", "Q", "2025-05-26T14:00:00Z"), row("turned", "R", "2025-05-25T13:00:00Z"),
        row("nowhere", "Q", lat=None), row("nowhere", "R", "2025-05-25T13:00:00Z", lat=None),
        row("unreadable", "Q", "soon"), row("unreadable", "R", "2025-05-25T13:00:00Z"),
    )
    windows = decisions.event_windows(rows)
    assert [(r[0], r.circuit_lat) for r in windows.collect()] == [("both", 5.0)]
    assert sorted(r[0] for r in decisions.qualifying_windows(rows).collect()) == ["both", "only_q", "turned"]


@pytest.mark.parametrize(
    "now, key, mode",
    [
        ("2025-05-24T14:00:00Z", "a", "live"), ("2025-05-25T00:00:00Z", "a", "historical"),
        ("2025-05-20T00:00:00Z", "a", "live"), ("2025-05-26T00:00:00Z", "b", "live"), ("2025-06-30T00:00:00Z", None, None),
    ],
)
def test_target_window(spark, now, key, mode):
    rows = frame(
        spark, row("a", "Q", "2025-05-24T14:00:00Z"), row("a", "R", "2025-05-25T13:00:00Z"),
        row("b", "Q", "2025-06-07T14:00:00Z"), row("b", "R", "2025-06-08T13:00:00Z"),
    )
    got = decisions.target_window(decisions.event_windows(rows), now).collect()
    assert [(r[0], r.forecast_endpoint_mode) for r in got] == ([(key, mode)] if key else [])


@pytest.mark.parametrize(
    "run, done, loaded, now, reason",
    [
        (None, [], True, "2025-05-25T00:00:00Z", "no finished model run"),
        ("r1", [], True, "2025-05-01T00:00:00Z", "no event to predict now"),
        ("r1", ["a"], True, "2025-05-25T00:00:00Z", "event was predicted before"),
        ("r1", ["other"], False, "2025-05-25T00:00:00Z", "qualifying is not loaded"),
        ("r1", ["other"], True, "2025-05-25T00:00:00Z", "ready"),
    ],
)
def test_pipeline_decision(spark, run, done, loaded, now, reason):
    rows = frame(spark, row("a", "Q", loaded=loaded), row("a", "R", "2025-05-25T13:00:00Z"))
    ready = spark.createDataFrame([(run,)], "run_id string")
    predicted = spark.createDataFrame([(d,) for d in done], "event_partition_key string")
    got = decisions.pipeline_decision(rows, ready, predicted, now).collect()
    assert len(got) == 1 and got[0].predict_reason == reason
    assert got[0].should_predict == (reason == "ready")
    assert got[0].should_ingest == (not loaded and now > "2025-05-24T14:00:00Z")


def test_prediction_state_is_kept_per_event(spark):
    events = spark.createDataFrame([(2025, "a"), (2025, "b")], "event_year int, event string")
    done = spark.createDataFrame([(2025, "a")], "event_year int, event string")
    assert [r.event for r in decisions.pending_predictions(events, done).collect()] == ["b"]


def test_ready_run_needs_the_marker(spark):
    runs = spark.createDataFrame([("20250101T0Z",), ("20250201T0Z",)], "run_id string")
    markers = spark.createDataFrame([("20250101T0Z",)], "run_id string")
    assert decisions.ready_run(runs, markers).first().run_id == "20250101T0Z"


def test_dates_are_compared_as_times(spark):
    rows = [(2025, "2025-03-23 01:00:00", "Q", "a", False), (2025, "2025-03-23T00:30:00Z", "Q", "b", False), (2025, "soon", "Q", "c", False)]
    columns = "event_year int, session_date_utc string, session_name_abr string, event_partition_key string, data_loaded boolean"
    found = tracking.load_backlog(spark.createDataFrame(rows, columns), "2025-03-23T00:45:00Z").collect()
    assert [r.event_partition_key for r in found] == ["b"]
