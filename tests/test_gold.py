import random
import statistics

import pytest
from pyspark.sql import functions as F

from eventrank.operators import events, history, pace, quality
from eventrank.plans import gold
from eventrank.sources import lake

RESULT = (
    "event_year int, event string, event_name string, session string, driver_number int, driver_id string, full_name string,"
    " abbreviation string, team_id string, team_name string, team_color string, finishing_position int,"
    " is_retired boolean, points double, q1_seconds double, q2_seconds double, q3_seconds double, time_seconds double"
)
SESSION = "event_year int, event_number int, event string, session string, session_date_utc string"
LAP = (
    "event_year int, event string, session string, session_type string, driver_number int, lap_time_seconds double,"
    " sector1_time_seconds double, sector2_time_seconds double, sector3_time_seconds double, speed_fl double,"
    " speed_st double, compound string, deleted boolean, is_pit_lap boolean, is_accurate boolean"
)


def result(year, event, session, driver, finish, points=0.0, retired=False):
    return (year, event, event.title(), session, driver, f"d{driver}", f"Driver {driver}", f"D{driver}", "t", "T", "#0",
            finish, retired, points, 60.0, None, None, None)


def lap(year, event, session, driver, seconds, kind="race", compound=None, deleted=None, pit=None, accurate=None):
    return (year, event, session, kind, driver, seconds, 1.0, 2.0, 3.0, 300.0, 310.0, compound, deleted, pit, accurate)


@pytest.fixture(scope="module")
def season(spark):
    """Three events of one season with a sprint weekend, and the same events one, three and four years before."""
    dates = []
    for year in (2020, 2021, 2023, 2024):
        for number, event in enumerate(("alpha", "beta", "gamma"), 1):
            dates += [(year, number, event, "Q", f"{year}-0{number}-10T14:00:00Z"), (year, number, event, "R", f"{year}-0{number}-11T14:00:00Z")]
    # A sprint held before qualifying counts, one that starts at the same moment does not.
    dates += [(2024, 2, "beta", "S", "2024-02-10T09:00:00Z"), (2024, 3, "gamma", "S", "2024-03-10T14:00:00Z")]
    dates += [(2024, 2, "beta", "SQ", "2024-02-09T09:00:00Z"), (2024, 2, "beta", "SS", "2024-02-09T10:00:00Z")]
    rows = [result(2024, e, "Q", 1, p) for e, p in (("alpha", 3), ("beta", 2), ("gamma", 1))]
    rows += [result(2024, "alpha", "R", 1, 4, 12.0), result(2024, "beta", "R", 1, None, 0.0, True), result(2024, "gamma", "R", 1, 1, 25.0)]
    rows += [result(2024, "beta", "S", 1, 1, 8.0), result(2024, "gamma", "S", 1, 1, 8.0)]
    rows += [result(y, "gamma", "R", 1, f, p) for y, f, p in ((2020, 9, 1.0), (2021, 5, 10.0), (2023, 3, 15.0))]
    laps = [lap(2023, "gamma", "R", 1, 90.0), lap(2021, "gamma", "R", 1, 92.0), lap(2020, "gamma", "R", 1, 50.0), lap(2024, "gamma", "R", 1, 10.0)]
    laps += [lap(2024, "gamma", "P1", 1, t, "practice", c) for t, c in ((91.0, "SOFT"), (93.0, "HARD"), (92.0, "SOFT"), (97.0, None))]
    laps += [lap(2024, "gamma", "P1", 1, 1.0, "practice", deleted=True), lap(2024, "gamma", "P1", 1, 2.0, "practice", pit=True),
             lap(2024, "gamma", "P1", 1, 3.0, "practice", accurate=False), lap(2024, "gamma", "P1", 1, None, "practice")]
    laps += [lap(2024, "gamma", "Q", 1, t, "qualifying") for t in (88.0, 89.0, 90.5)]
    frames = (spark.createDataFrame(rows, RESULT), spark.createDataFrame(laps, LAP), spark.createDataFrame(dates, SESSION))
    weather = spark.createDataFrame(
        [(2024, "gamma", 1.0, 20.0, 10.0, 5.0)],
        "event_year int, event string, precipitation_sum_mm double, temperature_max_c double, temperature_min_c double, wind_speed_max_kmh double",
    )
    return (*frames, weather)


def by_event(df):
    return {r["event"]: r for r in df.where("event_year = 2024").collect()}


def test_history_is_strictly_before(season):
    rows = by_event(gold.gold_features(*season))
    assert rows["alpha"].season_points_to_date is None and rows["alpha"].last3_race_count is None
    assert rows["beta"].season_points_to_date == 12.0 + 8.0
    assert rows["gamma"].season_points_to_date == 12.0 + 8.0
    assert (rows["gamma"].last3_race_count, rows["gamma"].last3_dnfs, rows["gamma"].last3_avg_finish) == (2, 1, 4.0)


def test_same_event_in_earlier_years(season):
    row = by_event(gold.gold_features(*season))["gamma"]
    assert (row.circuit_last3y_race_count, row.circuit_last3y_avg_finish, row.circuit_last3y_avg_points) == (2, 4.0, 12.5)
    assert (row.hist_race_laps_count, row.hist_avg_race_lap_time) == (2, 91.0)
    assert row.hist_race_lap_time_std == pytest.approx(statistics.stdev([90.0, 92.0]))


def test_pace_ignores_invalid_laps(season):
    row = by_event(gold.gold_features(*season))["gamma"]
    assert row.practice_laps_count == 4 and row.practice_best_lap_time_seconds == 91.0
    assert row.practice_median_lap_time_seconds == 92.5 and row.practice_mean_lap_time_seconds == 93.25
    assert (row.practice_best_soft_lap_time_seconds, row.practice_best_medium_lap_time_seconds) == (91.0, None)
    assert (row.qualifying_best_lap_time_seconds, row.qualifying_median_lap_time_seconds) == (88.0, 89.0)


def test_two_sprint_qualifyings_do_not_double_targets(season):
    rows = gold.gold_features(*season)
    assert rows.count() == 3 and quality.target_key_check(rows).first().repeated_keys == 0
    assert by_event(rows)["beta"].is_sprint_weekend and not by_event(rows)["gamma"].is_sprint_weekend


def test_weather_defaults(season):
    rows = by_event(gold.gold_features(*season))
    assert rows["gamma"].is_wet_race and rows["gamma"].temperature_max_c == 20.0
    assert rows["alpha"].is_wet_race is False and rows["alpha"].temperature_max_c is None
    missing = quality.missing_weather(events.qualifying_targets(season[0]), season[3]).collect()
    assert sorted(r.event for r in missing) == ["alpha", "beta"]


def test_target_filter_keeps_history(season):
    full = by_event(gold.gold_features(*season))["gamma"]
    limited = gold.gold_features(*season, event_year=2024, event="gamma").collect()
    assert limited == [full]


def test_labels(season):
    rows = by_event(gold.training_dataset(gold.gold_features(*season), season[0]))
    assert rows["gamma"].race_finishing_position == 1 and rows["beta"].race_finishing_position is None


def test_leakage_audit(season):
    results, _, sessions, _ = season
    targets = events.driver_targets(events.qualifying_targets(results), sessions)
    features = history.season_form(targets, results, sessions)
    assert quality.leakage_audit(features, results, sessions).first().violations == 0
    leaky = features.withColumn("season_points_to_date", F.coalesce("season_points_to_date", F.lit(0.0)) + 25)
    assert quality.leakage_audit(leaky, results, sessions).first().violations == 3


def test_null_dates_are_no_history(spark, season):
    results, _, sessions, _ = season
    undated = sessions.withColumn("session_date_utc", F.when(F.col("session") != "R", F.col("session_date_utc")))
    targets = events.driver_targets(events.qualifying_targets(results), undated)
    rows = history.season_form(targets, results, undated).collect()
    assert len(rows) == 3 and {r.last3_race_count for r in rows} == {None}


def test_copies_of_a_race_row_count_like_rows(spark):
    rows = [result(2024, "beta", "Q", 1, 1)] + [result(2024, "alpha", "R", 1, 2, 18.0)] * 5
    dates = [(2024, 1, "alpha", "R", "2024-01-11T14:00:00Z"), (2024, 2, "beta", "Q", "2024-02-10T14:00:00Z")]
    results, sessions = spark.createDataFrame(rows, RESULT), spark.createDataFrame(dates, SESSION)
    targets = events.driver_targets(events.qualifying_targets(results), sessions)
    row = history.season_form(targets, results, sessions).first()
    assert (row.last3_race_count, row.last3_race_points, row.last3_avg_finish) == (3, 54.0, 2.0)


def test_pace_against_brute_force(spark):
    """One driver has a third of all laps."""
    rng = random.Random(5)
    times = {d: [rng.randint(80_000, 95_000) / 1000 for _ in range(n)] for d, n in ((1, 900), (2, 1), (3, 2), (4, 897), (5, 900))}
    times[1] = [t if i % 3 else 84.125 for i, t in enumerate(times[1])]
    rows = [lap(2024, "alpha", "P1", d, t, "practice") for d, ts in times.items() for t in ts]
    got = {r.driver_number: r for r in pace.practice_pace(spark.createDataFrame(rows, LAP)).collect()}
    for driver, ts in times.items():
        row = got[driver]
        assert row.practice_laps_count == len(ts) and row.practice_best_lap_time_seconds == min(ts)
        assert row.practice_median_lap_time_seconds == pytest.approx(statistics.median(ts), abs=1e-9)
        assert row.practice_mean_lap_time_seconds == pytest.approx(statistics.mean(ts), abs=1e-9)
        if len(ts) == 1:
            assert row.practice_std_lap_time_seconds is None
        else:
            assert row.practice_std_lap_time_seconds == pytest.approx(statistics.stdev(ts), abs=1e-9)


def test_race_pace_history_matches_gold(season):
    results, laps, sessions, _ = season
    targets = events.driver_targets(events.qualifying_targets(results), sessions)
    alone = history.race_pace_history(targets, laps, sessions).first()
    row = by_event(gold.gold_features(*season))["gamma"]
    assert alone.hist_avg_race_lap_time == row.hist_avg_race_lap_time
    assert alone.hist_race_laps_count == row.hist_race_laps_count


def test_a_driver_with_very_many_results(spark):
    """Form and points of a driver whose races have tens of thousands of different result rows."""
    calendar = [(2024, k, f"e{k}", s, f"2024-0{k}-{10 + d}T14:00:00Z") for k in range(1, 6) for d, s in ((0, "Q"), (1, "R"))]
    sessions = spark.createDataFrame(calendar, SESSION)
    many = spark.range(60_000).selectExpr("id", "cast(id % 4 + 1 AS int) AS race", "cast(id AS int) AS place")
    rows = many.selectExpr(
        "2024 AS event_year", "concat('e', race) AS event", "'R' AS session", "1 AS driver_number", "place AS finishing_position",
        "id % 3 = 0 AS is_retired", "cast(id % 7 AS double) AS points",
    )
    targets = spark.createDataFrame([(2024, f"e{k}", 1, f"2024-0{k}-10T14:00:00Z") for k in range(1, 6)],
                                    "event_year int, event string, driver_number int, qualifying_session_date_utc string")
    form = history.season_form(targets, rows, sessions)
    found = {r.event: r for r in form.collect()}
    by_race = {}
    for i in range(60_000):
        by_race.setdefault(i % 4 + 1, []).append((i, i % 3 == 0, i % 7))
    for k in range(2, 6):
        before = [x for race in range(1, k) for x in by_race[race]]
        assert found[f"e{k}"].season_points_to_date == sum(x[2] for x in before)
        last = sorted(by_race[k - 1], reverse=True)[:3]
        assert found[f"e{k}"].last3_avg_finish == sum(x[0] for x in last) / 3
        assert (found[f"e{k}"].last3_dnfs, found[f"e{k}"].last3_race_points) == (sum(x[1] for x in last), sum(x[2] for x in last))
    assert found["e1"].last3_race_count is None
    assert "WindowGroupLimit" in form._jdf.queryExecution().executedPlan().toString()


def test_updates_equal_the_full_build_and_leave_the_rest(season, folder):
    """Events delivered one after the other; an event whose features cannot change keeps its files."""
    import pathlib

    results, laps, sessions, weather = season
    spark, keys = results.sparkSession, ["event_year", "event"]
    more = [result(y, e, "Q", 1, 2) for y in (2019, 2020, 2021, 2023) for e in ("alpha", "beta", "gamma")]
    results = results.union(spark.createDataFrame(more, RESULT))
    files = lambda: {p.relative_to(folder): p.stat().st_mtime_ns for p in pathlib.Path(folder).rglob("*.parquet")}
    deliveries = ["event_year < 2021", "event_year < 2024 AND event <> 'gamma'", "event_year < 2025"]
    before, seen = "false", {}
    for there in deliveries:
        now = [df.where(there) for df in (results, laps, sessions, weather)]
        changed = sessions.where(f"({there}) AND NOT ({before})").union(sessions.limit(0))
        rows = gold.gold_update(*now, changed)
        lake.write_partitioned(rows, folder, keys, whole=False)
        touched = {(r.event_year, r.event) for r in gold.affected_events(changed, events.qualifying_targets(now[0])).collect()}
        after = files()
        kept = {p for p in seen if tuple(x.split("=")[1] for x in p.parts[:2]) not in {(str(y), e) for y, e in touched}}
        assert all(after.get(p) == seen[p] for p in kept)
        before, seen = there, after
    assert ("2024", "gamma") in {tuple(x.split("=")[1] for x in p.parts[:2]) for p in seen}
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    stored = lake.read_partitioned(spark, folder, schema, keys)
    full = gold.gold_features(results.where("event_year <> 2019"), laps, sessions, weather)
    by_key = lambda df: sorted((str(r.asDict()) for r in df.select(*full.columns).collect()))
    assert by_key(stored.where("event_year <> 2019")) == by_key(full)


def test_update_reads_the_seasons_in_reach(season, folder):
    """The laps' files of seasons that no affected event looks back on are not read; without any affected event none are."""
    from eventrank.catalog.features import by_season

    results, laps, sessions, weather = season
    spark = results.sparkSession
    stored = by_season(laps.union(spark.createDataFrame([lap(2001, "alpha", "R", 1, 90.0)], LAP)))
    assert stored.columns == laps.columns

    def plan(changed):
        rows = gold.gold_update(results, stored, sessions, weather, changed)
        return rows._jdf.queryExecution().executedPlan().toString()

    latest = results.selectExpr("max(event_year) AS event_year").join(results.select("event_year", "event"), "event_year")
    first = latest.first().event_year - history.YEARS_BACK
    assert f">= {first})" in "".join(x for x in plan(latest).split("\n") if "PartitionFilters" in x)
    assert "seasons-" not in plan(latest.limit(0))
