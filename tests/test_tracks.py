"""Ordered tracks against a plain computation, with ordinary and with heavy flights."""

import math
import random

import pytest
from conftest import SF_CHECK, SF_SMALL
from helpers import changed, samples_df

from skylag.operators import delays, layers, series, tracks
from skylag.plans import report
from skylag.schema import KEY, ORDER
from skylag.sources import derived
from skylag.sources.stored import StoredTables


def brute_force(samples):
    """Key -> ordered samples of delayed flights, as dicts with late, seq and prev."""
    flights = {}
    for row in delays.label_samples(samples).collect():
        flights.setdefault(tuple(row[c] for c in KEY), []).append(row.asDict())
    result = {}
    for key, rows in flights.items():
        if any(r["late"] for r in rows):
            rows.sort(key=lambda r: (math.isnan(r["time"]), *[r[c] for c in ORDER if r[c] == r[c]]))
            prev = (None, None)
            for i, r in enumerate(rows):
                r["seq"], r["prev_lat"], r["prev_lon"] = i + 1, *prev
                r["is_last"] = i + 1 == len(rows)
                prev = (r["lat"], r["lon"])
            result[key] = rows
    return result


def skewed(spark, constant_time=False):
    """A third of the samples in one late flight, a third in one on time, with copies and ties."""
    rnd = random.Random(7)
    rows = []
    for n in range(900):
        flight = ["HOT", "CALM", f"F{n % 40}"][n % 3]
        time = 10.0 if constant_time else rnd.choice([round(rnd.uniform(9, 14), 2), 12.0])
        rows.append({
            "flight_id": flight, "time": time, "eta": 30.0 if flight == "CALM" else rnd.choice([9.5, 11.0, 15.0]),
            "lat": rnd.randint(30, 32) + 0.5, "lon": -rnd.randint(100, 102) - 0.5,
            "craft_type": rnd.choice(["A", "B"]),
        })
    return samples_df(spark, *rows).repartition(7)


COLUMNS = [*KEY, *ORDER, "late", "label", "seq", "prev_lat", "prev_lon", "is_last"]


def check(samples, heavy_samples):
    want = sorted(
        (tuple(str(r[c]) for c in COLUMNS) for rows in brute_force(samples).values() for r in rows)
    )
    got = tracks.delayed_tracks(samples, heavy_samples).select(*COLUMNS).collect()
    assert sorted(tuple(str(v) for v in r) for r in got) == want
    return want


@pytest.mark.parametrize("heavy_samples", [1, 10, 100, 1_000_000])
@pytest.mark.parametrize("constant_time", [False, True])
def test_skewed_flights(spark, heavy_samples, constant_time):
    assert check(skewed(spark, constant_time), heavy_samples)


@pytest.mark.parametrize("heavy_samples", [3, 1_000_000])
def test_derived_flights(spark, heavy_samples):
    assert check(derived.derived_samples(spark, SF_SMALL), heavy_samples)


def test_every_heavy_flight_is_cut(spark):
    samples = skewed(spark)
    summary = tracks.flight_summary(samples)
    assert tracks.heavy_flights(summary, 5).count() == summary.where("samples > 5").count() > 2
    assert check(samples, 5)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_no_task_holds_a_heavy_flight(spark):
    """A flight whose samples all fall into one second, most of them equal, is ordered by several tasks."""
    rows = [{"flight_id": "HOT", "time": 12.0 + n % 3 / 10_000, "lat": 30.0 + n % 5, "eta": 11.0} for n in range(900)]
    samples = samples_df(spark, *rows, *[{"flight_id": f"F{n}", "time": 12.0} for n in range(300)]).repartition(6)
    tables = StoredTables(spark)
    heavy = tracks.heavy_flights(tracks.flight_summary(samples), 100)
    ordinary, cut = tracks.split_flights(samples, heavy)
    assert {r.flight_id for r in ordinary.collect()} == {f"F{n}" for n in range(300)}
    with_settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with changed(spark, with_settings):
        series.numbered(cut, tracks.FLIGHT, ORDER, tables).count()
    parts = [r["count"] for r in spark.table(tables.names[0]).groupBy("_part").count().collect()]
    assert len(parts) >= 6 and max(parts) < 300 and sum(parts) == 900
    tables.drop()
    check(samples, 100)


def test_heavy_flights_without_broadcast(spark):
    """Heavy flights and ranges may be too many to broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    with changed(spark, dict.fromkeys(names, "-1")):
        check(derived.derived_samples(spark, SF_CHECK), 10)


def test_times_outside_the_slices(spark):
    times = [float("nan"), float("inf"), -3.0, -0.001, 0.0, 47.999, 48.0, 50.0, 999999.0, 47.9999999, 12.0]
    check(samples_df(spark, *[{"time": t, "lat": float(i)} for i, t in enumerate(times * 3)]), 5)


def test_copies(spark):
    """One sample makes up a third of all."""
    copies = [{"flight_id": "HOT", "time": 12.0, "eta": 11.0}] * 50
    others = [{"flight_id": "HOT", "time": 11.99 + n / 1000, "lat": float(n)} for n in range(20)]
    rest = [{"flight_id": f"F{n % 9}", "time": 9.0 + n / 10} for n in range(80)]
    samples = samples_df(spark, *copies, *others, *rest).repartition(5)
    check(samples, 20)
    paths = tracks.flight_tracks(tracks.delayed_tracks(samples, 20), 8)
    assert paths.where("flight_id = 'HOT'").agg({"samples": "sum"}).first()[0] == 70


def test_join_and_window_forms_agree(spark):
    for samples in (skewed(spark), derived.derived_samples(spark, SF_SMALL)):
        joined = tracks.delayed_flight_samples(samples)
        window = tracks.delayed_flight_samples_window(samples).select(*joined.columns)
        assert executed(window).count("Scan") == 1
        assert sorted(map(str, joined.collect())) == sorted(map(str, window.collect()))


def test_segments_and_markers_count(spark):
    samples = derived.derived_samples(spark, SF_CHECK)
    ordered = tracks.delayed_tracks(samples)
    n_samples, n_flights = ordered.count(), delays.delayed_flight_keys(samples).count()
    segments = tracks.track_segments(ordered)
    assert segments.count() == n_samples - n_flights
    assert layers.first_late_marker(samples).count() == n_flights == 849
    # Over all flights, delayed or not, there would be 9,100 segments.
    assert sum(r.samples - 1 for r in tracks.flight_summary(samples).collect()) == 9100


@pytest.mark.parametrize("heavy_samples, path_samples", [(1_000_000, 10_000), (50, 7), (1_000_000, 7)])
def test_paths_hold_every_sample_once(spark, heavy_samples, path_samples):
    samples = skewed(spark)
    paths = tracks.flight_tracks(tracks.delayed_tracks(samples, heavy_samples), path_samples)
    flights = {}
    for row in paths.collect():
        assert row.samples == len(row.path) <= path_samples
        assert row.start == row.path[0].seq
        flights.setdefault(tuple(row[c] for c in KEY), []).extend(row.path)
    want = brute_force(samples)
    assert flights.keys() == want.keys()
    for key, path in flights.items():
        path.sort()
        assert [(p.seq, p.time, p.lat, p.lon, p.label) for p in path] == [
            (r["seq"], r["time"], r["lat"], r["lon"], r["label"]) for r in want[key]
        ]


def test_same_result_for_any_partitioning(spark):
    samples = skewed(spark)
    results = []
    for parts in (1, 3, 16):
        moved = samples.repartition(parts, "lat", "time")
        ordered = tracks.delayed_tracks(moved, 40)
        results.append((
            sorted(map(str, tracks.track_segments(ordered).collect())),
            sorted(map(str, delays.flight_delay(moved).collect())),
            sorted(map(str, layers.first_late_marker(moved).collect())),
        ))
    assert results[0] == results[1] == results[2]


def test_heavy_join_is_split_by_adaptive_execution(spark):
    """The semi join form: a skewed left side is split at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with changed(spark, settings):
        samples = skewed(spark)
        joined = tracks.delayed_flight_samples(samples)
        assert joined.count() == sum(len(rows) for rows in brute_force(samples).values())
        assert "skew=true" in executed(joined)


@pytest.mark.parametrize("heavy_samples", [10, 1_000_000])
def test_nothing_moves_above_the_stored_tracks(spark, heavy_samples):
    """Segments, paths, GeoJSON, ends and report read the bucketed table without a shuffle of its rows."""
    samples = derived.derived_samples(spark, SF_CHECK)
    stored = tracks.delayed_tracks(samples, heavy_samples)
    frames = [tracks.track_segments(stored), tracks.flight_tracks(stored), layers.track_geojson(stored)]
    for frame in frames:
        plan = executed(frame)
        assert "Exchange" not in plan and plan.count("FileScan") == 1
    if heavy_samples > 10:
        with changed(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
            tables = StoredTables(spark)
            assert "Exchange" not in executed(report.flight_lines(report.with_lines_before(stored, tables)))
            assert "Exchange" not in executed(tracks.track_ends(stored))
            tables.drop()


@pytest.mark.parametrize("heavy_samples", [10, 1_000_000])
def test_ends_of_tracks_and_of_samples_agree(spark, heavy_samples):
    for samples in (skewed(spark), skewed(spark, True), derived.derived_samples(spark, SF_CHECK)):
        by_track = tracks.track_ends(tracks.delayed_tracks(samples, heavy_samples))
        by_time = delays.flight_ends(samples).select(*by_track.columns)
        assert sorted(map(str, by_track.collect())) == sorted(map(str, by_time.collect()))


def test_first_samples_need_no_sort_aggregate(spark):
    samples = derived.derived_samples(spark, SF_SMALL)
    for frame in (layers.first_late_marker(samples), delays.first_sample_attrs(samples)):
        assert "SortAggregate" not in executed(frame)


def test_time_that_is_null_comes_first(spark):
    rows = [{"time": None, "lat": 1.0}, {"time": None, "lat": 0.5}, {"time": 30.0}, {"time": float("nan")}, {"time": 9.5, "eta": 10.0}]
    end = delays.flight_ends(samples_df(spark, *rows)).first()
    assert (end.first.time, end.first.lat, end.first_late.lat) == (None, 0.5, 0.5)
    check(samples_df(spark, *[r for r in rows if r["time"] is not None] * 4), 3)


def test_bloom_filter_of_the_delayed_keys(spark):
    """Spark's runtime filter on the hash of the key reaches the scan of the samples."""
    filters = "spark.sql.optimizer.runtime.bloomFilter"
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        f"{filters}.enabled": "true", f"{filters}.applicationSideScanSizeThreshold": "1", f"{filters}.creationSideThreshold": "1TB",
    }
    samples = derived.derived_samples(spark, SF_CHECK)
    want = sorted(map(str, tracks.delayed_flight_samples(samples).collect()))
    with changed(spark, settings):
        filtered = tracks.delayed_flight_samples(samples, bloom_filter=True)
        assert "might_contain" in executed(filtered)
        assert sorted(map(str, filtered.collect())) == want


def test_report_of_heavy_flights(spark):
    samples = skewed(spark)
    summary = delays.delay_summary(delays.flight_delay(samples))
    whole, cut = (
        report.report_lines(summary, tracks.delayed_tracks(samples, n)) for n in (1_000_000, 30)
    )
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))
    n_samples = sum(len(rows) for rows in brute_force(samples).values())
    assert whole.count() == 20 + n_samples + 5 * len(brute_force(samples))
