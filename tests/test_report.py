"""The whole analysis: golden numbers, request rules, sinks."""

import json
from pathlib import Path

import pytest
from conftest import SF_CHECK, SF_SMALL
from helpers import samples_df

from skylag.plans.delay_report import delay_report, request_airports, write_delay_report
from skylag.sources import derived

# sf, airports, scoped samples, late, delayed flights, their samples, average, max, min, segments,
# late segments, sum of marker times
GOLDEN = [
    (SF_SMALL, ["N07"], 35, 8, 4, 29, 0.808333, (1.183333, "F0002", 1, "B2"), (0.316667, "F0000", 7, "B0"), 25, 8, 43.133333),
    (SF_CHECK, ["N07"], 294, 95, 31, 254, 4.976344, (25.466667, "F0009", 5, "B3"), (0.55, "F0016", 9, "B4"), 223, 95, 477.783333),
    (SF_SMALL, ["N03", "N06"], 18, 3, 2, 18, 1.133333, (1.316667, "F0000", 3, "B0"), (0.95, "F0000", 28, "B0"), 16, 3, 22.066667),
    (SF_CHECK, ["N03", "N06"], 71, 26, 9, 71, 6.359259, (24.966667, "F0003", 19, "B3"), (0.816667, "F0009", 29, "B3"), 62, 26, 135.916667),
]


def report_of(spark, sf_dir, codes, **options):
    return delay_report(
        derived.derived_samples(spark, sf_dir), derived.derived_airports(spark, sf_dir), codes, **options
    )


@pytest.mark.parametrize("golden", GOLDEN, ids=lambda g: f"{g[0][-5:]}-{'+'.join(g[1])}")
def test_golden_numbers(spark, golden):
    sf_dir, codes, scoped, late, flights, of_delayed, average, longest, shortest, segments, late_segments, times = golden
    result = report_of(spark, sf_dir, codes)
    assert result.scoped.count() == scoped
    summary = result.summary.first()
    assert summary.delayed_flights == flights
    assert round(summary.avg_delay, 6) == average
    assert (round(summary.max_delay, 6), summary.max_flight_id, summary.max_day, summary.max_craft_type) == longest
    assert (round(summary.min_delay, 6), summary.min_flight_id, summary.min_day, summary.min_craft_type) == shortest
    rows = result.tracks.collect()
    assert len(rows) == of_delayed and sum(r.late for r in rows) == late
    lines = result.layers["segments"].collect()
    assert len(lines) == segments and sum(r.color == "#FF0000" for r in lines) == late_segments
    markers = result.layers["markers"].collect()
    assert len(markers) == flights and round(sum(r.time for r in markers), 6) == times
    assert {r.color for r in markers} == {"0008B"}
    area = result.area.first()
    if codes == ["N07"]:
        assert tuple(area) == (30.5, 33.5, -107.5, -104.5)
    else:
        assert tuple(area) == (27.5, 31.5, -114.5, -107.5)
    assert tuple(result.center.first()) == ((area[0] + area[1]) / 2, (area[2] + area[3]) / 2)
    assert result.layers["boundary"].count() == 4


def test_missing_airport(spark):
    with pytest.raises(ValueError, match="N09$"):
        report_of(spark, SF_SMALL, ["N07", "N09"])


def test_request_rules():
    assert request_airports([]) == ["LAX"]
    assert request_airports(["SFO", "LAX"]) == ["SFO", "LAX"]
    assert request_airports(["SFO", "SFO"]) == ["SFO"]
    with pytest.raises(ValueError, match="JFK"):
        request_airports(["SFO", "LAX", "JFK"])


def test_options(spark):
    whole = report_of(spark, SF_CHECK, ["N07"]).scoped.count()
    assert report_of(spark, SF_CHECK, ["N07"], margin=0).scoped.count() < whole
    en_route = report_of(spark, SF_CHECK, ["N07"], status="E").scoped
    assert 0 < en_route.count() < whole and {r.status for r in en_route.collect()} == {"E"}


def texts(folder):
    return "".join(p.read_text() for p in sorted(Path(folder).glob("part-*")))


def test_written_report(spark, tmp_path):
    samples = samples_df(
        spark,
        {"time": 10.0, "eta": 11.0}, {"time": 12.25, "eta": 11.0, "lat": -34.005}, {"time": 11.5, "eta": 11.25},
        {"flight_id": "AAL2", "time": 11.1, "dep_time": 9.5, "eta": 11.0, "craft_type": "A320"},
        {"flight_id": "ZZZ9", "time": 9.1},
    )
    airports = derived.derived_airports(spark, SF_SMALL).limit(1).selectExpr(
        "'LAX' AS faa", "country", "double(0) AS lat", "double(-118) AS lon"
    )
    result = delay_report(samples, airports, margin=40)
    write_delay_report(result, str(tmp_path / "out"))
    assert not result.scoped.storageLevel.useMemory
    thin, thick = "-" * 54, "#" * 54
    assert texts(tmp_path / "out" / "delay_text") == "\n".join([
        "Number of delayed flights: 2", "Average Delay Time: 0.675",
        thin, "Max Delay:", thin,
        "Flight ID: UAL1", "Date: 2004-5-1", "Departure Time: 9.0", "Craft Type: B737", "Delay Time: 1.25",
        thin, "Min Delay:", thin,
        "Flight ID: AAL2", "Date: 2004-5-1", "Departure Time: 9.5", "Craft Type: A320", "Delay Time: 0.1",
        thick, "",
        "Flight ID: AAL2", "Date: 2004-5-1", "Departed Time: 9.5",
        "Time: 11.10\tLat: 34.00\tLon: -118.00\tStatus: Delayed", "", "",
        "Flight ID: UAL1", "Date: 2004-5-1", "Departed Time: 9.0",
        "Time: 10.00\tLat: 34.00\tLon: -118.00\tStatus: On-time",
        "Time: 11.50\tLat: 34.00\tLon: -118.00\tStatus: Delayed",
        "Time: 12.25\tLat: -34.01\tLon: -118.00\tStatus: Delayed", "", "",
    ]) + "\n"
    view = spark.read.parquet(str(tmp_path / "out" / "view")).first()
    assert (view.center_lat, view.center_lon, view.zoom) == (0.0, -118.0, 8)
    markers = spark.read.parquet(str(tmp_path / "out" / "layers" / "markers")).collect()
    assert {r.flight_id: r.comment for r in markers}["UAL1"] == (
        r"Flight ID: UAL1\nDate: 2004-5-1\nDeparted Time: 9.0\nETA: 11.0\nAirport: LAX\nTime: 11.5\n"
    )
    assert spark.read.parquet(str(tmp_path / "out" / "flight_delay")).count() == 2
    assert spark.read.parquet(str(tmp_path / "out" / "layers" / "segments")).count() == 2
    features = [json.loads(line) for line in texts(tmp_path / "out" / "layers" / "paths").splitlines()]
    assert [f["properties"]["flight_id"] for f in features] == ["UAL1"]


def test_no_delayed_flight(spark):
    airports = derived.derived_airports(spark, SF_SMALL)
    result = delay_report(derived.derived_samples(spark, SF_SMALL).where("time < -1"), airports, ["N07"])
    assert result.summary.first().delayed_flights == 0
    lines = [r.line for r in result.lines.orderBy("section", "line_no").collect()]
    assert len(lines) == 20
    assert lines[:2] == ["Number of delayed flights: 0", "Average Delay Time: None"]
    assert lines[5:7] == ["Flight ID: None", "Date: None"]
    assert all(layer.count() == 0 for name, layer in result.layers.items() if name != "boundary")


def counted(spark, samples):
    """The samples, and an accumulator of the rows that were read of them."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return samples.mapInArrow(count, samples.schema), read


def test_samples_are_read_twice_at_most(spark, tmp_path):
    """For the whole written analysis, and for the lines of a scoped one."""
    samples, read = counted(spark, derived.derived_samples(spark, SF_SMALL).coalesce(2))
    airports = derived.derived_airports(spark, SF_SMALL)
    result = delay_report(samples, airports, ["N07"])
    n_samples = samples.count()
    read.value = 0
    write_delay_report(result, str(tmp_path / "out"))
    assert n_samples <= read.value <= 2 * n_samples
    assert not result.tables.names and not [t for t in spark.catalog.listTables() if t.name in str(result.tracks)]
    read.value = 0
    with delay_report(samples, airports, ["N07"]) as again:
        again.lines.collect()
        assert read.value <= 2 * n_samples
        names = list(again.tables.names)
        assert all(spark.catalog.tableExists(n) for n in names)
    assert names and not any(spark.catalog.tableExists(n) for n in names)


def test_line_numbers(spark):
    """The numbers are the places in the order of the report, also over many ranges."""
    samples = derived.derived_samples(spark, SF_CHECK)
    with delay_report(samples, derived.derived_airports(spark, SF_CHECK), ["N07"], heavy_samples=9) as result:
        rows = result.numbered_lines.orderBy("section", "flight_id", "year", "month", "day", "dep_time", "line_no").collect()
        assert [r.report_no for r in rows] == list(range(1, len(rows) + 1))
        assert sorted(map(str, result.lines.collect())) == sorted(str(r).rsplit(", report_no", 1)[0] + ")" for r in rows)


def test_two_decimals_of_the_fixture(spark):
    """The text of every position and time is that of printf."""
    from skylag.functions.text import two_decimals

    rows = derived.derived_samples(spark, SF_CHECK).selectExpr(
        *[f"{c} AS {c}" for c in ("time", "lat", "lon")], *[f"{two_decimals(c)} AS {c}_text" for c in ("time", "lat", "lon")]
    ).collect()
    assert len(rows) == 10_000
    assert all(r[f"{c}_text"] == "%.2f" % r[c] for r in rows for c in ("time", "lat", "lon"))
