import bz2

import pytest
from conftest import SF_SMALL
from helpers import AIRPORT_LINES, sample_rows, samples_df
from pyspark.errors import AnalysisException

from skylag.operators import scope
from skylag.sources import derived
from skylag.sources.airports import parse_airport_lines, read_airports
from skylag.sources.dates import DateSpec
from skylag.sources.tracks import (
    parse_track_lines, read_sample_table, read_tracks, scan_counts, write_sample_table,
)

LINE = "2004-05-01|10.5|33.9|-118.4|33.94|-118.41|350|UAL1|JFK|LAX|9.0|11.25|E|450|270|B737"
DAYS = [(2004, 5, 1), (2004, 5, 2), (2004, 6, 1), (2005, 5, 1)]


@pytest.mark.parametrize("text, path", [
    ("2004/5/1", "/a/2004/200405m/tsmft20040501.bz2"),
    ("2004//", "/a/2004/*/*"),
    ("//", "/a/*/*/*"),
    ("/5/", "/a/*/*05m/*"),
    ("/5/1", "/a/*/*05m/tsmft*0501.bz2"),
    ("//1", "/a/*/*/tsmft*01.bz2"),
    ("2004//1", "/a/2004/*/tsmft2004*01.bz2"),
    ("2004/12/31\n", "/a/2004/200412m/tsmft20041231.bz2"),
])
def test_date_spec_glob(text, path):
    assert DateSpec.parse(text).glob("/a") == path


@pytest.mark.parametrize("text", ["2004/5", "1999//", "2006//", "/13/", "/0/", "//32", "//0", "a//"])
def test_bad_date_specs(text):
    with pytest.raises(ValueError):
        DateSpec.parse(text)


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    root = tmp_path_factory.mktemp("archive")
    for n, (y, m, d) in enumerate(DAYS):
        folder = root / f"{y}" / f"{y}{m:02d}m"
        folder.mkdir(parents=True, exist_ok=True)
        lines = [LINE.replace("2004-05-01", f"{y}-{m}-{d}")] * (n + 1)
        (folder / f"tsmft{y}{m:02d}{d:02d}.bz2").write_bytes(bz2.compress("\n".join(lines).encode()))
    return str(root)


@pytest.mark.parametrize("text", ["2004/5/1", "2004//", "//", "/5/", "/5/1", "//1", "2004//1"])
def test_glob_and_predicate_agree(spark, archive, text):
    spec = DateSpec.parse(text)
    from_files = scan_counts(read_tracks(spark, archive, spec)).collect()
    from_table = scan_counts(read_tracks(spark, archive).where(spec.predicate())).collect()
    assert sorted(from_files) == sorted(from_table) and from_files


def test_missing_day_fails(spark, archive):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_tracks(spark, archive, DateSpec.parse("2004/2/31")).count()


def lines_df(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_line_decode(spark):
    row = parse_track_lines(lines_df(spark, f"  {LINE}|extra|fields\t")).first()
    assert tuple(row) == sample_rows({"time": 10.5, "lat": 33.9, "lon": -118.4, "eta": 11.25})[0]


@pytest.mark.parametrize("bad", [
    LINE.replace("10.5", "ten"), LINE.replace("2004-05-01", "2004-05"), "|".join(LINE.split("|")[:-1]), "",
])
def test_bad_line_fails_the_job(spark, bad):
    with pytest.raises(Exception, match="bad track line"):
        parse_track_lines(lines_df(spark, bad)).count()


def test_airport_lines_and_file_agree(spark, tmp_path):
    path = tmp_path / "airports.dat"
    path.write_text("\n".join(AIRPORT_LINES) + "\n\n")
    rows = read_airports(spark, str(path)).collect()
    assert sorted(rows) == sorted(parse_airport_lines(lines_df(spark, *AIRPORT_LINES, "")).collect())
    first = next(r for r in rows if r.faa == "AJF")
    assert tuple(first) == (
        "5925", "Al-Jawf Domestic Airport", "Al-Jawf", "Saudi Arabia", "AJF", "OESK",
        29.785133, 40.100006, 2261.0, 3.0, "U",
    )
    assert "San Francisco, Intl" in {r.name for r in rows}


@pytest.mark.parametrize("bad, error", [
    (AIRPORT_LINES[0].replace("29.785133", "north"), "CAST_INVALID_INPUT"),
    (AIRPORT_LINES[0].replace("29.785133", ""), "missing fields"),
    (AIRPORT_LINES[0].rsplit(",", 2)[0], "missing fields"),
])
def test_bad_airport_line_fails_the_job(spark, bad, error):
    with pytest.raises(Exception, match=error):
        parse_airport_lines(lines_df(spark, bad)).collect()


def test_airport_line_with_further_or_empty_fields(spark):
    more = AIRPORT_LINES[0] + ',"airport","OurAirports"'
    empty = AIRPORT_LINES[0].replace('"AJF"', '""')
    rows = parse_airport_lines(lines_df(spark, AIRPORT_LINES[0], more, empty)).collect()
    assert rows[0] == rows[1]
    assert rows[2].faa == "" and rows[2].icao == "OESK"


def test_sample_table_prunes_partitions_and_pushes_bounds(spark, tmp_path):
    samples = derived.derived_samples(spark, SF_SMALL)
    path = str(tmp_path / "samples")
    write_sample_table(samples, path)
    spec = DateSpec.parse("2024/1/7", years=(2024, 2024))
    day = read_sample_table(spark, path, spec)
    assert sorted(day.collect()) == sorted(samples.where(spec.predicate()).collect())

    airports = derived.derived_airports(spark, SF_SMALL)
    area = scope.airport_area(airports, ["N07"])
    plans = {}
    for name, bounds in {"row": area.first(), "table": area}.items():
        scoped = scope.scope_samples(day, bounds, ["N07"])
        expected = scope.scope_samples(samples.where(spec.predicate()), bounds, ["N07"])
        assert sorted(scoped.collect()) == sorted(expected.collect())
        plans[name] = scoped._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plans["row"]
    assert "GreaterThanOrEqual(lat,29.5)" in plans["row"]
    assert "EqualTo(arr_airport,N07)" in plans["row"]
    # Bounds read by subquery join nothing and shuffle no sample.
    assert "Join" not in plans["table"]


def test_status_filter(spark):
    df = samples_df(spark, {"status": "P"}, {"status": "E"})
    assert [r.status for r in scope.filter_status(df).collect()] == ["E"]
