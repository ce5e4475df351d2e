"""Text report of the delayed flights."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.functions.text import FLIGHT_DATE, short_number, two_decimals
from skylag.operators.series import counted_before
from skylag.operators.tracks import FLIGHT
from skylag.schema import KEY
from skylag.sources.stored import StoredTables

# Rules between the parts of the report.
THIN_RULE = "-" * 54
THICK_RULE = "#" * 54

REPORT_ORDER = ["section", *KEY, "line_no"]
# Lines of the header, and of a flight before and after those of its samples.
HEADER_LINES, FIRST_LINES, LAST_LINES = 20, 3, 2


def _flight_lines(prefix: str) -> list[str]:
    date = f"concat_ws('-', {prefix}_year, {prefix}_month, {prefix}_day)"
    values = {
        "Flight ID": f"{prefix}_flight_id",
        "Date": f"nullif({date}, '')",
        "Departure Time": short_number(f"{prefix}_dep_time"),
        "Craft Type": f"{prefix}_craft_type",
        "Delay Time": short_number(f"{prefix}_delay"),
    }
    return [f"concat('{name}: ', coalesce({text}, 'None'))" for name, text in values.items()]


def header_lines(summary: DataFrame) -> DataFrame:
    """Section 0: the statistics."""
    thin, thick = f"'{THIN_RULE}'", f"'{THICK_RULE}'"
    lines = [
        "concat('Number of delayed flights: ', delayed_flights)",
        f"concat('Average Delay Time: ', coalesce({short_number('avg_delay')}, 'None'))",
        thin, "'Max Delay:'", thin, *_flight_lines("max"),
        thin, "'Min Delay:'", thin, *_flight_lines("min"),
        thick, "''",
    ]
    return summary.selectExpr(f"posexplode(array({', '.join(lines)})) AS (pos, line)").selectExpr(
        "0 AS section",
        "cast(NULL AS string) AS flight_id",
        *[f"cast(NULL AS int) AS {c}" for c in ("year", "month", "day")],
        "cast(NULL AS double) AS dep_time",
        "cast(pos + 1 AS bigint) AS line_no",
        "line",
    )


def flight_lines(tracks: DataFrame) -> DataFrame:
    """Section 1: three lines before the samples of a flight, one per sample, two blank ones after."""
    before = [
        "concat('Flight ID: ', flight_id)",
        f"concat('Date: ', {FLIGHT_DATE})",
        f"concat('Departed Time: ', {short_number('dep_time')})",
    ]
    sample = f"""concat('Time: ', {two_decimals('time')}, '\\tLat: ', {two_decimals('lat')},
        '\\tLon: ', {two_decimals('lon')}, '\\tStatus: ', if(late, 'Delayed', 'On-time'))"""
    lines = f"""concat(
        if(seq = 1, array({', '.join(before)}), array()),
        array({sample}),
        if(is_last, array('', ''), array()))"""
    kept = [c for c in ("lines_before",) if c in tracks.columns]
    numbered = tracks.selectExpr(
        *KEY, *kept, f"if(seq = 1, 1L, seq + {FIRST_LINES}) AS first_no", f"posexplode({lines}) AS (pos, line)"
    )
    return numbered.selectExpr("1 AS section", *KEY, *kept, "first_no + pos AS line_no", "line")


def with_lines_before(tracks: DataFrame, tables: StoredTables) -> DataFrame:
    """Tracks with ``lines_before``, the flight lines of all flights with smaller keys.

    Sums over ranges of keys, then inside a range; the result is stored bucketed like the
    tracks, so that the join moves neither.
    """
    sizes = tracks.where("is_last").selectExpr(*KEY, *FLIGHT, f"seq + {FIRST_LINES + LAST_LINES} AS n_lines")
    before = counted_before(sizes, KEY, "n_lines", tables)
    own = {c: f"of_{c}" for c in FLIGHT}
    before = before.select(*[F.col(c).alias(o) for c, o in own.items()], F.col("before").alias("lines_before"))
    before = tables.store(before, list(own.values()))
    return tracks.join(before, F.expr(" AND ".join(f"{c} = {o}" for c, o in own.items()))).drop(*own.values())


def report_lines(summary: DataFrame, tracks: DataFrame) -> DataFrame:
    """All lines of the report, each with its place in its part; sorting is left to the sink."""
    return header_lines(summary).unionByName(flight_lines(tracks))


def numbered_report_lines(summary: DataFrame, tracks: DataFrame, tables: StoredTables | None = None) -> DataFrame:
    """The same lines with ``report_no``, their place in the whole report."""
    lines = flight_lines(with_lines_before(tracks, tables or StoredTables(tracks.sparkSession)))
    lines = lines.selectExpr("* EXCEPT (lines_before)", f"lines_before + line_no + {HEADER_LINES} AS report_no")
    return header_lines(summary).selectExpr("*", "line_no AS report_no").unionByName(lines)


def write_report(lines: DataFrame, path: str, mode: str = "error") -> None:
    """Write the lines in order as text part files.

    The sort is a range shuffle over line numbers, so a long flight spans several
    files; read in name order they give the whole report.
    """
    order = ["report_no"] if "report_no" in lines.columns else REPORT_ORDER
    lines.orderBy(*order).select("line").write.mode(mode).text(path)
