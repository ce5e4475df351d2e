"""Airport lookup, area around the airports, and the filters that scope the samples."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# Degrees around one airport, around each of two, and the margin of the filter.
ONE_AIRPORT_DEG = 1.5
TWO_AIRPORT_DEG = 0.5
MARGIN_DEG = 1.0
COUNTRY = "United States"

BOUNDS = ["lat_min", "lat_max", "lon_min", "lon_max"]


def lookup_airports(airports: DataFrame, codes: Sequence[str]) -> DataFrame:
    return airports.where(F.col("faa").isin(list(codes)) & (F.col("country") == COUNTRY))


def missing_airports(airports: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Requested codes without a matching airport, one row each.

    One scan of the airports with one flag per code; a request holds two codes.
    """
    wanted = sorted(set(codes))
    flags = airports.where(F.col("country") == COUNTRY).agg(
        F.array(*[
            F.struct(
                F.lit(code).alias("faa"),
                F.coalesce(F.bool_or(F.col("faa") == code), F.lit(False)).alias("found"),
            )
            for code in wanted
        ]).alias("codes")
    )
    return flags.select(F.inline("codes")).where(~F.col("found")).select("faa")


def _bounds(codes: Sequence[str]) -> list[Column]:
    reach = ONE_AIRPORT_DEG if len(set(codes)) == 1 else TWO_AIRPORT_DEG
    return [
        F.min(F.col("lat") - reach).alias("lat_min"),
        F.max(F.col("lat") + reach).alias("lat_max"),
        F.min(F.col("lon") - reach).alias("lon_min"),
        F.max(F.col("lon") + reach).alias("lon_max"),
    ]


def airport_area(airports: DataFrame, codes: Sequence[str]) -> DataFrame:
    """One row with the bounds around the requested airports."""
    return lookup_airports(airports, codes).agg(*_bounds(codes))


def checked_area(airports: DataFrame, codes: Sequence[str]) -> Row:
    """The bounds as a row at hand; raises if one of the airports is missing.

    This runs a job over the airports. One row with at most the requested codes
    comes to the driver.
    """
    found = F.collect_set("faa").alias("found")
    row = lookup_airports(airports, codes).agg(*_bounds(codes), found).first()
    missing = sorted(set(codes) - set(row.found))
    if missing:
        raise ValueError(f"airports not found: {', '.join(missing)}")
    return row


def area_center(area: DataFrame) -> DataFrame:
    return area.select(
        ((F.col("lat_min") + F.col("lat_max")) / 2).alias("center_lat"),
        ((F.col("lon_min") + F.col("lon_max")) / 2).alias("center_lon"),
    )


def filter_area(samples: DataFrame, area: DataFrame | Row, margin: float = MARGIN_DEG) -> DataFrame:
    """Samples inside the area widened by ``margin`` degrees, bounds included.

    ``area`` is a one-row DataFrame, read through scalar subqueries, or a row at
    hand, whose bounds become literals and reach the file scan as pushed filters.
    """
    low_lat, high_lat, low_lon, high_lon = (
        F.lit(area[b]) if isinstance(area, Row) else area.select(b).scalar() for b in BOUNDS
    )
    return samples.where(
        (F.col("lat") >= low_lat - margin) & (F.col("lat") <= high_lat + margin)
        & (F.col("lon") >= low_lon - margin) & (F.col("lon") <= high_lon + margin)
    )


def on_route(codes: Sequence[str]) -> Column:
    """One airport: it is the arrival. Two: departure and arrival are both among them."""
    codes = sorted(set(codes))
    ends = ["arr_airport"] if len(codes) == 1 else ["arr_airport", "dep_airport"]
    return reduce(lambda a, b: a & b, [F.col(c).isin(codes) for c in ends])


def filter_route(samples: DataFrame, codes: Sequence[str]) -> DataFrame:
    return samples.where(on_route(codes))


def filter_status(samples: DataFrame, status: str = "E") -> DataFrame:
    return samples.where(F.col("status") == status)


def scope_samples(
    samples: DataFrame,
    area: DataFrame | Row,
    codes: Sequence[str],
    margin: float = MARGIN_DEG,
    status: str | None = None,
) -> DataFrame:
    """Area, route and optional status filter; all of them narrow, none shuffles."""
    scoped = filter_route(filter_area(samples, area, margin), codes)
    return filter_status(scoped, status) if status else scoped
