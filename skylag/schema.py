"""Column names, key and schemas shared by all modules."""

from pyspark.sql import types as T

# A flight is one id on one sample date with one departure hour.
KEY = ["flight_id", "year", "month", "day", "dep_time"]

# Order of the samples inside a flight. Time decides; the other columns only
# make the order total, so that every run gives the same result.
ORDER = ["time", "lat", "lon", "eta", "arpt", "craft_type"]

# Columns kept for the delay analysis.
SAMPLE_COLUMNS = [
    "flight_id", "year", "month", "day", "time", "lat", "lon",
    "dep_time", "eta", "arpt", "craft_type",
]

TRACK_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("time", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("dest_lat", T.DoubleType()),
    T.StructField("dest_lon", T.DoubleType()),
    T.StructField("alt", T.DoubleType()),
    T.StructField("flight_id", T.StringType()),
    T.StructField("dep_airport", T.StringType()),
    T.StructField("arr_airport", T.StringType()),
    T.StructField("dep_time", T.DoubleType()),
    T.StructField("eta", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("heading", T.DoubleType()),
    T.StructField("craft_type", T.StringType()),
])

# Columns of an airport line, in file order. The last one is not kept.
AIRPORT_LINE_SCHEMA = T.StructType([
    T.StructField("a_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("faa", T.StringType()),
    T.StructField("icao", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("alt", T.DoubleType()),
    T.StructField("timezone", T.DoubleType()),
    T.StructField("dst", T.StringType()),
    T.StructField("zone_name", T.StringType()),
])
AIRPORT_COLUMNS = [f.name for f in AIRPORT_LINE_SCHEMA][:-1]
