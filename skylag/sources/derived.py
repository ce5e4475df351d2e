"""Track samples and airports derived from the benchmark tables.

Samples come from ``events``; 25 airports come from ``nation`` (they are the ones
flights use) and one airfield from each ``customer``, so both sides grow.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.schema import AIRPORT_COLUMNS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    hubs = _table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey AS string) AS a_id",
        "n_name AS name",
        "concat('City, ', n_name) AS city",
        "if(n_regionkey < 4, 'United States', 'Elsewhere') AS country",
        "concat('N', lpad(n_nationkey, 2, '0')) AS faa",
        "concat('KN', lpad(n_nationkey, 2, '0')) AS icao",
        "double(25 + n_nationkey) AS lat",
        "double(-120 + 2 * n_nationkey) AS lon",
        "double(n_nationkey * 10) AS alt",
        "double(-n_regionkey) AS timezone",
        "'A' AS dst",
    )
    fields = _table(spark, sf_dir, "customer").selectExpr(
        "concat('C', lpad(c_custkey, 9, '0')) AS a_id",
        "c_name AS name",
        "concat('City, ', c_mktsegment) AS city",
        "if(c_nationkey % 5 < 4, 'United States', 'Elsewhere') AS country",
        "concat('C', lpad(c_custkey, 9, '0')) AS faa",
        "concat('KC', lpad(c_custkey, 9, '0')) AS icao",
        "25D + double(c_custkey % 4001) / 100 AS lat",
        "-120D + double(c_custkey * 7 % 5003) / 100 AS lon",
        "double(c_custkey % 9000) AS alt",
        "double(-(c_nationkey % 5)) AS timezone",
        "'U' AS dst",
    )
    return hubs.unionAll(fields)


def derived_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eighteen-column samples: whole-number arithmetic followed by one division."""
    keys = _table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type", "cast(floor(user_id / 5) AS bigint) AS f",
        "year(ts) AS year", "month(ts) AS month", "day(ts) AS day",
    )
    legs = keys.selectExpr(
        "*",
        "(f * 37 + day * 211) % 1440 AS dep_min",
        "60 + (f * 13 + day * 29) % 300 AS dur",
        "(f * 3 + day) % 25 AS arr",
        "(f * 5 + day * 2) % 25 AS dep",
    )
    return legs.selectExpr(
        "year", "month", "day",
        "double(dep_min + event_id * 17 % (dur + 90)) / 60 AS time",
        "double(25 + arr) + double(event_id * 7919 % 6001 - 3000) / 1000 AS lat",
        "double(-120 + 2 * arr) + double(event_id * 104729 % 6001 - 3000) / 1000 AS lon",
        "double(25 + arr) AS dest_lat",
        "double(-120 + 2 * arr) AS dest_lon",
        "double(event_id % 400) AS alt",
        "concat('F', lpad(f, 4, '0')) AS flight_id",
        "concat('N', lpad(dep, 2, '0')) AS dep_airport",
        "concat('N', lpad(arr, 2, '0')) AS arr_airport",
        "double(dep_min) / 60 AS dep_time",
        "double((dep_min + dur) % 1440) / 60 AS eta",
        "if(event_type = 'signup', 'P', 'E') AS status",
        "double(300 + event_id % 200) AS speed",
        "double(event_id % 360) AS heading",
        "concat('B', f % 6) AS craft_type",
    )


def track_lines(samples: DataFrame) -> DataFrame:
    """Samples as ``|``-separated text lines."""
    date = F.concat_ws("-", "year", "month", "day")
    rest = [
        "time", "lat", "lon", "dest_lat", "dest_lon", "alt", "flight_id", "dep_airport",
        "arr_airport", "dep_time", "eta", "status", "speed", "heading", "craft_type",
    ]
    return samples.select(F.concat_ws("|", date, *rest).alias("value"))


def airport_lines(airports: DataFrame) -> DataFrame:
    """Airports as comma-separated text lines with quoted names."""
    quoted = {"name", "city", "country", "faa", "icao", "dst"}
    parts = [
        F.concat(F.lit('"'), F.col(c), F.lit('"')) if c in quoted else F.col(c).cast("string")
        for c in AIRPORT_COLUMNS
    ]
    return airports.select(F.concat_ws(",", *parts, F.lit('"Zone/Name"')).alias("value"))
