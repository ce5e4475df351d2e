"""Small sample tables for tests."""

from contextlib import contextmanager

from skylag.schema import TRACK_SCHEMA

DEFAULTS = {
    "year": 2004, "month": 5, "day": 1, "time": 10.0, "lat": 34.0, "lon": -118.0,
    "dest_lat": 33.94, "dest_lon": -118.41, "alt": 350.0, "flight_id": "UAL1",
    "dep_airport": "JFK", "arr_airport": "LAX", "dep_time": 9.0, "eta": 11.0,
    "status": "E", "speed": 450.0, "heading": 270.0, "craft_type": "B737",
}


def sample_rows(*changes):
    return [tuple({**DEFAULTS, **change}[f.name] for f in TRACK_SCHEMA) for change in changes]


def samples_df(spark, *changes):
    return spark.createDataFrame(sample_rows(*changes), TRACK_SCHEMA)


@contextmanager
def changed(spark, settings):
    """Session settings for the length of a block."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Lines in the public airport file's format.
AIRPORT_LINES = [
    '5925,"Al-Jawf Domestic Airport","Al-Jawf","Saudi Arabia","AJF","OESK",29.785133,40.100006,2261,3,"U","Asia/Riyadh"',
    '3484,"Los Angeles Intl","Los Angeles","United States","LAX","KLAX",33.942536,-118.408075,126,-8,"A","America/Los_Angeles"',
    '3469,"San Francisco, Intl","San Francisco","United States","SFO","KSFO",37.618972,-122.374889,13,-8,"A","America/Los_Angeles"',
]
