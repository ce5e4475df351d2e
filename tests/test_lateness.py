import math

import pytest
from helpers import samples_df

from skylag.functions.lateness import is_late
from skylag.operators import delays

NAN = math.nan
INF = math.inf

# time, eta, dep_time, late
TRUTH = [
    (10.0, 10.0, 8.0, False),
    (10.01, 10.0, 8.0, True),
    (23.5, 2.0, 23.0, False),
    (23.0, 2.0, 23.0, False),
    (24.0, 2.0, 23.0, False),
    (22.9, 2.0, 23.0, True),
    (25.0, 2.0, 23.0, False),
    (26.0, 2.0, 23.0, True),
    (26.5, 2.0, 23.0, True),
    (2.5, 2.0, 23.0, True),
    (25.0, 15.0, 10.0, False),
    (27.0, 26.0, 20.0, False),
    (NAN, 10.0, 8.0, True),
    (9.0, NAN, 8.0, True),
    (NAN, NAN, NAN, True),
    (9.0, 8.0, NAN, True),
    (INF, 8.0, 7.0, True),
]


@pytest.mark.parametrize("time, eta, dep_time, late", TRUTH)
def test_truth_table(spark, time, eta, dep_time, late):
    df = samples_df(spark, {"time": time, "eta": eta, "dep_time": dep_time})
    assert df.select(is_late().alias("late")).first().late is late


def test_overnight_delay_keeps_the_roll_over(spark):
    df = samples_df(spark, {"time": 26.5, "eta": 2.0, "dep_time": 23.0})
    assert delays.flight_delay(df).first().delay == 24.5


def test_delay_uses_all_samples_and_names_the_craft_of_the_largest(spark):
    df = samples_df(
        spark,
        {"time": 10.5, "eta": 10.0, "craft_type": "A320"},
        {"time": 12.0, "eta": 10.0, "craft_type": "B747"},
        {"time": 12.0, "eta": 10.0, "craft_type": "B737"},
        {"time": 8.0, "eta": 10.0, "craft_type": "A300"},
    )
    row = delays.flight_delay(df).first()
    assert (row.delay, row.craft_type) == (2.0, "B737")


def test_delay_without_a_number_is_zero_without_craft(spark):
    df = samples_df(spark, {"time": NAN}, {"time": 8.0, "eta": 10.0})
    row = delays.flight_delay(df).first()
    assert (row.delay, row.craft_type) == (0.0, None)


def test_on_time_flights_have_no_delay_row(spark):
    df = samples_df(spark, {"time": 8.0, "eta": 10.0})
    assert delays.flight_delay(df).count() == 0
    summary = delays.delay_summary(delays.flight_delay(df)).first()
    assert summary.delayed_flights == 0
    assert summary.avg_delay is None and summary.max_delay is None and summary.min_flight_id is None
