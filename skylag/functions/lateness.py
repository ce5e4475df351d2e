"""The lateness rule and the delay, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def lateness_branch() -> Column:
    """Which part of the rule decides a sample: 1, 2, 3 = on time, 4 = late.

    Hours are UTC hours of the day; ``time`` may run past 24 on an overnight flight.

    1. not yet past the estimated arrival;
    2. arrival lies after midnight (departure hour above the arrival hour) and
       the sample lies between departure and midnight;
    3. past midnight, and the hour of the new day is still before the arrival;
    4. late.

    The order and the strictness of the comparisons matter. Two results follow
    from the rule as it stands: a daytime flight still in the air past hour 24
    can turn on time again (time 25, eta 15), and with ``eta >= 24`` nothing
    after 24 is late.

    A NaN estimate is late. Spark sorts NaN above all numbers, so that case
    needs its own test; a NaN time or departure falls through to late by itself.
    """
    return F.expr("""
        CASE WHEN isnan(eta) THEN 4
             WHEN time <= eta THEN 1
             WHEN dep_time > eta AND time >= dep_time AND time <= 24 THEN 2
             WHEN time > 24 AND time % 24 < eta THEN 3
             ELSE 4 END""")


def is_late() -> Column:
    return lateness_branch() == 4


def delay_hours() -> Column:
    """Hours past the estimated arrival, null where not positive or not a number."""
    return F.expr("CASE WHEN time - eta > 0 AND NOT isnan(time - eta) THEN time - eta END")
