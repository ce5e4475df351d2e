"""Late samples, delayed flights, delay per flight and delay statistics.

Every operator here starts with a partial and a final aggregate: tasks combine their own
samples first, so a flight that holds a large share of all samples reaches the
shuffle as one row per task.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylag.functions.lateness import delay_hours, is_late, lateness_branch
from skylag.schema import KEY, ORDER, SAMPLE_COLUMNS


def project_samples(samples: DataFrame) -> DataFrame:
    """The 11 columns of the delay analysis."""
    return samples.withColumnRenamed("arr_airport", "arpt").select(*SAMPLE_COLUMNS)


def flag_samples(samples: DataFrame) -> DataFrame:
    """Projected samples with ``late``."""
    return project_samples(samples).select("*", is_late().alias("late"))


def add_label(flagged: DataFrame) -> DataFrame:
    """Add ``label``: r for late, k for on time; both are colour codes of the map layers."""
    return flagged.select("*", F.expr("if(late, 'r', 'k') AS label"))


def label_samples(samples: DataFrame) -> DataFrame:
    return add_label(flag_samples(samples))


def late_samples(samples: DataFrame) -> DataFrame:
    return samples.where(is_late())


def late_branch_counts(samples: DataFrame) -> DataFrame:
    """How many samples each part of the lateness rule decides."""
    return samples.groupBy(lateness_branch().alias("branch")).agg(F.count("*").alias("samples"))


def delayed_flight_keys(samples: DataFrame) -> DataFrame:
    """Flights with at least one late sample."""
    return late_samples(samples).select(*KEY).distinct()


def flight_delay(samples: DataFrame) -> DataFrame:
    """Delay of each delayed flight: the largest ``time - eta`` over all its samples.

    The midnight roll-over is not undone, so an overnight flight can show more
    than 24 hours. The craft type is that of the sample with the largest delay;
    among equal ones the first name. Without a positive delay it is null and the
    delay 0.

    The first aggregate groups by craft type too. That keeps its state to plain
    numbers (a hash aggregate, no sort of the samples) and leaves about one row
    per flight for the second.
    """
    per_craft = samples.groupBy(*KEY, "craft_type").agg(
        F.bool_or(is_late()).alias("late"),
        F.max(delay_hours()).alias("delay"),
    )
    per_flight = per_craft.groupBy(*KEY).agg(
        F.bool_or("late").alias("late"),
        F.expr("min(CASE WHEN delay IS NOT NULL THEN struct(-delay AS minus, craft_type) END) AS top"),
    )
    return per_flight.where("late").selectExpr(
        *KEY, "top.craft_type AS craft_type", "coalesce(-top.minus, 0D) AS delay"
    )


def max_delay_flight(delays: DataFrame) -> DataFrame:
    """The flight with the largest delay; ties go to the first key."""
    return delays.orderBy(F.desc("delay"), *KEY).limit(1)


def min_delay_flight(delays: DataFrame) -> DataFrame:
    """The flight with the smallest delay; ties go to the first key."""
    return delays.orderBy("delay", *KEY).limit(1)


def delay_summary(delays: DataFrame) -> DataFrame:
    """One row: number of delayed flights, average delay, and the flights with the
    largest and the smallest delay. Without delayed flights the count is 0 and
    the rest null."""
    flight = [*KEY, "craft_type"]
    columns = ", ".join(flight)
    stats = delays.selectExpr("delay", f"struct(delay, {columns}) AS up", f"struct(-delay AS minus, {columns}) AS down")
    stats = stats.agg(
        F.count("*").alias("delayed_flights"),
        F.avg("delay").alias("avg_delay"),
        F.min("down").alias("longest"),
        F.min("up").alias("shortest"),
    )
    return stats.selectExpr(
        "delayed_flights",
        "avg_delay",
        *[f"longest.{c} AS max_{c}" for c in flight],
        "-longest.minus AS max_delay",
        *[f"shortest.{c} AS min_{c}" for c in flight],
        "shortest.delay AS min_delay",
    )


def flight_ends(samples: DataFrame) -> DataFrame:
    """First sample and first late sample of each delayed flight, as structs of ORDER.

    The least times come first: plain numbers, so their aggregate is a hash aggregate (a
    time that is null is before any other). Only the samples at these times are then
    compared in the other columns, equal ones once.
    """
    rows = project_samples(samples).select(*KEY, *ORDER, is_late().alias("late"))
    least = rows.groupBy(*KEY).agg(
        F.expr("if(bool_or(time IS NULL), NULL, min(time))").alias("least"),
        F.expr("if(bool_or(late AND time IS NULL), NULL, min(CASE WHEN late THEN time END))").alias("least_late"),
        F.bool_or("late").alias("delayed"),
    )
    least = least.where("delayed").drop("delayed").withColumnsRenamed({c: f"of_{c}" for c in KEY})
    same = " AND ".join(f"{c} <=> of_{c}" for c in KEY)
    ties = rows.join(least, F.expr(f"{same} AND (time <=> least OR late AND time <=> least_late)"))
    in_order = Window.partitionBy(*KEY).orderBy(*ORDER)
    ranked = ties.select(*KEY, *ORDER, "late").distinct().select(
        *KEY, F.struct(*ORDER).alias("first_late"), "late", F.first(F.struct(*ORDER)).over(in_order).alias("first"),
        F.sum(F.expr("if(late, 1, 0)")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("late_rank"),
    )
    return ranked.where("late AND late_rank = 1").select(*KEY, "first", "first_late")


def first_sample_attrs(samples: DataFrame) -> DataFrame:
    """Estimated arrival and arrival airport of a delayed flight's earliest sample."""
    return flight_ends(samples).selectExpr(
        *KEY, "first.time AS first_time", "first.eta AS first_eta", "first.arpt AS first_arpt"
    )
