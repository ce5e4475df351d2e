"""Ordered samples of delayed flights: position, previous point, segments, paths.

The ordered samples are stored once, bucketed by flight and sorted, and segments, paths
and report read them without another shuffle. One flight may hold a large share of all
samples; a window over it would put them into one task. Such heavy flights are ordered by
ranges at quantiles of their samples, and numbered by prefix sums (``series``).
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylag.functions.lateness import is_late
from skylag.operators.delays import add_label, delayed_flight_keys, flag_samples, label_samples, late_samples
from skylag.operators.series import in_pieces, numbered
from skylag.schema import KEY, ORDER
from skylag.sources.stored import StoredTables, buckets

# A flight with more samples than this is heavy.
HEAVY_SAMPLES = 1_000_000
# Longest path kept in one row.
PATH_SAMPLES = 10_000

# The flight inside this module: hashes that are never null, so that stored tables meet on
# plain equality, and whole numbers: Spark rewrites floating-point grouping columns and then
# no longer sees that the rows are already together.
FLIGHT = ["id_key", "day_key", "dep_key"]
FLIGHT_COLUMNS = ["flight_id", "year", "month", "day", *FLIGHT]
TRACK_COLUMNS = [*KEY, *FLIGHT, *ORDER, "late", "seq", "prev_lat", "prev_lon", "is_last", "piece"]


def flight_summary(samples: DataFrame) -> DataFrame:
    """Per flight: number of samples, and whether any is late."""
    return samples.groupBy(*KEY).agg(
        F.count("*").alias("samples"), F.bool_or(is_late()).alias("any_late")
    )


def heavy_flights(summary: DataFrame, heavy_samples: int = HEAVY_SAMPLES) -> DataFrame:
    """The flights to order by ranges: ``heavy_*`` key columns, and whether one is delayed."""
    return summary.where(F.col("samples") > heavy_samples).select(
        *[F.col(c).alias(f"heavy_{c}") for c in KEY], F.coalesce("any_late", F.lit(False)).alias("delayed")
    )


def _flagged(samples: DataFrame) -> DataFrame:
    date = ["year", "month", "day"]
    return flag_samples(samples).withColumns({
        "id_key": F.xxhash64("flight_id"), "dep_key": F.xxhash64("dep_time"),
        "day_key": F.xxhash64(*date, *[F.isnull(c) for c in date]),
    })


def split_flights(samples: DataFrame, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flagged samples of ordinary flights, and of heavy flights that are delayed.

    There are at most as many heavy flights as the limit fits into the number of
    samples; Spark broadcasts them if they are few.
    """
    same = F.expr(" AND ".join(f"{c} <=> heavy_{c}" for c in KEY))
    flagged = _flagged(samples)
    return flagged.join(heavy, same, "left_anti"), flagged.join(heavy.where("delayed"), same, "left_semi")


def _ordinary_tracks(flagged: DataFrame, path_samples: int) -> DataFrame:
    """One shuffle by flight; the window that orders the samples also tells whether the flight is delayed."""
    by_flight = Window.partitionBy(*FLIGHT)
    ordered = by_flight.orderBy(*ORDER)
    rows = flagged.select(
        "*", F.row_number().over(ordered).cast("long").alias("seq"),
        F.lag("lat").over(ordered).alias("prev_lat"), F.lag("lon").over(ordered).alias("prev_lon"),
        F.lead(F.lit(1)).over(ordered).isNull().alias("is_last"), F.bool_or("late").over(by_flight).alias("any_late"),
    )
    return rows.where("any_late").withColumn("piece", F.expr(f"(seq - 1) div {path_samples}")).select(*TRACK_COLUMNS)


def _heavy_tracks(flagged: DataFrame, path_samples: int, tables: StoredTables) -> DataFrame:
    """Ranges number the samples; the point before the first one of a piece is carried over."""
    pieces = in_pieces(numbered(flagged, FLIGHT, ORDER, tables), path_samples)
    in_piece = Window.partitionBy(*FLIGHT, "piece").orderBy("seq")
    rows = pieces.select(
        "*", F.lag("lat").over(in_piece).alias("prev_lat"), F.lag("lon").over(in_piece).alias("prev_lon"),
        (F.col("seq") == F.col("total")).alias("is_last"),
    )
    return rows.where("NOT lead").select(*TRACK_COLUMNS)


def store_tracks(
    samples: DataFrame, tables: StoredTables, heavy_samples: int = HEAVY_SAMPLES, path_samples: int = PATH_SAMPLES
) -> DataFrame:
    """All samples of the delayed flights with position ``seq`` (from 1), previous point,
    ``is_last`` and ``piece``, as a stored table.

    The samples are read twice: columns of the key for the flights' sizes, then the rows;
    only heavy flights are read a third time. Without them the table is bucketed by
    flight, as the window left it; with them by flight and piece, which keeps a bucket
    bounded.
    """
    heavy = tables.store(heavy_flights(flight_summary(samples), heavy_samples))
    if heavy.isEmpty():
        return add_label(tables.store(_ordinary_tracks(_flagged(samples), path_samples), FLIGHT, [*FLIGHT, "seq"]))
    ordinary, cut = split_flights(samples, heavy)
    by_piece = [*FLIGHT, "piece"]
    rows = _ordinary_tracks(ordinary, path_samples).unionByName(_heavy_tracks(cut, path_samples, tables))
    rows = rows.repartition(buckets(samples.sparkSession), *by_piece)
    return add_label(tables.store(rows, by_piece, [*by_piece, "seq"]))


def delayed_tracks(
    samples: DataFrame, heavy_samples: int = HEAVY_SAMPLES, path_samples: int = PATH_SAMPLES
) -> DataFrame:
    """``store_tracks`` with tables that stay until the warehouse is cleaned; give a
    ``StoredTables`` of your own to drop them."""
    return store_tracks(samples, StoredTables(samples.sparkSession), heavy_samples, path_samples)


def delayed_flight_samples(samples: DataFrame, bloom_filter: bool = False) -> DataFrame:
    """All samples, late or not, of every flight with a late sample, by semi join.

    Spark broadcasts the keys if they turn out small. Otherwise both sides are
    shuffled, and adaptive execution splits the samples of a heavy flight: a left
    semi join can be split on its left side.

    With ``bloom_filter`` Spark may put a Bloom filter of the keys at the scan of the
    samples, before their shuffle (sizes in ``spark.sql.optimizer.runtime.bloomFilter.*``):
    one hash of the whole key is the join column it is made from, and the keys are not
    made distinct, as Spark makes no such filter of an aggregate. That is worth it where
    few flights are delayed.
    """
    # Late implies the comparison; Spark looks for one before it makes the filter.
    late = late_samples(samples).where("coalesce(time - eta, 1D) > 0")
    keys = late.select(*KEY) if bloom_filter else delayed_flight_keys(samples)
    rows = label_samples(samples)
    if not bloom_filter:
        return rows.join(keys, KEY, "left_semi")
    of_key = F.xxhash64(*KEY)
    keys, rows = keys.withColumn("flight_hash", of_key), rows.withColumn("flight_hash", of_key)
    return rows.join(keys, [*KEY, "flight_hash"], "left_semi").drop("flight_hash")


def delayed_flight_samples_window(samples: DataFrame) -> DataFrame:
    """The same rows from one reading, by a window over the flight. A heavy flight passes
    through one task; the semi join splits it."""
    flagged = _flagged(samples).withColumn("any_late", F.bool_or("late").over(Window.partitionBy(*FLIGHT)))
    return add_label(flagged.where("any_late").drop("any_late", *FLIGHT))


def track_segments(tracks: DataFrame) -> DataFrame:
    """Lines between consecutive samples, labelled like the later sample.

    A flight with one sample has none.
    """
    return tracks.where("seq > 1").selectExpr(
        *KEY, "seq",
        "prev_lat AS from_lat", "prev_lon AS from_lon", "lat AS to_lat", "lon AS to_lon",
        "label",
    )


def collect_paths(tracks: DataFrame, *columns: str, path_samples: int = PATH_SAMPLES) -> DataFrame:
    """Samples of a flight as one ordered array of ``seq`` and the given columns.

    A flight of more than ``path_samples`` samples gives several rows, told apart
    by the position ``start`` of their first sample; ``lead`` is the point before
    it. Pieces follow from positions alone, so they are the same however the flight
    was ordered. Rows stay bounded, and pieces of the stored size are collected where
    the stored table has them.
    """
    if path_samples != PATH_SAMPLES:
        tracks = tracks.withColumn("piece", F.expr(f"(seq - 1) div {path_samples}"))
    pieces = tracks.groupBy(*FLIGHT_COLUMNS, "piece").agg(
        F.sort_array(F.collect_list(F.struct("seq", *columns))).alias("path"),
        F.min(F.struct("seq", F.struct("prev_lat", "prev_lon").alias("point"))).alias("first"),
        F.min("dep_time").alias("dep_time"),
    )
    return pieces.selectExpr(
        *KEY, "first.seq AS start", "size(path) AS samples", "path",
        "if(first.seq > 1, first.point, NULL) AS lead",
    )


def flight_tracks(tracks: DataFrame, path_samples: int = PATH_SAMPLES) -> DataFrame:
    """Ordered samples of each delayed flight, see collect_paths."""
    columns = ("time", "lat", "lon", "eta", "label", "arpt", "craft_type")
    return collect_paths(tracks, *columns, path_samples=path_samples).drop("lead")


def track_ends(tracks: DataFrame) -> DataFrame:
    """First sample and first late sample of each flight, as structs of ORDER, by position."""
    late = tracks.where("late").groupBy(*FLIGHT).agg(F.min("seq").alias("seq"))
    at = {c: f"late_{c}" for c in [*FLIGHT, "seq"]}
    same = " AND ".join(f"{c} = {at[c]}" for c in FLIGHT)
    # Not an equality, which would be a join key that the table is not bucketed by.
    found = tracks.join(late.withColumnsRenamed(at), F.expr(f"{same} AND seq BETWEEN late_seq AND late_seq"))
    first_late = found.select(*[F.col(c).alias(at[c]) for c in FLIGHT], F.struct(*ORDER).alias("first_late"))
    return tracks.where("seq = 1").join(first_late, F.expr(same)).select(*KEY, F.struct(*ORDER).alias("first"), "first_late")
