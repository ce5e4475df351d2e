"""Positions in ordered series of any length, and their pieces.

A range shuffle cuts the rows at quantiles of key and order, so that a series that holds
a large share of all rows is ordered by many tasks. Its positions are prefix sums: place
in the range, plus the rows of the same series in the ranges before.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylag.sources.stored import StoredTables

# Bits of the place in a task in the ids that Spark gives rows.
_PLACE = (1 << 33) - 1


def _same(key: list[str], right: dict[str, str]) -> Column:
    return F.expr(" AND ".join(f"{k} <=> {right[k]}" for k in key))


def numbered(
    rows: DataFrame, key: list[str], order: list[str], tables: StoredTables, seq: str = "seq", total: str = "total"
) -> DataFrame:
    """The rows with ``seq``, their position from 1 among the rows of their key, and ``total``,
    the number of these rows.

    Rows that are equal in key and order are spread over ranges too. The ordered rows are
    stored once, so both readings see the same ranges.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    place = [*key, *order, "_tie"]
    ranged = tables.store(
        tied.repartitionByRange(*place).sortWithinPartitions(*place).select(
            *rows.columns, F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(_PLACE).alias("_at"),
        )
    )
    runs = ranged.groupBy(*key, "_part").agg(F.min("_at").alias("first_at"), F.count("*").alias("n"))
    whole = Window.partitionBy(*key)
    before = F.sum("n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    named = {k: f"_run_{k}" for k in [*key, "_part"]}
    runs = runs.select(
        *[F.col(k).alias(v) for k, v in named.items()],
        (F.coalesce(before, F.lit(0)) - F.col("first_at") + 1).alias("_shift"), F.sum("n").over(whole).alias(total),
    )
    joined = ranged.join(runs, _same([*key, "_part"], named))
    return joined.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias(seq), total)


def in_pieces(
    rows: DataFrame, size: int, seq: str = "seq", total: str = "total", piece: str = "piece", lead: str = "lead"
) -> DataFrame:
    """Numbered rows with their ``piece`` of ``size`` rows, and ``lead``: whether a row is the
    last one of the piece before, carried over."""
    own = f"({seq} - 1) div {size}"
    carried = f"if({seq} % {size} = 0 AND {seq} < {total}, array({own}, {own} + 1), array({own}))"
    return rows.selectExpr("*", f"explode({carried}) AS {piece}").selectExpr("*", f"{piece} > {own} AS {lead}")


def counted_before(sizes: DataFrame, key: list[str], size: str, tables: StoredTables) -> DataFrame:
    """For each row of unique keys ``before``: the sum of ``size`` over all smaller keys, in two
    levels: ranges of keys, then the rows of a range."""
    ranged = tables.store(
        sizes.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("_part", F.spark_partition_id())
    )
    parts = ranged.groupBy("_part").agg(F.sum(size).alias("n")).select(
        F.col("_part").alias("_of_part"),
        # As many rows as ranges.
        F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_in_parts"),
    )
    own = Window.partitionBy("_part").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("_inside", F.sum(size).over(own))
    return inside.join(parts, F.col("_part") == F.col("_of_part")).select(
        *sizes.columns, F.expr("coalesce(_in_parts, 0) + coalesce(_inside, 0)").alias("before")
    )
