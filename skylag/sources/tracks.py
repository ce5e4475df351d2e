"""Track samples from compressed text or from a partitioned table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.schema import TRACK_SCHEMA
from skylag.sources.dates import DateSpec

# The fields of a track line, in file order.
TRACK_FIELDS = [
    "date", "time", "lat", "lon", "dest_lat", "dest_lon", "alt", "flight_id", "dep_airport",
    "arr_airport", "dep_time", "eta", "status", "speed", "heading", "craft_type",
]
DATE_PARTS = ["year", "month", "day"]
WHITESPACE = " \t\n\r\x0b\x0c"


def parse_track_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Decode ``|``-separated lines into the 18 typed sample columns.

    A bad number or a missing field fails the job, also where a query does not use
    that field. Fields past the last one are ignored.
    """
    fields = lines.select(F.split(F.btrim(F.col(column), F.lit(WHITESPACE)), r"\|").alias("fields"))
    split = fields.select("fields", F.split(F.get("fields", F.lit(0)), "-").alias("date"))
    places = {name: f"get(fields, {i})" for i, name in enumerate(TRACK_FIELDS)}
    places |= {name: f"get(date, {i})" for i, name in enumerate(DATE_PARTS)}
    # The generator keeps the test below it: a filter put under the split would split again for each field.
    typed = [f"try_cast({places[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in TRACK_SCHEMA]
    rows = split.selectExpr("fields", f"inline(array(struct({', '.join(typed)})))")
    bad = " OR ".join(f"{f.name} IS NULL" for f in TRACK_SCHEMA if f.dataType.simpleString() != "string")
    message = "concat('bad track line: ', array_join(fields, '|'))"
    good = f"if(size(fields) < {len(TRACK_FIELDS)} OR {bad}, raise_error({message}), true)"
    return rows.where(good).select(*TRACK_SCHEMA.fieldNames())


def read_tracks(spark: SparkSession, root: str, spec: DateSpec = DateSpec()) -> DataFrame:
    """Samples of the archive files that match the date specification.

    The bz2 files are splittable, so one large day file is read by many tasks.
    Files and table agree: text that names no existing file raises an error.
    """
    return parse_track_lines(spark.read.text(spec.glob(root)))


def write_sample_table(samples: DataFrame, path: str, mode: str = "error") -> None:
    """Store samples as Parquet partitioned by date, for repeated analyses.

    The rebalance puts a date together, splits a heavy one over several tasks and
    joins small ones. Inside a file rows are sorted by arrival airport, so that
    row groups of other airports are skipped.
    """
    (
        samples.hint("rebalance", *DATE_PARTS)
        .sortWithinPartitions(*DATE_PARTS, "arr_airport", "lat")
        .write.mode(mode).partitionBy(*DATE_PARTS).parquet(path)
    )


def read_sample_table(spark: SparkSession, path: str, spec: DateSpec = DateSpec()) -> DataFrame:
    """Samples of a stored table; the date specification prunes partitions."""
    return (
        spark.read.schema(TRACK_SCHEMA).parquet(path)
        .where(spec.predicate())
        .select(*TRACK_SCHEMA.fieldNames())
    )


def scan_counts(samples: DataFrame) -> DataFrame:
    """Number of samples per date."""
    return samples.groupBy(*DATE_PARTS).agg(F.count("*").alias("samples"))
