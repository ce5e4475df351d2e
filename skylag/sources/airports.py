"""Airport reference lines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag.schema import AIRPORT_COLUMNS, AIRPORT_LINE_SCHEMA

# Quoted empty fields stay empty text; only missing and bare empty ones come out as null.
CSV_OPTIONS = {"nullValue": "\u0000"}


def parse_airport_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Decode comma-separated airport lines with quoted text fields.

    A missing field, a missing or a bad number fails the job; fields past the last
    one are ignored, blank lines are skipped. Commas inside quotes belong to the field.
    """
    line = F.btrim(F.col(column))
    fields = F.from_csv(line, ", ".join(f"{f.name} string" for f in AIRPORT_LINE_SCHEMA), CSV_OPTIONS)
    types = {f.name: f.dataType.simpleString() for f in AIRPORT_LINE_SCHEMA}
    missing = " OR ".join(f"a.{c} IS NULL" for c in ("lat", "lon", "alt", "timezone", "dst"))
    return (
        lines.where(line != "")
        .select(line.alias("line"), fields.alias("a"))
        .where(f"if({missing}, raise_error(concat('airport line with missing fields: ', line)), true)")
        .selectExpr(*[f"cast(a.{c} AS {types[c]}) AS {c}" for c in AIRPORT_COLUMNS])
    )


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """Airports of a headerless file, decoded on the executors."""
    return parse_airport_lines(spark.read.text(path))
