"""Tables that a run stores for itself: managed tables of the session's warehouse.

They are written once and read by later jobs, so that lost executors cost only the tasks
they ran, and they may be bucketed. Their owner drops them.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession


def buckets(spark: SparkSession) -> int:
    """Buckets of a stored table: as many as a shuffle has partitions, so that each task writes its own."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class StoredTables:
    """The tables of one owner."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.names: list[str] = []

    def store(self, rows: DataFrame, bucket_by: list[str] = (), sort_by: list[str] = ()) -> DataFrame:
        """Write the rows and read them back; with buckets, those whose columns are equal share a file."""
        name = f"skylag_{uuid.uuid4().hex}"
        writer = rows.write.format("parquet")
        if bucket_by:
            writer = writer.bucketBy(buckets(self.spark), *bucket_by).sortBy(*(sort_by or bucket_by))
        self.names.append(name)
        writer.saveAsTable(name)
        return self.spark.table(name)

    def drop(self) -> None:
        while self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop()}")
