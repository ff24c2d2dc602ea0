"""Append-only run log on shared storage.

One row per event: type (upper-cased, ERROR or INFO), message (NULL -> 'empty'),
location (lower-cased), error flag, timestamp and user; ids are UUIDs. The row is
built by Spark itself (``spark.range(1)``), so nothing but the few parameter values
comes from the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.sources.schemas import SCHEMAS

# The accepted log types, the text for a missing message and the
# message for a bad type.
LOG_TYPES = ("ERROR", "INFO")
EMPTY_MESSAGE = "empty"
MSG_BAD_TYPE = "Illegal log type. Use one of: ERROR, INFO"


class RunLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, log_type: str, message: str | None, location: str | None = None) -> None:
        t = (log_type or "").upper()
        if t not in LOG_TYPES:
            raise ValueError(MSG_BAD_TYPE)
        row = self.spark.range(1).select(
            F.expr("uuid()").alias("log_id"),
            F.current_timestamp().cast("timestamp").alias("log_timestamp"),
            F.lit(t).alias("log_type"),
            F.lit(EMPTY_MESSAGE if message is None else str(message)).alias("log_msg"),
            F.lit(None if location is None else location.lower()).cast("string").alias("log_location"),
            F.lit(t == "ERROR").alias("is_error"),
            F.current_user().alias("log_user"))
        row.coalesce(1).write.mode("append").parquet(self.path)

    def __call__(self, log_type: str, message: str | None) -> None:
        self.write(log_type, message, None)

    def bind(self, location: str):
        return lambda log_type, message: self.write(log_type, message, location)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMAS["logs"]).parquet(self.path)
