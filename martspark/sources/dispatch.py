"""Source dispatcher: the load functions accept a file (CSV) or a JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from martspark.sources.files import CheckedRead, read_csv, read_csv_checked
from martspark.sources.jdbc import read_jdbc

# Source kinds (file server -> CSV files, connector -> JDBC), plus parquet,
# and the message for an unknown kind.
SOURCE_KINDS = ("csv", "jdbc", "parquet")
MSG_UNKNOWN = "Provided external tool not exists"


class UnknownSource(ValueError):
    pass


def read_source(spark: SparkSession, kind: str, location: str, schema: StructType | None = None,
                **options) -> DataFrame | CheckedRead:
    """The rows of a source; of a CSV source with a ``reject_limit``, a checked read, whose
    malformed rows the loaders leave out as long as they stay below the limit."""
    if kind == "csv":
        if schema is None:
            raise ValueError("a CSV source needs its source schema")
        if "reject_limit" in options:
            return read_csv_checked(spark, location, schema, **options)
        return read_csv(spark, location, schema, **options)
    if kind == "jdbc":
        return read_jdbc(spark, options.pop("url"), location, options.pop("properties", None),
                         options.pop("predicates", None))
    if kind == "parquet":
        r = spark.read if schema is None else spark.read.schema(schema)
        return r.parquet(location)
    raise UnknownSource(f"{MSG_UNKNOWN}: {kind}")
