"""JDBC sources and sinks. Connection settings always come from the caller.

``monthly_predicates`` turns ``PARTITION_BY=col:date&RANGE=a:b&INTERVAL=1:month`` into
one half-open predicate per calendar month (or per n days), so every month is read by
its own task; the stock ``partitionColumn/lowerBound/upperBound`` splits into equal
strides instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from martspark.functions import add_months_py


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              predicates: list[str] | None = None, fetchsize: int = 10000) -> DataFrame:
    props = {"fetchsize": str(fetchsize), **(properties or {})}
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def monthly_predicates(column: str, start: dt.date, end: dt.date, step_months: int = 1,
                       step_days: int | None = None) -> list[str]:
    """Half-open ranges [a, a+step) covering [start, end]."""
    preds, a = [], start
    while a <= end:
        b = a + dt.timedelta(days=step_days) if step_days else add_months_py(a, step_months)
        preds.append(f"{column} >= DATE '{a.isoformat()}' AND {column} < DATE '{b.isoformat()}'")
        a = b
    return preds


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, column: str, start: dt.date, end: dt.date,
                     properties: dict | None = None, step_months: int = 1,
                     step_days: int | None = None) -> DataFrame:
    return read_jdbc(spark, url, table, properties,
                     monthly_predicates(column, start, end, step_months, step_days))


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", batchsize: int = 10000) -> None:
    df.write.jdbc(url, table, mode=mode, properties={"batchsize": str(batchsize), **(properties or {})})
