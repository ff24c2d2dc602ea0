"""Delimited-text sources and sinks with an explicit schema (no inference).

The warehouse's file format: header line, ``;`` delimiter, empty field = NULL, ``"``
as quote and escape, UTF-8. Paths may be globs (``lineitem*.csv``). A reject limit
keeps malformed rows out of the load and fails it once they reach the limit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"

# The source file format.
CSV_OPTIONS = {"header": "true", "sep": ";", "nullValue": "", "emptyValue": "", "quote": '"',
               "escape": '"', "encoding": "UTF-8", "dateFormat": "yyyy-MM-dd"}


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False, **options) -> DataFrame:
    """A row that doesn't fit the schema ends the read: missing or surplus fields whichever
    columns are used, a bad value where its column is. ``multi_line`` reads quoted fields with line breaks; such
    files can't be split, so it is off unless asked for."""
    opts = {**CSV_OPTIONS, "mode": "FAILFAST", "columnPruning": "false", "multiLine": str(multi_line).lower(), **options}
    return spark.read.schema(schema).options(**opts).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", distribute_by: str | None = None,
              multi_line: bool = False, **options) -> None:
    """Write delimited text; ``distribute_by`` distributes rows over the writer tasks
    by that column first (a writable table ``DISTRIBUTED BY (col)``), as a rebalance so
    AQE splits a hot key's partition instead of giving it to one task. A text with a line
    break, which a plain read would take apart, is refused unless ``multi_line``."""
    # the writer would trim texts unless told not to
    opts = {**CSV_OPTIONS, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", **options}
    if not multi_line:
        for f in df.schema.fields:
            if isinstance(f.dataType, StringType):
                c = F.col(f"`{f.name}`")
                df = df.withColumn(f.name, F.when(c.rlike(r"[\r\n]"), F.raise_error(F.lit(f"a line break in {f.name}"))).otherwise(c))
    if distribute_by:
        df = df.hint("rebalance", distribute_by)
    df.write.mode(mode).options(**opts).csv(path)


class RejectLimitExceeded(RuntimeError):
    pass


@dataclass
class CheckedRead:
    """Good rows of a CSV read, plus the observation counting the rejected ones."""
    good: DataFrame
    rejected: DataFrame
    observation: Observation
    limit: int | None

    def check(self) -> int:
        """Rejected-row count seen by the action that consumed ``good``; raises at the limit."""
        n = int(self.observation.get.get("rejected", 0) or 0)
        if self.limit is not None and n >= self.limit:
            raise RejectLimitExceeded(f"{n} rejected rows reach the reject limit {self.limit}")
        return n


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, reject_limit: int | None = 10,
                     **options) -> CheckedRead:
    """PERMISSIVE read that splits malformed rows off. The rejected count is observed
    during the load itself (no second pass); call ``check()`` after the write, before
    the staged data is swapped in."""
    opts = {**CSV_OPTIONS, **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])
    raw = spark.read.schema(full).options(**opts).csv(path)
    obs = Observation()
    tagged = raw.observe(obs, F.count_if(F.col(CORRUPT).isNotNull()).alias("rejected"))
    good = tagged.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    rejected = raw.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return CheckedRead(good, rejected, obs, reject_limit)


def split_rejects(spark: SparkSession, path: str, schema: StructType, staged_path: str, **options) -> tuple[DataFrame, DataFrame]:
    """Read delimited files once and write their rows to two places below ``staged_path``: the good
    ones with their types, the malformed ones as (file, line). Returns both, read back."""
    opts = {**CSV_OPTIONS, **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    full = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    raw = spark.read.schema(full).options(**opts).csv(path)
    bad = F.col(CORRUPT).isNotNull()
    rows = raw.select(*[F.when(~bad, F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields], CORRUPT,
                      F.when(bad, F.col("_metadata.file_path")).alias("_source_file"), bad.alias("_rejected"))
    rows.write.partitionBy("_rejected").parquet(staged_path)
    back = spark.read.schema(rows.schema).parquet(staged_path)
    good = back.where(~F.col("_rejected")).select(*[f"`{f.name}`" for f in schema.fields])
    return good, back.where("_rejected").select(F.col("_source_file").alias("file"), F.col(CORRUPT).alias("line"))
