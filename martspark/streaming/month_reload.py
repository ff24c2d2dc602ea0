"""Month re-loads triggered by new source files.

Each micro-batch tells which months its new files hold (one small aggregate, a row a month);
those months are then rebuilt from all files of the source folder, so rows of a month that
came in an earlier file, or in another file of the same extract, stay. Replaying a batch after
a failure rewrites the same months (idempotent); the checkpoint on shared storage records which
files were seen. The files must stay in the folder as long as their months may change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from martspark.functions import parse_date_text
from martspark.operators.tables import PART_COL, check_anchor, month_key, write_observed
from martspark.sources.files import CSV_OPTIONS


def month_reload_stream(spark: SparkSession, source_dir: str, schema: StructType, target_path: str,
                        key: str, checkpoint_location: str, convert: bool = False,
                        date_format: str = "dd.MM.yyyy", fmt: str = "csv", available_now: bool = True,
                        anchor_day: int = 1, **options) -> StreamingQuery:
    opts = {**CSV_OPTIONS, "mode": "FAILFAST", "columnPruning": "false", **options} if fmt == "csv" else dict(options)

    def keyed(df: DataFrame) -> DataFrame:
        df = df.withColumn(key, parse_date_text(key, date_format)) if convert else df
        return df.withColumn(PART_COL, month_key(key, anchor_day))

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        months = [r[0] for r in keyed(batch).select(PART_COL).distinct().collect()]
        if not months:
            return
        check_anchor(spark, target_path, anchor_day)
        known = F.col(PART_COL).isin([m for m in months if m is not None])
        whole = keyed(spark.read.schema(schema).options(**opts).format(fmt).load(source_dir))
        whole = whole.where(known | F.col(PART_COL).isNull() if None in months else known)
        write_observed(whole, target_path, "overwrite", PART_COL, dynamic=True, cluster=True)

    src = spark.readStream.schema(schema).options(**opts).format(fmt).load(source_dir)
    w = src.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
