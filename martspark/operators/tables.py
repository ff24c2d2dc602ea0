"""Parquet tables on shared storage: month partition key, observed writes, staging,
dropping partition directories that a swap leaves empty."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martspark.session import scratch_path

PART_COL = "pmonth"


def month_key(c: Column | str, anchor_day: int = 1) -> Column:
    """Start of the monthly range partition holding ``c``; ranges start on
    ``anchor_day`` (a table whose ranges run from the 2nd to the 2nd uses 2)."""
    col = F.col(c) if isinstance(c, str) else c
    d = col.cast("date")
    first = F.trunc(d, "MM")
    if anchor_day == 1:
        return first
    here = _boundary(first, anchor_day)
    return F.when(d >= here, here).otherwise(_boundary(F.add_months(first, -1), anchor_day))


def _boundary(first: Column, anchor_day: int) -> Column:
    """The range start in the month that begins on ``first``: its ``anchor_day``, or its
    last day where the month is shorter."""
    return F.date_add(first, F.least(F.lit(anchor_day), F.dayofmonth(F.last_day(first))) - 1)


def month_start(day: dt.date, anchor_day: int = 1) -> dt.date:
    """``month_key`` of one date, for parameters."""
    here = _anchored(day, anchor_day)
    return here if day >= here else _anchored(day.replace(day=1) - dt.timedelta(days=1), anchor_day)


def next_month_start(start: dt.date, anchor_day: int = 1) -> dt.date:
    from martspark.functions import add_months_py
    return _anchored(add_months_py(start.replace(day=1), 1), anchor_day)


def _anchored(day: dt.date, anchor_day: int) -> dt.date:
    from martspark.functions import add_months_py
    first = day.replace(day=1)
    return first + dt.timedelta(days=min(anchor_day, (add_months_py(first, 1) - first).days) - 1)


def months_in(start: dt.date, end: dt.date, anchor_day: int = 1) -> list[dt.date]:
    """Partition values m with start <= m < end (driver-side, parameter-bounded)."""
    out, m = [], month_start(start, anchor_day)
    while m < end:
        if m >= start:
            out.append(m)
        m = next_month_start(m, anchor_day)
    return out


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A parquet table. Without a schema, a month column whose folders are all NULL (no
    type can be told from them) is a date."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    df = spark.read.parquet(path)
    if PART_COL in df.columns and df.schema[PART_COL].dataType.typeName() == "void":
        df = df.withColumn(PART_COL, F.col(PART_COL).cast("date"))
    return df


def write_observed(df: DataFrame, path: str, mode: str = "overwrite",
                   partition_col: str | None = None, dynamic: bool = False,
                   cluster: bool = False, order_by: str | None = None,
                   bucket: tuple[str, int] | None = None) -> tuple[int, list]:
    """Write and return (rows written, partition values written) from the same pass;
    None among the values is the partition of NULL keys.

    With ``cluster`` a partitioned write is first rebalanced on the partition column:
    each task then writes one or a few months (few, large files instead of
    tasks x months small ones), and AQE splits a month holding a large share of the
    rows into several tasks (and merges small ones) by
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``. ``order_by`` lays an unpartitioned
    table out in ranges of that column, so a key range skips files and row groups.
    ``bucket`` (key, number) writes files bucketed by the key, sorted by ``order_by`` or the key, as a catalog table
    ``CLUSTERED BY`` it expects them (``catalog.register``). Which partitions an overwrite
    replaces is said here, whatever the session's ``partitionOverwriteMode``.
    """
    if bucket:
        df = df.repartition(bucket[1], bucket[0])
    elif order_by and not partition_col:
        df = df.repartitionByRange(order_by).sortWithinPartitions(order_by)
    if partition_col and cluster:
        df = df.hint("rebalance", partition_col)
    obs = Observation()
    aggs = [F.count(F.lit(1)).alias("rows")]
    if partition_col:
        aggs += [F.collect_set(partition_col).alias("parts"), F.max(F.col(partition_col).isNull()).alias("null_part")]
    w = df.observe(obs, *aggs).write.mode(mode)
    if partition_col:
        w = w.partitionBy(partition_col).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if bucket:      # only a table can be bucketed: one over the path, whose files stay when it goes
        name = f"bucketed_{uuid.uuid4().hex}"
        w.format("parquet").bucketBy(bucket[1], bucket[0]).sortBy(order_by or bucket[0]).option("path", path).saveAsTable(name)
        df.sparkSession.sql(f"DROP TABLE {name}")
    else:
        w.parquet(path)
    m = obs.get
    return int(m.get("rows", 0) or 0), list(m.get("parts") or []) + ([None] if m.get("null_part") else [])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def drop_partitions(spark: SparkSession, table_path: str, values: Iterable, partition_col: str = PART_COL) -> int:
    """Remove the directories of the given partition values (what swapping in an empty
    staging table does). Returns how many existed."""
    n = 0
    for v in values:
        n += delete_path(spark, f"{table_path.rstrip('/')}/{partition_folder(partition_col, v)}")
    return n


def partition_folder(partition_col: str, value) -> str:
    return f"{partition_col}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder; whether there was one."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p)) and bool(fs.delete(p, True))


def drop_table(spark: SparkSession, table_path: str) -> bool:
    """``DROP TABLE IF EXISTS``: remove the table's files; whether there was one."""
    return delete_path(spark, table_path)


def create_table(spark: SparkSession, table_path: str, schema: StructType, partition_col: str | None = None) -> None:
    """An empty table with declared types. An empty partitioned parquet table has no folder
    that could name its partition column, so the schema's column stays in the file of no rows;
    loads with that ``partition_col`` replace or join it."""
    if partition_col and partition_col not in schema.fieldNames():
        schema = StructType([*schema.fields]).add(partition_col, "date", True)
    replace_table(spark.createDataFrame([], schema), table_path)


def table_partition_values(spark: SparkSession, table_path: str, partition_col: str = PART_COL) -> list[str | None]:
    """Partition values by the table's folders (one per month), no data read."""
    fs, p = _fs(spark, table_path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{partition_col}=")]
    return [None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values]


def check_anchor(spark: SparkSession, table_path: str, anchor_day: int, partition_col: str = PART_COL) -> None:
    """Refuse a load whose months start on another day than the table's partitions do: its
    rows would land beside those that they should replace."""
    for v in table_partition_values(spark, table_path, partition_col):
        if v is not None and (d := dt.date.fromisoformat(v)) != _anchored(d, anchor_day):
            raise ValueError(f"{table_path} has a partition that starts on {v}, the load's months start on day {anchor_day}")


def beside(table_path: str) -> str:
    """A fresh hidden path in the table's own folder, from where a rename can bring it in."""
    head, _, name = table_path.rstrip("/").rpartition("/")
    return f"{head}/_swap-{name}-{uuid.uuid4().hex[:12]}"


def swap_in(spark: SparkSession, new_path: str, table_path: str, values: Iterable | None = None,
            partition_col: str = PART_COL) -> None:
    """Bring a table (or its partitions ``values``) written beside ``table_path`` into its
    place by renames. What was there is kept aside until everything is in, and put back if a
    rename fails. Partitions without a folder in ``new_path`` are left empty."""
    table_path, new_path, old = table_path.rstrip("/"), new_path.rstrip("/"), beside(table_path)
    folders = [""] if values is None else [f"/{partition_folder(partition_col, v)}" for v in values]
    moved: list[tuple[str, str]] = []

    def move(src: str, dst: str) -> None:
        fs, p = _fs(spark, src)
        if not fs.exists(p):
            return
        q = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)
        fs.mkdirs(q.getParent())
        if not fs.rename(p, q):
            raise OSError(f"can't rename {src} to {dst}")
        moved.append((src, dst))

    try:
        for f in folders:
            move(table_path + f, old + f)
            move(new_path + f, table_path + f)
    except BaseException:
        for src, dst in reversed(list(moved)):
            move(dst, src)
        raise
    delete_path(spark, old)
    delete_path(spark, new_path)
    spark.catalog.refreshByPath(table_path)


def replace_table(df: DataFrame, table_path: str, partition_col: str | None = None, cluster: bool = False,
                  order_by: str | None = None, bucket: tuple[str, int] | None = None) -> int:
    """Replace a whole table by ``df``: written beside it, then renamed into its place, so a load
    that fails leaves the old table as it was (and ``df`` may read it). Returns the rows."""
    spark, new_path = df.sparkSession, beside(table_path)
    try:
        rows, _ = write_observed(df, new_path, "overwrite", partition_col, cluster=cluster, order_by=order_by, bucket=bucket)
        swap_in(spark, new_path, table_path)
    finally:
        delete_path(spark, new_path)
    return rows


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files below a path, hidden ones and folders left out."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    root, found, it = fs.makeQualified(p).toString(), [], fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().toString()
        if not any(part.startswith(("_", ".")) and "=" not in part for part in name[len(root):].split("/")):
            found.append(name)
    return found


def swap_files(spark: SparkSession, new_path: str, table_path: str, old_files: Iterable[str]) -> None:
    """Bring the files below ``new_path`` into a table, in place of ``old_files``; its other files
    stay untouched. What is replaced is kept aside until all files are in, and put back if a rename
    fails."""
    old, moved = beside(table_path), []
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs, table = _fs(spark, table_path)
    root, new_root = fs.makeQualified(table).toString(), fs.makeQualified(Path(new_path)).toString()

    def move(src: str, dst: str) -> None:
        fs.mkdirs(Path(dst).getParent())
        if not fs.rename(Path(src), Path(dst)):
            raise OSError(f"can't rename {src} to {dst}")
        moved.append((src, dst))

    try:
        for f in old_files:
            move(f, old + f[len(root):])
        for f in data_files(spark, new_path):
            move(f, root + f[len(new_root):])
    except BaseException:
        for src, dst in reversed(list(moved)):
            move(dst, src)
        raise
    delete_path(spark, old)
    delete_path(spark, new_path)
    spark.catalog.refreshByPath(table_path)


def staging_path(spark: SparkSession, table_path: str) -> str:
    """Fresh staging location for a table, on the shared folder (never machine-local)."""
    name = table_path.rstrip("/").rsplit("/", 1)[-1]
    return scratch_path(spark, f"staging/{name}")


def is_bucketed(spark: SparkSession, table_path: str) -> bool:
    """Whether all files of a table were written in buckets (their names say which)."""
    return all(re.search(r"_\d{5}(\.c\d+)?\.[^/]*$", f) for f in data_files(spark, table_path))
