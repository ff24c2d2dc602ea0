"""The two warehouse runs as plain job functions, in the order of the source schedule.

Plan/fact run:   full loads of the dimensions -> month load of sales -> upsert of plan
                 -> plan/fact mart (+ a view of the catalog over product and price); the trailing sales
                 mart can follow (``sales_mart_run``)
Store report run: full loads of promos, promo types, stores -> delta loads of traffic
                 (text dates), coupons, bill heads -> upsert of bill items -> header x
                 item load of bills -> month report + day report -> sharded export

Sources are given per table as (kind, location, options) for ``read_source``; every
table lands under ``warehouse`` (shared storage). Each step writes a run-log row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martspark.operators import catalog
from martspark.operators import loads as LD
from martspark.operators.export import EXPORT_SCHEMA, EXPORT_SCHEMA_WIDE, export_frame, publish_plan_fact, publish_sharded
from martspark.operators.merge import upsert_table
from martspark.operators.runlog import RunLog
from martspark.operators.tables import is_bucketed, months_in, path_exists, read_table, replace_table, write_observed
from martspark.plans import plan_fact as PF
from martspark.plans import report_mart as RM
from martspark.plans import report_state as RS
from martspark.session import tune_for_scale
from martspark.sources.dispatch import read_source
from martspark.sources.files import CheckedRead
from martspark.sources.schemas import SCHEMAS


@dataclass
class Source:
    kind: str                      # csv | jdbc | parquet
    location: str
    options: dict = field(default_factory=dict)
    schema: str | None = None      # key of SCHEMAS describing the source form


@dataclass
class RunConfig:
    warehouse: str
    sources: dict[str, Source]
    log_path: str | None = None
    database: str = "retail"       # of the catalog, for the tables that views and bucketed joins read
    buckets: int = 200             # of bill items by bill number; stays as the table was first loaded


class Warehouse:
    """Tables of one warehouse root, read lazily by name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "root"):
            raise AttributeError(name)
        return read_table(self.spark, self.path(name))


def _src(spark, cfg: RunConfig, name: str) -> DataFrame | CheckedRead:
    s = cfg.sources[name]
    schema = SCHEMAS[s.schema or name] if (s.schema or name) in SCHEMAS else None
    return read_source(spark, s.kind, s.location, schema, **dict(s.options))


def _log(spark, cfg: RunConfig, where: str):
    log = RunLog(spark, cfg.log_path or f"{cfg.warehouse.rstrip('/')}/logs")
    return log.bind(where)


def in_catalog(spark: SparkSession, cfg: RunConfig, *names: str, bucket: tuple[str, int] | None = None) -> str:
    """Make tables of the warehouse known to the catalog; returns the name of their database."""
    wh = Warehouse(spark, cfg.warehouse)
    catalog.create_database(spark, cfg.database, wh.path("_database"))
    for name in names:
        catalog.register(spark, f"{cfg.database}.{name}", wh.path(name), bucket=bucket)
    return cfg.database


def load_bill_items(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Bill items, kept bucketed by bill number: an upsert rewrites the files of replaced bills
    only, and a join on the bill number needs no shuffle of the items."""
    path, by = Warehouse(spark, cfg.warehouse).path("bills_item"), ("billnum", cfg.buckets)
    if not path_exists(spark, path):
        LD.load_full(_src(spark, cfg, "bills_item"), path, bucket=by)
    else:
        if not is_bucketed(spark, path):        # loaded before items were bucketed
            replace_table(read_table(spark, path), path, bucket=by)
        upsert_table(spark, path, _src(spark, cfg, "bills_item"), ["billnum"], bucket=by)
    return spark.table(f"{in_catalog(spark, cfg, 'bills_item', bucket=by)}.bills_item")


def plan_fact_run(spark: SparkSession, cfg: RunConfig, sales_start: str, month: str, shards: int = 0) -> int:
    """``shards``: also publish the mart as the sharded export, in so many files."""
    tune_for_scale(spark)
    wh, log = Warehouse(spark, cfg.warehouse), _log(spark, cfg, "Sales plan calculation")
    log("INFO", "Start plan/fact run")
    for dim in ("price", "chanel", "product", "region"):
        LD.load_full(_src(spark, cfg, dim), wh.path(dim))
    LD.load_single_partition(_src(spark, cfg, "sales"), wh.path("sales"), "date", sales_start)
    if path_exists(spark, wh.path("plan")):
        upsert_table(spark, wh.path("plan"), _src(spark, cfg, "plan"), ["date"], date_key="date")
    else:
        LD.load_full(_src(spark, cfg, "plan"), wh.path("plan"), "pmonth", "date")
    mart = PF.plan_fact(wh.sales, wh.plan, month)
    n = replace_table(mart, wh.path(f"plan_fact_{month}"))
    db = in_catalog(spark, cfg, f"plan_fact_{month}", "product", "price")
    catalog.create_view(spark, f"{db}.v_plan_fact", PF.plan_fact_view_sql(f"{db}.plan_fact_{month}", f"{db}.product", f"{db}.price"))
    if shards:
        publish_plan_fact(wh.__getattr__(f"plan_fact_{month}"), wh.path("plan_fact_export"), shards)
    log("INFO", f"{n} rows inserted")
    log("INFO", "End plan/fact run")
    return n


def sales_mart_run(spark: SparkSession, cfg: RunConfig, month: str) -> int:
    """The trailing sales mart over the warehouse's sales, replaced as a whole table."""
    wh, log = Warehouse(spark, cfg.warehouse), _log(spark, cfg, "Sales mart calculation")
    log("INFO", "Start sales mart")
    n = replace_table(PF.sales_mart(wh.sales, month), wh.path("mart"))
    log("INFO", f"{n} rows inserted")
    log("INFO", "End sales mart")
    return n


def store_report_run(spark: SparkSession, cfg: RunConfig, load_start: str, load_end: str,
                     heads_start: str, report_months: tuple[str, str, int], report_days: tuple[str, str, int],
                     shards: int = 4, wide_export: bool = False) -> int:
    tune_for_scale(spark)
    wh, log = Warehouse(spark, cfg.warehouse), _log(spark, cfg, "Report")
    log("INFO", "Start store report run")
    for dim in ("promos", "promo_types", "stores"):
        LD.load_full(_src(spark, cfg, dim), wh.path(dim))
    LD.load_delta_partitions(spark, _src(spark, cfg, "traffic"), wh.path("traffic"), "date", load_start, load_end,
                             convert=True, keep_equal=True)
    LD.load_delta_partitions(spark, _src(spark, cfg, "coupons"), wh.path("coupons"), "date", load_start, load_end,
                             keep_equal=True)
    LD.load_delta_partitions(spark, _src(spark, cfg, "bills_head"), wh.path("bills_head"), "calday",
                             heads_start, load_end, keep_equal=True)
    items = load_bill_items(spark, cfg)
    LD.load_header_item(spark, items, wh.bills_head, wh.path("bills"), load_start, load_end,
                        key_range_pushdown=True, keep_equal=True)

    months = months_in(*LD.delta_window(load_start, load_end))
    RS.refresh(spark, wh.path("report_state"), wh.bills, wh.coupons, wh.promos, wh.traffic, months)
    total, names = 0, []
    for start, end, n, modes in ((*report_months, ("month_interval", "monthly")),
                                 (*report_days, ("day_interval", "daily"))):
        rep = RS.report(spark, wh.path("report_state"), wh.stores, start, end, n, modes, log=log)
        names += [w.report_name for w in RM.report_windows(start, end, n, modes)]
        rows, _ = write_observed(rep, wh.path("report"), "overwrite", "report_name", dynamic=True)
        total += rows
        log("INFO", f"{rows} rows inserted")
    schema = EXPORT_SCHEMA_WIDE if wide_export else EXPORT_SCHEMA
    mine = wh.report.where(F.col("report_name").isin(names))       # the reports of this run only
    publish_sharded(export_frame(mine, schema), wh.path("report_export"), shards)
    log("INFO", "End store report run")
    return total
