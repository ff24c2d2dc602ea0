"""Declared schemas of the warehouse tables (targets) and their source forms.

Fixed values: column names and types as the warehouse DDL declares them. ``LIKE t``
clones become reuse of the same StructType; ``check_schema`` is the template check.
"""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)


def _s(*cols) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in cols])


S, I, L, D, TS, B = StringType(), IntegerType(), LongType(), DateType(), TimestampType(), BooleanType()


def DEC(p, s):
    return DecimalType(p, s)


SCHEMAS: dict[str, StructType] = {
    "plan": _s(("date", D, False), ("region", S, False), ("matdirec", S, False), ("quantity", I, False),
               ("distr_chan", I, False)),
    "sales": _s(("date", D, True), ("region", S, True), ("material", S, True), ("distr_chan", I, True),
                ("quantity", I, True), ("check_nm", S, False), ("check_pos", S, False)),
    "product": _s(("material", S, True), ("asgrp", S, True), ("brand", S, True), ("matcateg", S, True),
                  ("matdirec", I, True), ("txt", S, True)),
    "region": _s(("region", S, True), ("txt", S, True)),
    "chanel": _s(("distr_chan", I, True), ("txtsh", S, True)),
    "price": _s(("material", S, True), ("region", S, True), ("distr_chan", I, True), ("price", DEC(8, 2), True)),
    "stores": _s(("plant", S, False), ("txt", S, False)),
    "traffic": _s(("plant", S, True), ("date", D, True), ("time", S, True), ("frame_id", S, True),
                  ("quantity", I, True)),
    "traffic_source": _s(("plant", S, True), ("date", S, True), ("time", S, True), ("frame_id", S, True),
                         ("quantity", I, True)),
    "bills_head": _s(("billnum", L, True), ("plant", S, True), ("calday", D, True)),
    "bills_item": _s(("billnum", L, True), ("billitem", L, True), ("material", L, True),
                     ("netval", DEC(17, 2), True), ("tax", DEC(17, 2), True), ("qty", L, True),
                     ("rpa_sat", DEC(17, 2), True)),
    "bills": _s(("billnum", L, True), ("billitem", L, True), ("material", L, True), ("plant", S, True),
                ("calday", D, True), ("calmonth", S, True), ("rpa_sat", DEC(17, 2), True), ("qty", L, True),
                ("netval", DEC(17, 2), True), ("tax", DEC(17, 2), True)),
    "coupons": _s(("plant", S, False), ("date", D, False), ("coupon_num", S, False), ("promo_id", S, False),
                  ("material", L, False), ("billnum", L, False)),
    "promos": _s(("promo_id", S, False), ("promo_name", S, False), ("promo_type", S, False),
                 ("material", L, False), ("discount_amount", L, False)),
    "promo_types": _s(("type_id", S, False), ("txt", S, False)),
    "mart": _s(("region", S, True), ("material", S, True), ("distr_chan", I, True), ("qnt", L, True),
               ("chk_cnt", L, True)),
    "plan_fact": _s(("region_code", S, True), ("matdirec_code", S, True), ("distr_chanel", I, True),
                    ("planned_quantity", I, True), ("real_quantity", I, True), ("complete_percent", I, True),
                    ("mosteff_material", S, True)),
    "report": _s(("plant", S, True), ("txt", S, True), ("turnover", L, True), ("coupon_discount", DEC(17, 2), True),
                 ("turnover_with_discount", DEC(17, 2), True), ("material_qty", L, True), ("bills_qty", L, True),
                 ("traffic", L, True), ("matdisc_qty", L, True), ("matdisc_percent", DEC(17, 1), True),
                 ("avg_mat_qty", DEC(17, 2), True), ("conversion_rate", DEC(17, 2), True),
                 ("avg_bill", DEC(17, 1), True), ("avg_profit", DEC(17, 2), True)),
    "logs": _s(("log_id", S, False), ("log_timestamp", TS, False), ("log_type", S, False), ("log_msg", S, False),
               ("log_location", S, True), ("is_error", B, True), ("log_user", S, True)),
}


def check_schema(df, name: str) -> list[tuple[str, str, str]]:
    """Mismatches of ``df`` against the registered template (empty = conforms)."""
    from martspark.operators.quality import schema_mismatches
    return schema_mismatches(df, SCHEMAS[name])
