"""Key-value dictionaries over dimension tables and ``dictGet``-style lookups.

A dictionary keeps ONE row per key. Duplicate keys are resolved deterministically by
taking the smallest attribute tuple (a partial aggregate, so a hot key never lands in
one task with all its rows). Lookups are left joins; a missing key yields the type
default ('' for text, 0 for numbers). Whether the dictionary is broadcast is left to
the planner's runtime size check (AQE), with a shuffle join beyond the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def dictionary(df: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    attrs = list(attrs)
    return (df.where(F.col(key).isNotNull())
              .groupBy(key).agg(F.min(F.struct(*attrs)).alias("_v"))
              .select(key, *[F.col(f"_v.{a}").alias(a) for a in attrs]))


def _default(dtype):
    if isinstance(dtype, StringType):
        return F.lit("")
    if isinstance(dtype, NumericType):
        return F.lit(0).cast(dtype)
    return F.lit(None).cast(dtype)


def dict_get(keys: DataFrame, key_col: str, dict_df: DataFrame, dict_key: str,
             attrs: Sequence[str]) -> DataFrame:
    """For every row of ``keys``, the dictionary attributes of ``key_col`` (defaults
    when the key is missing)."""
    d = dict_df.select(F.col(dict_key).alias("_dk"), *attrs)
    types = {f.name: f.dataType for f in d.schema.fields}
    j = keys.join(d, keys[key_col] == d["_dk"], "left")
    return j.select(*[keys[c] for c in keys.columns],
                    *[F.coalesce(d[a], _default(types[a])).alias(a) for a in attrs])
