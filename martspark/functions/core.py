"""Scalar semantics of the source warehouse, re-expressed as Spark columns.

* numeric division is exact and rounds half away from zero on assignment to a
  numeric(p,s) column; Spark decimal division + a cast to DECIMAL(p,s) does the same
  as long as the intermediate scale is wide, which ``exact_div`` guarantees.
* assignment numeric -> int8 rounds, it does not truncate (``to_int8``).
* char(n) casts truncate to n characters; trailing blanks are insignificant
  (``bpchar``).
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_div(num: ColumnOrName, den: ColumnOrName, scale: int, precision: int = 17) -> Column:
    """``num / den`` rounded half-up to DECIMAL(precision, scale).

    The numerator is widened to DECIMAL(28,4) and the denominator to DECIMAL(19,0), so
    Spark keeps 14 fractional digits before the final rounding; for integer or cent
    denominators below 1e8 this is the exact half-up result. A zero divisor raises
    (ANSI), as in the source database; NULL operands give NULL.
    """
    q = _col(num).cast(DecimalType(28, 4)) / _col(den).cast(DecimalType(19, 0))
    return q.cast(DecimalType(precision, scale))


def to_numeric(c: ColumnOrName, precision: int, scale: int) -> Column:
    """Assignment to numeric(p,s): half-up rounding to the target scale."""
    return _col(c).cast(DecimalType(precision, scale))


def to_int8(c: ColumnOrName) -> Column:
    """Assignment numeric -> int8: round half away from zero, then cast."""
    return F.round(_col(c), 0).cast("bigint")


def bpchar(c: ColumnOrName, n: int) -> Column:
    """``x::bpchar(n)``: keep the first n characters; padding is not significant."""
    return F.rtrim(F.substring(_col(c).cast("string"), 1, n))


def to_char_digits(c: ColumnOrName, width: int = 9) -> Column:
    """``to_char(n, '9' * width)`` for integers: the sign ('-' or a blank) sits right
    before the digits, right-aligned in ``width + 1`` places; too many digits print
    as '#' * width."""
    n = _col(c).cast("bigint")
    digits = F.abs(n).cast("string")
    sign = F.when(n < 0, F.lit("-")).otherwise(F.lit(" "))
    return F.when(F.length(digits) > width, F.concat(sign, F.lit("#" * width))).otherwise(
        F.lpad(F.concat(sign, digits), width + 1, " "))


def unify_name(c: ColumnOrName) -> Column:
    """Name hygiene for text keys: drop ; / and quote characters, trim, lower-case."""
    return F.lower(F.trim(F.translate(_col(c), ";/'", "")))


def split_qualified_name(c: ColumnOrName) -> tuple[Column, Column]:
    """Split ``schema.table`` at the first dot, as ``left(n, position-1)`` and
    ``right(n, length-position)`` do: with no dot the table part is the whole name and
    the schema part is the name without its last character."""
    name = _col(c)
    pos = F.instr(name, ".")
    schema = F.when(pos > 0, F.substr(name, F.lit(1), pos - 1)).otherwise(
        F.substr(name, F.lit(1), F.length(name) - 1))
    table = F.substr(name, pos + 1)
    return schema, table


def parse_date_text(c: ColumnOrName, fmt: str = "dd.MM.yyyy", strict: bool = True) -> Column:
    """Text date to DATE. ``strict`` raises on bad text (ANSI), else yields NULL."""
    return F.to_date(_col(c), fmt) if strict else F.try_to_date(_col(c), F.lit(fmt))


def date_window(c: ColumnOrName, start, end, part_col: str | None = None) -> Column:
    """Half-open ``start <= c < end``; with ``part_col`` the same window on the month
    partition column is added so the scan prunes partitions."""
    s, e = _as_date(start), _as_date(end)
    cond = (_col(c) >= F.lit(s)) & (_col(c) < F.lit(e))
    if part_col is not None:   # partitions starting in (s - 1 month, e) can hold such rows
        cond = cond & (F.col(part_col) > F.lit(add_months_py(s, -1))) & (F.col(part_col) < F.lit(e))
    return cond


def prune_months(df, lo, hi, part_col: str = "pmonth"):
    """Add a predicate on the month partition column that keeps every partition which
    can hold a date in [lo, hi]: partition starts in (lo - 1 month, hi]. A no-op for
    frames without that column. Needed because a filter on the date column itself
    does not prune a derived partition column."""
    if part_col not in df.columns:
        return df
    return df.where((F.col(part_col) > F.lit(add_months_py(_as_date(lo), -1)))
                    & (F.col(part_col) <= F.lit(_as_date(hi))))


def _as_date(v) -> dt.date:
    if isinstance(v, dt.datetime):
        return v.date()
    return v if isinstance(v, dt.date) else dt.date.fromisoformat(str(v)[:10])


def year_window(c: ColumnOrName, year: int) -> Column:
    """``date_trunc('year', c) = year`` rewritten as a range that prunes and pushes down."""
    return (_col(c) >= F.lit(dt.date(year, 1, 1))) & (_col(c) < F.lit(dt.date(year + 1, 1, 1)))


def month_window(month_start: dt.date, anchor_day: int = 1) -> tuple[dt.date, dt.date]:
    start = month_start.replace(day=anchor_day)
    return start, add_months_py(start, 1)


# ---- driver-side date arithmetic on parameters (never on data) ----

def add_months_py(d: dt.date, n: int) -> dt.date:
    """Calendar month arithmetic clamped to the month end (date + n months)."""
    m = d.month - 1 + n
    y = d.year + m // 12
    m = m % 12 + 1
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def trunc_month_py(d) -> dt.date:
    if isinstance(d, dt.datetime):
        d = d.date()
    return d.replace(day=1)


def months_between_whole(later: dt.date, earlier: dt.date) -> int:
    """Whole calendar months from ``earlier`` to ``later`` (floor)."""
    months = (later.year - earlier.year) * 12 + (later.month - earlier.month)
    if add_months_py(earlier, months) > later:
        months -= 1
    return months
