"""Column expressions shared by the ETL and the analytics.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
The money and percent helpers pin the cross-engine rules: exact decimal sums,
DOUBLE only at the output, half-away-from-zero rounding done by hand so every
engine gives the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.schemas import MONEY

# Output labels of the analytics.
WEEKEND, WEEKDAY = "Weekend", "Weekday"
SPRING, SUMMER, FALL, WINTER = "Spring", "Summer", "Fall", "Winter"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_type(date: str | Column) -> Column:
    """'Weekend' for Sunday (1) and Saturday (7) under Spark's dayofweek."""
    return F.when(F.dayofweek(col(date)).isin(1, 7), F.lit(WEEKEND)).otherwise(F.lit(WEEKDAY))


def season(month: str | Column) -> Column:
    """Meteorological season; no ELSE branch, so a bad month gives NULL."""
    m = col(month)
    return (
        F.when(m.isin(3, 4, 5), F.lit(SPRING))
        .when(m.isin(6, 7, 8), F.lit(SUMMER))
        .when(m.isin(9, 10, 11), F.lit(FALL))
        .when(m.isin(12, 1, 2), F.lit(WINTER))
    )


def season_rank(season_col: str | Column) -> Column:
    s = col(season_col)
    return (
        F.when(s == SPRING, 1).when(s == SUMMER, 2).when(s == FALL, 3).when(s == WINTER, 4)
    )


def line_total(quantity: str | Column, price: str | Column) -> Column:
    """quantity x price in exact decimals, stored as DECIMAL(10,2); NULL if it doesn't fit."""
    exact = col(quantity).cast("decimal(10,0)") * col(price).cast(MONEY)
    return exact.try_cast(MONEY)


def as_double(c: str | Column) -> Column:
    return col(c).cast("double")


def cents(c: str | Column) -> Column:
    """Exact integer cents of a 2-scale decimal."""
    return (col(c) * 100).cast("bigint")


def round_half_up(x: str | Column, digits: int = 2) -> Column:
    """ROUND(x, d) half away from zero, spelled out so every engine agrees."""
    scale = float(10 ** digits)
    v = col(x)
    return F.signum(v) * F.floor(F.abs(v) * scale + 0.5) / scale


def pct_change(cur: str | Column, prev: str | Column) -> Column:
    """((cur - prev) / prev) * 100 in DOUBLE; NULL when prev is NULL or 0."""
    c, p = as_double(cur), as_double(prev)
    return F.try_divide(c - p, p) * 100.0


def mean(total: str | Column, n: str | Column) -> Column:
    """Average as DOUBLE sum / count (exact sum first)."""
    return F.try_divide(as_double(total), as_double(n))


def format_cents(c: str | Column) -> Column:
    """Integer cents as text with two decimals: 123456 -> '1234.56', -5 -> '-0.05'."""
    v = col(c).cast("bigint")
    whole = F.call_function("div", F.abs(v), F.lit(100).cast("bigint"))
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, whole.cast("string"), F.lit("."), F.lpad((F.abs(v) % 100).cast("string"), 2, "0"))
