"""Scalar column functions shared by the layers.

All are plain ``Column`` expressions so Catalyst can fold, push and codegen
them.  Numeric conventions:

* every ratio divides by ``NULLIF(den, 0)`` so a zero denominator is NULL, not
  an ANSI error;
* rounding goes through DECIMAL(38,10) so it is half-away-from-zero on the
  decimal value (``round(1.005, 2) = 1.01``), then back to DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROUND_VIA = T.DecimalType(38, 10)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)``."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def pct(num, den) -> Column:
    """``(num / NULLIF(den, 0)) * 100``."""
    return safe_div(num, den) * 100


def simple_return_pct(cur, prev) -> Column:
    """``((cur - prev) / NULLIF(prev, 0)) * 100``."""
    return pct(_c(cur) - _c(prev), prev)


def log_return(cur, prev) -> Column:
    """``LN(cur / NULLIF(prev, 0))``; NULL when there is no previous value."""
    return F.ln(safe_div(cur, prev))


def round_half_up(x, digits: int) -> Column:
    """Round a DOUBLE half away from zero on its decimal value, as DOUBLE."""
    return F.round(_c(x).cast(_ROUND_VIA), digits).cast("double")


def repaired_price(price, close) -> Column:
    """A missing or non-positive price is replaced by the row's raw close."""
    p = _c(price)
    return F.when(p.isNull() | (p <= 0), _c(close)).otherwise(p)


def flag_null(x) -> Column:
    return F.when(_c(x).isNull(), F.lit(1)).otherwise(F.lit(0))


def flag_if(cond: Column) -> Column:
    """1 when ``cond`` is true; 0 when false or NULL."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def short_symbol(symbol) -> Column:
    """``BTC-USD`` -> ``BTC``."""
    return F.replace(_c(symbol), F.lit("-USD"), F.lit(""))


def candle_direction(open_, close) -> Column:
    """``down`` when close < open, else ``up`` (equal counts as up)."""
    return F.when(_c(close) < _c(open_), F.lit("down")).otherwise(F.lit("up"))


def money(x, digits: int = 2) -> Column:
    """``$1,234.56``; NULL stays NULL."""
    return F.concat(F.lit("$"), F.format_number(_c(x), digits))


def percent_text(x) -> Column:
    """``1.23%``; NULL stays NULL."""
    v = _c(x)
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(F.format_string("%.2f%%", v))


def age_minutes(as_of, ts) -> Column:
    """Minutes between ``ts`` and ``as_of`` (fractional)."""
    return (F.unix_micros(_c(as_of)) - F.unix_micros(_c(ts))) / F.lit(60_000_000.0)
