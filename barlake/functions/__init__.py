"""Column expressions (JVM-side, codegen-friendly).  No UDFs."""

from barlake.functions.columns import (  # noqa: F401
    age_minutes, candle_direction, flag_if, flag_null, log_return, money, pct, percent_text,
    repaired_price, round_half_up, safe_div, short_symbol, simple_return_pct,
)
