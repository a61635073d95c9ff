"""Sources: landing-zone bar files, layer tables, and bars derived from the
driver's test tables."""

from barlake.sources.fixtures import raw_bars, tick_bars, load_table  # noqa: F401
from barlake.sources.landing import (  # noqa: F401
    missing_symbols, read_bars, read_layer, require_rows, time_range, only_symbols,
)
