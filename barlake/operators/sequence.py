"""Previous-row values per key in time order (LAG), without a hot partition.

``LAG(x) OVER (PARTITION BY symbol ORDER BY timestamp)`` puts every row of a
symbol into one task.  With few symbols, or one symbol holding a third of the
data, that is one task doing a third of the job.  `with_previous` computes the
same values in two levels:

1. rows are split by (key, bucket), bucket = a coarse time slice (a UTC day by
   default); LAG runs inside each slice, in parallel;
2. the first row of each slice needs the last row of the previous non-empty
   slice.  A per-(key, bucket) summary (one row per slice, built with a
   partial aggregate) is LAGged per key - its size per key is the number of
   slices, bounded by the calendar - and its result is put in front of each
   slice as a *seed* row that is dropped after the LAG.

Slices nest to any depth (`slices`, finest first), so level 2 is split the same
way; `choose_slices` picks the depth from measured slice sizes.

Optional `initial` rows (state carried from an earlier run) take part as
ordinary older rows and are dropped from the result, so an incremental run
continues the sequence exactly where the previous run stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SEED = "_seed"
_BUCKET = "_bucket"


# Nested time units, finest first, and how many of a unit the next one holds.
UNITS = {"second": 60, "minute": 60, "hour": 24, "day": 0}


def _slice(order_col: str, unit: str) -> Column:
    return F.to_date(F.col(order_col)) if unit == "day" else F.date_trunc(unit, F.col(order_col))


def with_previous(df: DataFrame, keys: Sequence[str], order_col: str,
                  values: dict[str, str], bucket: Column | None = None,
                  initial: DataFrame | None = None, slices: Sequence[str] = ("day",)) -> DataFrame:
    """Add, for each ``src -> out`` in `values`, column `out` = `src` on the
    previous row of the same key (NULL for the first row).

    `order_col` must be unique within a key (it is, after dedup).  `slices`
    are nested time units, finest first (e.g. ``("hour", "day")``): rows are
    split by the first; the per-slice summary is LAGged by the same method
    one level up, and only the last level is a plain per-key window - so a
    hot day can be spread over hours.  Without slices it is one plain per-key
    window, for keys measured to be small.  `bucket` overrides the first level."""
    keys = list(keys)
    srcs = [c for c in values if c != order_col]
    slices = list(slices)
    rows = df.withColumn(_SEED, F.lit(False))
    if initial is not None:
        init = initial.select(*keys, order_col, *srcs).withColumn(_SEED, F.lit(True))
        rows = rows.unionByName(init, allowMissingColumns=True)
    if bucket is None and not slices:
        whole = Window.partitionBy(*keys).orderBy(F.col(order_col).asc(), F.col(_SEED).desc())
        out = rows.select("*", *[F.lag(s).over(whole).alias(o) for s, o in values.items()])
        return out.filter(~F.col(_SEED)).drop(_SEED)
    rows = rows.withColumn(_BUCKET, _slice(order_col, slices[0]) if bucket is None else bucket)

    # Level 2: the last row of every (key, bucket) slice - one hash aggregate over
    # the few columns needed - then the previous slice's last row.
    carried = {c: f"_prev_{c}" for c in (order_col, *srcs)}
    last = (rows.groupBy(*keys, _BUCKET)
            .agg(F.max(order_col).alias("_at"), *[F.max_by(s, F.col(order_col)).alias(f"_of_{s}") for s in srcs])
            .select(*keys, _BUCKET, F.col("_at").alias(order_col), *[F.col(f"_of_{s}").alias(s) for s in srcs]))
    if len(slices) > 1:
        start = f"_start{len(slices)}"              # a name of its own at every level
        upper = last.withColumnRenamed(_BUCKET, start)
        prev = with_previous(upper, keys, start, carried, slices=slices[1:])
        prev = prev.withColumnRenamed(start, _BUCKET)
    else:
        per_key = Window.partitionBy(*keys).orderBy(_BUCKET)
        prev = last.select(*keys, _BUCKET, *[F.lag(c).over(per_key).alias(o) for c, o in carried.items()])
    seeds = (prev.filter(F.col(carried[order_col]).isNotNull())
             .select(*keys, _BUCKET, *[F.col(o).alias(c) for c, o in carried.items()], F.lit(True).alias(_SEED)))

    # Level 1: LAG inside each slice, with the seed row in front.
    seeded = rows.unionByName(seeds, allowMissingColumns=True)
    in_slice = Window.partitionBy(*keys, _BUCKET).orderBy(F.col(order_col).asc(), F.col(_SEED).desc())
    out = seeded.select("*", *[F.lag(s).over(in_slice).alias(o) for s, o in values.items()])
    return out.filter(~F.col(_SEED)).drop(_SEED, _BUCKET)


def choose_slices(df: DataFrame, keys: Sequence[str], order_col: str, limit: int = 20_000,
                  coarsest: str = "day") -> tuple[str, ...]:
    """Slices for `with_previous`, finest first, such that no LAG of a key sorts
    more than about `limit` rows: the coarsest unit whose largest slice fits (one
    counting aggregate per unit tried, from days down; seconds if none fits), then
    the coarsest unit that holds at most `limit` slices of the unit below, up to
    days, whose number per key the calendar bounds."""
    units = list(UNITS)
    at = units.index(coarsest)
    while at:
        sizes = df.groupBy(*keys, _slice(order_col, units[at]).alias(_BUCKET)).agg(F.count("*").alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= limit:
            break
        at -= 1
    return nested_slices(units[at], limit)


def nested_slices(finest: str, limit: int = 20_000) -> tuple[str, ...]:
    """The units above `finest` that keep every level within `limit` slices."""
    units, chain = list(UNITS), [finest]
    while chain[-1] != "day":
        at = units.index(chain[-1])
        held, above = UNITS[units[at]], at + 1
        while above + 1 < len(units) and held * UNITS[units[above]] <= limit:
            held *= UNITS[units[above]]
            above += 1
        chain.append(units[above])
    return tuple(chain)


def with_previous_plain(df: DataFrame, keys: Sequence[str], order_col: str,
                        values: dict[str, str]) -> DataFrame:
    """Single-level LAG per key.  Only for inputs whose rows per key have a
    proven bound (e.g. one row per key per calendar day)."""
    w = Window.partitionBy(*keys).orderBy(order_col)
    return df.select("*", *[F.lag(s).over(w).alias(o) for s, o in values.items()])
