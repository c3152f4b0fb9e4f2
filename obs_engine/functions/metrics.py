"""Derived measures and classifications."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(18,0)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(c: Column | str, yes: str = "OUI") -> Column:
    """Text flag to boolean; NULL is false."""
    return F.coalesce(_col(c) == yes, F.lit(False))


def has_any(*cols: str) -> Column:
    """True when at least one of the columns holds a value."""
    present = F.col(cols[0]).isNotNull()
    for name in cols[1:]:
        present = present | F.col(name).isNotNull()
    return present


def pct(n: Column | str, d: Column | str) -> Column:
    """``n / d * 100`` at two decimals, half up; 0 when ``d`` is not positive."""
    n, d = _col(n), _col(d)
    value = F.round(n.cast(WIDE) / d.cast(WIDE) * 100, 2).cast("decimal(18,2)")
    return F.when(d > 0, value).otherwise(F.lit(0).cast("decimal(18,2)"))


def per_second(n: Column | str, seconds: Column | str) -> Column:
    """Records per second at two decimals; 0 when no time passed."""
    n, seconds = _col(n), _col(seconds)
    value = F.round(n.cast(WIDE) / seconds.cast("decimal(12,3)"), 2).cast("decimal(18,2)")
    return F.when(seconds > 0, value).otherwise(F.lit(0).cast("decimal(18,2)"))


def occupancy_pct(bikes: Column | str, capacity: Column | str) -> Column:
    """Share of docks holding a bike; 0 for a missing or non-positive capacity."""
    return pct(bikes, capacity)


# Station status labels, first match wins in this order.
STATION_STATUSES = (
    "Non installée",
    "Hors service",
    "Vide",
    "Presque pleine",
    "Presque vide",
    "Normal",
)
NEARLY_FULL_PCT = 90
NEARLY_EMPTY_PCT = 15


def station_status(installed: Column | str, renting: Column | str, occupancy: Column | str) -> Column:
    """Six-way label; an unknown occupancy falls through to the last one."""
    tests = (
        ~_col(installed),
        ~_col(renting),
        _col(occupancy) == 0,
        _col(occupancy) >= NEARLY_FULL_PCT,
        _col(occupancy) <= NEARLY_EMPTY_PCT,
    )
    label = F.lit(STATION_STATUSES[-1])
    for test, name in reversed(list(zip(tests, STATION_STATUSES))):
        label = F.when(test, F.lit(name)).otherwise(label)
    return label


def instant(as_of: datetime | Column | None) -> Column:
    """The clock of a run: a literal instant, or the wall clock when omitted."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return F.lit(as_of)


def data_age_minutes(loaded_at: Column | str, as_of: datetime | Column | None) -> Column:
    """Minutes since the load, two decimals."""
    elapsed = F.unix_micros(instant(as_of)) - F.unix_micros(_col(loaded_at).cast("timestamp"))
    return F.round(elapsed.cast("decimal(20,0)") / F.lit(60_000_000), 2).cast("decimal(18,2)")


def is_fresh(loaded_at: Column | str, as_of: datetime | Column | None, hours: int = 2) -> Column:
    """Loaded within the last ``hours``, border included."""
    return _col(loaded_at).cast("timestamp") >= instant(as_of) - F.make_dt_interval(
        hours=F.lit(hours)
    )


def mean2(c: Column | str) -> Column:
    """Mean of an exact column at two decimals, NULLs ignored."""
    return F.round(F.avg(_col(c)), 2).cast("decimal(20,2)")


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    """``sum(v * w) / sum(w)`` of an exact value, NULL when the weights sum to zero."""
    value, weight = _col(value), _col(weight).cast(WIDE)
    return F.sum(value * weight).cast("double") / F.nullif(F.sum(weight), F.lit(0)).cast("double")


def success_pct(ok: Column | str) -> Column:
    """Percentage of true rows at two decimals, NULL on empty input (A10)."""
    hits = F.sum(F.when(_col(ok), 1).otherwise(0))
    ratio = hits.cast(WIDE) * 100 / F.nullif(F.count(F.lit(1)), F.lit(0)).cast(WIDE)
    return F.round(ratio, 2).cast("decimal(18,2)")
