"""Keys and day cuts (P13). All of them assume a session pinned to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall(ts: Column | str) -> Column:
    """The UTC wall clock of an instant; a no-op on a zone-less timestamp."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def day_of(ts: Column | str) -> Column:
    """The UTC calendar day, the partition value of facts and aggregates."""
    return wall(ts).cast("date")


def time_text(ts: Column | str, zoned: bool) -> Column:
    """Text form of a timestamp inside a key; zoned instants carry ``+00``."""
    text = wall(ts).cast("string")
    return F.concat(text, F.lit("+00")) if zoned else text


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the ``|``-joined text of the parts; NULL parts are skipped."""
    return F.md5(
        F.concat_ws("|", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])
    )
