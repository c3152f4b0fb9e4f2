"""Typed reading of loosely typed API fields.

Each parser returns ``(value, bad)``: the typed Column, and a boolean Column
that is true when the input is present but unusable. Nothing is dropped here;
the caller turns ``bad`` into a reject reason.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unbounded numerics are kept at this precision; longer fractions are rounded.
EXACT = "decimal(28,12)"

_ISO_WITH_OFFSET = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}(:?\d{2}(:?\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}:?\d{2})$"


@dataclass(frozen=True)
class Parsed:
    value: Column
    bad: Column


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def parse_ts(c: Column | str) -> Parsed:
    """ISO-8601 with an explicit offset -> instant. Missing or naive is bad."""
    c = _col(c)
    value = F.when(c.rlike(_ISO_WITH_OFFSET), c.try_cast("timestamp"))
    return Parsed(value, value.isNull())


def parse_date(c: Column | str) -> Parsed:
    """First ten characters as an ISO date; NULL and '' stay NULL."""
    c = _col(c)
    head = F.substring(c, 1, 10)
    value = F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date"))
    return Parsed(value, ~_blank(c) & value.isNull())


def parse_decimal(c: Column | str) -> Parsed:
    """Exact decimal; booleans, NaN, infinities and free text are bad."""
    c = _col(c).cast("string")
    value = F.when(~_blank(c), c.try_cast(EXACT))
    return Parsed(value, ~_blank(c) & value.isNull())


def parse_point(lon: Column | str, lat: Column | str) -> tuple[Column, Column, Column]:
    """``(longitude, latitude, bad)``: both or neither, inside the globe."""
    lon_text, lat_text = _col(lon).cast("string"), _col(lat).cast("string")
    x, y = lon_text.try_cast("double"), lat_text.try_cast("double")
    absent = lon_text.isNull() & lat_text.isNull()
    usable = F.coalesce(x.between(-180, 180) & y.between(-90, 90), F.lit(False))
    return F.when(usable, x), F.when(usable, y), ~absent & ~usable


def canonical_json(c: Column | str) -> Parsed:
    """JSON object with sorted keys and no spaces, so equality is semantic."""
    c = _col(c)
    variant = F.try_parse_json(c)
    is_object = F.schema_of_variant(variant).startswith("OBJECT")
    value = F.when(~_blank(c) & is_object, F.to_json(variant))
    return Parsed(value, ~_blank(c) & value.isNull())


def json_or_text(c: Column | str) -> Column:
    """Plain text as is; an object or array becomes sorted-key JSON."""
    c = _col(c)
    return F.when(
        c.rlike(r"^\s*[\[{]"), F.coalesce(F.to_json(F.try_parse_json(c)), c)
    ).otherwise(c)


def non_blank(c: Column | str) -> Column:
    """'' -> NULL."""
    c = _col(c).cast("string")
    return F.when(c != "", c)
