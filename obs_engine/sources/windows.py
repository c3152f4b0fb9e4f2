"""Time windows of an incremental run."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the hourly job.
INITIAL_HOURS = 6
OVERLAP_HOURS = 2
CHUNK_HOURS = 2


def as_utc(value: datetime, label: str = "window bound") -> datetime:
    if value.tzinfo is None:
        raise ValueError(f"{label} must carry a time zone")
    return value.astimezone(timezone.utc)


def incremental_window(
    watermark: datetime | None,
    now: datetime,
    overlap_hours: int = OVERLAP_HOURS,
    initial_hours: int = INITIAL_HOURS,
) -> tuple[datetime, datetime]:
    """Closed window to request next: overlap the newest stored observation,
    or look back ``initial_hours`` when nothing is stored yet."""
    end = as_utc(now, "window end")
    if watermark is None:
        return end - timedelta(hours=initial_hours), end
    start = as_utc(watermark, "watermark") - timedelta(hours=overlap_hours)
    return min(start, end), end


def watermark_of(df: DataFrame, ts: str) -> datetime | None:
    """Newest value of ``ts`` (one column is read; partial max before the shuffle)."""
    top = df.agg(F.max(F.col(ts).cast("timestamp")).alias("top")).select(
        F.unix_micros("top").alias("micros")
    )
    micros = top.first()["micros"]
    if micros is None:
        return None
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def in_window(ts: Column | str, start: datetime, end: datetime | None = None) -> Column:
    """``start <= ts [<= end]``: closed on both sides, cut to whole seconds.

    Bounds are literals, so the predicate reaches the Parquet scan.
    """
    start = as_utc(start).replace(microsecond=0)
    c = F.col(ts) if isinstance(ts, str) else ts
    if end is None:
        return c >= F.lit(start)
    end = as_utc(end).replace(microsecond=0)
    if end < start:
        raise ValueError("window end lies before its start")
    return c.between(F.lit(start), F.lit(end))


def _check_chunks(hours: int) -> None:
    if hours < 1:
        raise ValueError("chunk length must be at least one hour")


def time_chunks(
    spark: SparkSession, start: datetime, end: datetime, hours: int = CHUNK_HOURS
) -> DataFrame:
    """Chained closed chunks ``(chunk_no, chunk_start, chunk_end)`` covering the window.

    Neighbours share their border; a zero-length window is one chunk.
    """
    start, end = as_utc(start), as_utc(end)
    if end < start:
        raise ValueError("window end lies before its start")
    bounds = spark.range(1).select(F.lit(start).alias("lo"), F.lit(end).alias("hi"))
    return chunks_between(bounds, "lo", "hi", hours)


def chunks_between(df: DataFrame, lo: str, hi: str, hours: int = CHUNK_HOURS) -> DataFrame:
    """One row per chunk of every ``[lo, hi]`` row of ``df``, in time order."""
    _check_chunks(hours)
    step = F.make_dt_interval(hours=F.lit(hours))
    starts = F.sequence(F.col(lo), F.col(hi), step)
    return (
        df.select(lo, hi, F.posexplode(starts).alias("chunk_no", "chunk_start"))
        .filter((F.col("chunk_start") < F.col(hi)) | (F.col("chunk_no") == 0))
        .select(
            F.col("chunk_no").cast("long").alias("chunk_no"),
            "chunk_start",
            F.least(F.col("chunk_start") + step, F.col(hi)).alias("chunk_end"),
        )
    )


def chunk_numbers(ts: Column, lo: Column, hi: Column, hours: int = CHUNK_HOURS) -> Column:
    """The chunks of ``[lo, hi]`` that contain ``ts``, as an array of one or two.

    An instant on an inner border belongs to the chunk ending there and to the
    one starting there, which is why fetched chunks overlap by one instant.
    """
    _check_chunks(hours)
    width = F.lit(hours * 3_600_000_000)
    span = F.unix_micros(hi) - F.unix_micros(lo)
    past = F.unix_micros(ts) - F.unix_micros(lo)
    last = F.greatest(F.ceil(span / width) - 1, F.lit(0)).cast("long")
    own = F.least(F.floor(past / width), last).cast("long")
    on_border = (past % width == 0) & (own > 0) & (past < span)
    both = F.array(own - 1, own)
    at_end = F.array(own)
    return F.when(on_border, both).otherwise(at_end)
