"""Streaming upserts, day windows, latest state and dedup.

State is kept per key, never per row, except for the bounded dedup window. The
upsert paths have no dropping watermark: a late row is merged whenever it comes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from obs_engine.operators.dedup import dedup_last, latest_per_key
from obs_engine.operators.merge import TableSpec, Warehouse
from obs_engine.sources.pages import pages_of, records_of


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """New files under ``path`` as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def stream_records(spark: SparkSession, path: str, record: StructType) -> DataFrame:
    """Records of landed pages (``lines`` layout) as a stream."""
    lines = stream_files(spark, path, StructType([StructField("value", StringType())]), "text")
    return records_of(pages_of(lines, "value", record))


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need an instant: a zone-less column is read as UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def each_batch(
    df: DataFrame,
    action: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    available_now: bool = True,
) -> StreamingQuery:
    writer = (
        df.writeStream.foreachBatch(action).outputMode(mode).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def each_poll(
    documents: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    """One poll of ``polled_documents``. A poll that died is made again before the new one.

    Spark runs one micro-batch of such a source per start, and a replay is that batch, so
    the query is started until it finds nothing more to ask for.
    """
    ran = [True]

    def noted(batch: DataFrame, number: int) -> None:
        action(batch, number)
        ran.append(True)

    while ran:
        ran.clear()
        each_batch(documents, noted, checkpoint).awaitTermination()


def upsert_stream(
    df: DataFrame,
    warehouse: Warehouse,
    spec: TableSpec,
    compare: Sequence[str],
    lineage: Sequence[str],
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """Each micro-batch: last row per key, then upsert of changed rows.

    A replayed micro-batch changes nothing, so at-least-once delivery is enough.
    """

    def merge(batch: DataFrame, _: int) -> None:
        warehouse.upsert(spec, dedup_last(batch, spec.key, lineage).drop(*_extra(lineage)), compare)

    def _extra(names: Sequence[str]) -> list[str]:
        return [n for n in names if n in ("chunk_no", "offset", "pos")]

    return each_batch(df, merge, checkpoint, **options)


def append_new_stream(
    df: DataFrame, warehouse: Warehouse, spec: TableSpec, first: Sequence[str], checkpoint: str,
    **options,
) -> StreamingQuery:
    """Insert-if-absent with unbounded memory: the table itself is the state."""

    def insert(batch: DataFrame, _: int) -> None:
        rest = [c for c in batch.columns if c not in spec.key and c not in first]
        earliest = batch.groupBy(*spec.key).agg(F.min(F.struct(*first, *rest)).alias("row"))
        warehouse.insert_ignore(spec, earliest.select(*spec.key, "row.*"))

    return each_batch(df, insert, checkpoint, **options)


def day_window_stream(
    df: DataFrame, entity: str, ts: str, measures: dict[str, Column], horizon: str
) -> DataFrame:
    """Daily aggregate as a one-day tumbling window.

    ``horizon`` is the watermark: it must cover the longest correction delay.
    """
    day = F.window(ts, "1 day")
    return (
        event_time(df, ts)
        .withWatermark(ts, horizon)
        .groupBy(entity, day)
        .agg(F.count(F.lit(1)).alias("observation_count"),
             *[m.alias(n) for n, m in measures.items()])
        .withColumn("observation_date", F.col("window.start").cast("timestamp_ntz").cast("date"))
        .drop("window")
    )


def latest_state_stream(df: DataFrame, key: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """Latest row per key as running state, one row each."""
    return latest_per_key(df, key, latest)


def first_wins_stream(df: DataFrame, key: Sequence[str], ts: str, horizon: str) -> DataFrame:
    """First row per key within the watermark (I7); state is dropped after ``horizon``."""
    return event_time(df, ts).withWatermark(ts, horizon).dropDuplicatesWithinWatermark(list(key))


def keep_table(
    df: DataFrame, warehouse: Warehouse, spec: TableSpec, checkpoint: str, **options
) -> StreamingQuery:
    """Keep a stored table equal to an update-mode result: changed keys are replaced (I4)."""
    return each_batch(
        df, lambda batch, _: warehouse.delete_insert(spec, batch), checkpoint, "update", **options
    )
