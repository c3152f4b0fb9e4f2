"""Polling a paginated feed as a Structured Streaming source.

A micro-batch is one poll. Its offset names the window it asks for: the end is the poll's
clock, the start lies ``overlap`` hours before the newest stored observation. Both stand in
the offset log before the first page is fetched, so a batch that is replayed after a
failure asks for the same window again, whatever the clock or the store says by then.
Windows are fetched in chunks, one task each, by the page provider of ``provider.py``.

A query started with a fixed ``now`` makes one poll and has nothing more to do until it is
started again with a later one (``availableNow``). Without ``now`` it polls on: each
window ends at the last full ``every`` seconds of the clock and overlaps the one before by
``overlap`` hours, counted from its end.
"""

from __future__ import annotations

import base64
import json
from datetime import datetime, timedelta, timezone

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader

from obs_engine.sources.pages import MAX_RECORDS_PER_QUERY, PAGE_SIZE
from obs_engine.sources.provider import ChunkPartition, PageProvider, PageReader
from obs_engine.sources.windows import CHUNK_HOURS, INITIAL_HOURS, OVERLAP_HOURS, as_utc, incremental_window


class PollSource(DataSource):
    """Rows are raw page documents: ``chunk_no, offset, document``."""

    @classmethod
    def name(cls) -> str:
        return "observation_polls"

    def schema(self) -> str:
        return "chunk_no BIGINT, offset BIGINT, document STRING"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PollReader(self.options)


def instant(text: str | None) -> datetime | None:
    return as_utc(datetime.fromisoformat(text)) if text else None


class PollReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        # Spark's options ignore case, a copy of them would not: what the pages need is taken by name.
        self.options = {k: options[k] for k in ("provider", "pageSize", "maxRecords") if k in options}
        self.now, self.watermark = instant(options.get("now")), instant(options.get("watermark"))
        self.hours = int(options.get("chunkHours", CHUNK_HOURS))
        self.overlap = int(options.get("overlapHours", OVERLAP_HOURS))
        self.initial = int(options.get("initialHours", INITIAL_HOURS))
        self.every = int(options.get("everySeconds", 3600))
        if self.hours < 1:
            raise ValueError("chunk length must be at least one hour")
        # Checked on the driver, before a task asks for anything.
        PageReader({**self.options, "chunks": "[]"})
        self.planned: dict | None = None

    def initialOffset(self) -> dict:
        return {"start": None, "end": None}

    def latestOffset(self) -> dict:
        """The window of the next poll; the same one as long as its end is."""
        end = self.now or self.clock()
        if self.planned is None or instant(self.planned["end"]) < end:
            known = instant(self.planned["end"]) if self.planned else self.watermark
            start, end = incremental_window(known, end, self.overlap, self.initial)
            # Closed windows of whole seconds.
            cut = lambda t: t.replace(microsecond=0).isoformat()
            self.planned = {"start": cut(start), "end": cut(end)}
        return self.planned

    def clock(self) -> datetime:
        seconds = int(datetime.now(timezone.utc).timestamp()) // self.every * self.every
        return datetime.fromtimestamp(seconds, timezone.utc)

    def partitions(self, start: dict, end: dict) -> list[ChunkPartition]:
        """Chunks of the window that ``end`` names; neighbours share their border."""
        low, high = instant(end["start"]), instant(end["end"])
        chunks, at = [], low
        while at < high or not chunks:
            nxt = min(at + timedelta(hours=self.hours), high)
            chunks.append((len(chunks), at.isoformat(), nxt.isoformat()))
            at = nxt
        # Parts of a halved chunk are numbered above all chunks.
        self.options["chunks"] = json.dumps(chunks)
        return [CountedChunk(*c, len(chunks)) for c in chunks]

    def read(self, partition: CountedChunk):
        reader = PageReader({**self.options, "chunks": json.dumps([None] * partition.of)})
        return reader.read(partition)


class CountedChunk(ChunkPartition):
    """A chunk that knows how many there are: tasks see no list."""

    def __init__(self, chunk_no: int, start: str, end: str, of: int):
        super().__init__(chunk_no, start, end)
        self.of = of


def polled_documents(
    spark: SparkSession,
    provider: PageProvider,
    watermark: datetime | None = None,
    now: datetime | None = None,
    hours: int = CHUNK_HOURS,
    overlap_hours: int = OVERLAP_HOURS,
    initial_hours: int = INITIAL_HOURS,
    page_size: int = PAGE_SIZE,
    max_records: int = MAX_RECORDS_PER_QUERY,
) -> DataFrame:
    """Page documents of the polls as a stream: ``chunk_no, offset, document``.

    ``watermark`` is the newest stored observation when the query starts, ``now`` the
    clock of its one poll (None: the query goes on polling).
    """
    spark.dataSource.register(PollSource)
    options = {
        "provider": base64.b64encode(cloudpickle.dumps(provider)).decode(),
        "chunkHours": hours, "overlapHours": overlap_hours, "initialHours": initial_hours,
        "pageSize": page_size, "maxRecords": max_records,
        "watermark": as_utc(watermark).isoformat() if watermark else None,
        "now": as_utc(now).isoformat() if now else None,
    }
    given = {k: str(v) for k, v in options.items() if v is not None}
    return spark.readStream.format(PollSource.name()).options(**given).load()
