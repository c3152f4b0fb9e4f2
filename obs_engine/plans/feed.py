"""A paginated feed whose records change between polls, derived from the benchmark events.

It stands for the remote API: pages come out of stored records, as they look at a given
poll. Every tenth event is corrected from the second poll on, another tenth from the third
on, and another is published one poll late.
"""

from __future__ import annotations

import sys
from datetime import datetime, timedelta, timezone

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.plans.stand_ins import Inputs

NEVER = 1 << 30
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# The feed is asked by Python workers, which need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def feed_records(x: Inputs) -> DataFrame:
    """``(t, event_id, since, until, record)``: each version of each record, and the polls that see it.

    ``t`` is in microseconds: whole numbers are stored alike, with their ranges, under every
    setting of the session, timestamps by default without zone and range.
    """
    n = F.col("event_id")
    turns = F.when(n % 10 == 0, 1).when(n % 10 == 5, 2).otherwise(NEVER)
    old = F.struct(F.when(n % 10 == 3, 1).otherwise(0).alias("since"), turns.alias("until"), F.lit(0).alias("more"))
    new = F.struct(turns.alias("since"), F.lit(NEVER).alias("until"), F.lit(1).alias("more"))
    versions = x.table("events").withColumn("v", F.explode(F.array(old, new))).where(F.col("v.since") < F.col("v.until"))
    record = x.arc_record(F.round(F.col("value") + F.col("v.more"), 2))
    return versions.select(
        F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "event_id", "v.since", "v.until", F.to_json(record).alias("record")
    )


class StoredFeed:
    """Page provider over written :func:`feed_records`, as poll number ``poll`` sees them."""

    def __init__(self, path: str, poll: int):
        self.path, self.poll = path, poll

    def __call__(self, low: datetime, high: datetime, offset: int, size: int) -> dict:
        import json

        records = self.window(low, high)
        page = records.slice(offset, size).to_pylist()
        return {"total_count": len(records), "results": [json.loads(r) for r in page]}

    def window(self, low: datetime, high: datetime):
        """Records of one chunk in time order; pages of a chunk are asked for one after the other."""
        import pyarrow.dataset as ds

        asked = (low, high)
        if getattr(self, "_asked", None) != asked:
            c = ds.field
            low_t, high_t = ((at - EPOCH) // timedelta(microseconds=1) for at in asked)
            seen = (c("since") <= self.poll) & (c("until") > self.poll) & (c("t") >= low_t) & (c("t") <= high_t)
            table = ds.dataset(self.path, format="parquet").to_table(columns=["t", "event_id", "record"], filter=seen)
            table = table.sort_by([("t", "ascending"), ("event_id", "ascending")])
            self._asked, self._records = asked, table.column("record")
        return self._records
