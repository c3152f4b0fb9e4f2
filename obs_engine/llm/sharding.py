"""Shards that each hold the same mixture of sources, by proportional interleaving.

The rows of each source are put in a seeded random order; row r of n gets the fraction
(r - u) / n, where u between 0 and 1 is the source's own seeded shift, without which the
rows of small sources would all stand at the same few places. Sorting all rows by
fraction interleaves the sources in proportion, and cutting that order into equal stretches gives shards whose row counts differ by one at
most and whose share of every source is that of the whole.

Neither order is ever held in one place. Rows are hashed into parts of about ``PART``
rows; a row's rank is the count of its source's rows in earlier parts (a running sum
over counts) plus its rank within its part. A source with a third of all rows is spread
over as many parts as it needs. Everything is DataFrame operations.

Edge cases: a null source is a source of its own. Ties and repeated rows stand side by
side in the order. Columns called ``shard`` or ``slot`` are replaced. Long texts
are only hashed. An empty table gives no rows. Copies of one text are dealt like any other
rows: with counts at most one apart, a group larger than a shard could not stay together,
and spread evenly no shard holds more copies than its share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.llm.common import offsets, stored

PART = 20_000


def interleave(rows: DataFrame, n_shards: int, seed: int = 0, source: str = "source") -> DataFrame:
    """``rows`` with ``shard`` (from 0) and ``slot`` (its place in the shard, gapless from 0)."""
    names = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    carried = [f"c{i}" for i in range(len(names))]  # no clash with the columns made here
    keyed = rows.select(
        *(F.col(c).alias(x) for c, x in zip(names, carried)), F.xxhash64(F.lit(seed), *names).alias("_h"),
        F.col(source).isNull().alias("_nil"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
    )
    keyed = stored(keyed, "shuffled")
    total = keyed.count()
    parts = max(1, -(-total // PART))
    keyed = keyed.withColumn("_part", F.pmod("_h", F.lit(parts)))
    shift = (F.pmod(F.xxhash64(F.lit(seed), F.lit("shift"), "_nil", "_source"), F.lit(1 << 20)) + 1) / float(1 << 20)
    # Rank within the source, in the order of (part, hash).
    by = ["_nil", "_source"]
    counts = keyed.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    sizes = counts.groupBy(*by).agg(F.sum("_n").alias("_size"))
    before = offsets(counts, by, "_part", "_n").join(sizes, by).drop("_n")
    within = Window.partitionBy(*by, "_part").orderBy("_h")
    ranked = (
        keyed.withColumn("_row", F.row_number().over(within))
        .join(before, [*by, "_part"])
        .withColumn("_fraction", (F.col("offset_before") + F.col("_row") - shift) / F.col("_size"))
        .drop("_part", "_row", "offset_before", "_size")
    )
    # Rank among all rows, in the order of the fraction; fractions are spread evenly.
    ranked = stored(ranked.withColumn("_part", F.floor(F.col("_fraction") * parts)), "ranked")
    before = offsets(ranked.groupBy("_part").agg(F.count("*").alias("_n")), [], "_part", "_n").drop("_n")
    within = Window.partitionBy("_part").orderBy("_fraction", *by, "_h")
    place = F.col("offset_before") + F.row_number().over(within) - 1
    last = max(total, 1)
    return (
        ranked.join(before, "_part")
        .withColumn("_place", place)
        .withColumn("shard", F.expr(f"_place * {n_shards} div {last}").cast("int"))
        .withColumn("slot", F.expr(f"_place - (shard * {last}L + {n_shards - 1}) div {n_shards}").cast("long"))
        .select(*(F.col(x).alias(c) for c, x in zip(names, carried)), "shard", "slot")
    )
