"""Helpers shared by the operators: stored intermediates, prefix sums, components."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obs_engine.session import work_path

__all__ = ["table", "fresh", "stored", "release", "worker_cache", "trimmed", "offsets", "dealt_join", "components"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as ``df`` needs to have none like it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored` that nothing reads any more."""
    jvm = df.sparkSession._jvm
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, across its tasks."""
    return vars(sys).setdefault("_text_caches", {}).setdefault(name, {})


def trimmed(run):
    """A ``mapInArrow`` function whose worker gives free memory back to the system when it is through.

    Workers stay for later tasks of other stages, which may run no Python at all.
    """

    def inner(batches):
        import ctypes

        import pyarrow as pa

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)

    return inner


def offsets(counts: DataFrame, by: list[str], order: str, n: str, width: int = 1024) -> DataFrame:
    """Exclusive running sum of ``n`` in the order of the integer ``order`` within ``by``.

    Sums run inside stretches of ``width`` values and over the stretches' totals, so
    the widest window holds 1/``width`` of the counts of one ``by`` group.
    """
    c = counts.withColumn("_stretch", F.floor(F.col(order) / width))
    inner = Window.partitionBy(*by, "_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("_within", F.coalesce(F.sum(n).over(inner), F.lit(0)))
    outer = Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    t = (
        c.groupBy(*by, "_stretch").agg(F.sum(n).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(outer), F.lit(0)))
        .drop("_n")
    )
    return (
        c.join(t, [*by, "_stretch"])
        .withColumn("offset_before", (F.col("_within") + F.col("_before")).cast("long"))
        .drop("_stretch", "_within", "_before")
    )


def dealt_join(rows: DataFrame, by_key: DataFrame, keys: list[str], count: str, mix: list[str]) -> DataFrame:
    """Inner join with ``by_key``, one row a key, whose column ``count`` bounds the rows a key has.

    A key with more than a thousandth of all rows is dealt by the columns ``mix`` into
    parts, and its row of ``by_key`` goes to each. There are fewer than 1,000 such keys
    whatever the tables hold, so their list is broadcast.
    """
    total = by_key.agg(F.sum(count)).first()[0] or 0
    bar = max(1000, total // 1000)
    parts = F.ceil(F.col(count) / bar).cast("int")
    hot = by_key.where(F.col(count) > bar).select(*keys, parts.alias("_parts"))
    part = F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*mix), F.col("_parts"))).cast("int")
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("_part", part).drop("_parts")
    all_parts = F.sequence(F.lit(0), F.when(F.col(count) > bar, parts - 1).otherwise(0))
    return dealt.join(by_key.withColumn("_part", F.explode(all_parts)), [*keys, "_part"]).drop("_part")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest node reachable over undirected ``(a, b)`` edges.

    Alternating large-star and small-star contraction: each round relinks every edge
    to the smallest neighbour of one of its ends, and every node ends up as a leaf of
    its component's smallest. Rounds are stored tables; nothing is collected but two
    numbers that tell whether a round changed the edges.
    """
    spark = edges.sparkSession
    e = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = None
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen or mark[0] == 0:
            break
        seen = tuple(mark)
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: larger neighbours of a node go to the smallest in its neighbourhood.
        large = (
            both.where("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        # Small star: a node and its smaller neighbours go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(low).distinct()
        nxt = stored(small, "edges")
        release(e)
        e = nxt
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
