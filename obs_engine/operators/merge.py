"""Keyed merges into partitioned Parquet.

Pure functions (``classify``, ``upserted`` ...) give the merged rows as a
DataFrame; ``Warehouse`` applies them to stored tables.

How a stored merge works, and why it scales:

* the partition value is a function of the merge key, so only the partitions
  of the batch are read: their range prunes statically, a semi-join dynamically;
* a batch with two rows of one key is refused before any join, so joins have
  unique keys on both sides and no hot key;
* partitions that only gain rows are appended to; only partitions holding a
  changed row are rewritten, by dynamic partition overwrite;
* batch and classification are written tables in the shared folder, so losing
  an executor never re-reads a partition that is being replaced, and counts are
  taken from what was actually classified.

Every merge is idempotent: replaying a batch changes nothing, so a job that dies
between two writes is simply run again.

Beside each version lies a small log of the newest load times: per touched
partition, written before the rows are, and per table, written after them. A run
reads from it how far its target got and which partitions of its source hold
newer loads, so it scans neither table for that; a job that died in between makes
the next run look at more, never at less.

A table is a folder with a pointer file, which names the folder of the current
version and its schema. A rebuild, and a batch that drops or retypes a column,
writes a new version and switches the pointer last, so a job that dies before
leaves the old table as it was.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obs_engine.functions.keys import day_of
from obs_engine.session import pin_utc, shuffles_dropped, work_path

INSERTED, UPDATED, UNCHANGED = "inserted", "updated", "unchanged"
ACTION = "_action"

# Staged rows that are laid out, or classified, by one job: more are taken in ranges of whole
# partitions, so that the disks hold the shuffle of one range at a time. Each range reads the
# staged rows once more. A classification shuffles its batch and the stored rows beside it.
LAID_OUT_ROWS = 1 << 26
CLASSIFIED_ROWS = 1 << 25

# Rows of one row group in tables with lookup columns.
ROW_GROUP_ROWS = 20_000

# Keys are md5 text, which a codec without entropy coding leaves at its full length.
COMPRESSION = {"compression": "zstd"}

# Folder name of the NULL partition.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# Partition columns that are not part of the model start with this.
TECHNICAL = "p_"

# Columns whose newest values are logged.
LOAD_COLUMNS = ("ingested_at", "loaded_at", "last_loaded_at", "last_seen_at", "observed_at")
TOUCHED, STORED = "touched", "stored"

# Increments start here when the target is empty.
EPOCH = datetime(1900, 1, 1, tzinfo=timezone.utc)


@dataclass(frozen=True)
class MergeResult:
    received: int
    inserted: int
    updated: int
    unchanged: int


# -- pure forms ---------------------------------------------------------------


def insert_ignore(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Batch rows whose key the target lacks; the stored row wins."""
    return batch.join(target.select(*key), list(key), "left_anti")


def classify(
    target: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    compare: Sequence[str] | None = None,
    checked: bool = False,
) -> DataFrame:
    """Batch (unique on ``key``) plus ``_action``.

    With ``compare`` a known key is *updated* only when one of those columns is
    distinct from the stored value. Without it every known key is *updated*
    (delete + insert, S11). The first join keeps target rows that the batch
    names, so a small batch is broadcast after a size check and a large target
    is not shuffled. For a batch that was ``checked`` to hold no key twice it takes the
    batch's keys alone, and the columns are compared in the second join.
    """
    names = list(compare or ())
    if checked:
        old = F.struct(F.lit(True).alias("_known"), *names).alias("_old")
        hits = target.select(*key, old).join(batch.select(*key), list(key), "left_semi")
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_old.{c}")) for c in names], F.lit(bool(names)))
        action = F.when(F.col("_old").isNull(), INSERTED).when(same, UNCHANGED).otherwise(UPDATED)
        return batch.join(hits, list(key), "left").withColumn(ACTION, action).drop("_old")
    wanted = batch.select(*key, *[F.col(c).alias(f"_new_{c}") for c in names])
    stored = target.select(*key, *[F.col(c).alias(f"_old_{c}") for c in names])
    if names:
        old = F.struct(*[F.col(f"_old_{c}").alias(c) for c in names])
        new = F.struct(*[F.col(f"_new_{c}").alias(c) for c in names])
        changed = ~old.eqNullSafe(new)
    else:
        changed = F.lit(True)
    hits = stored.join(wanted, list(key), "inner").select(*key, changed.alias("_changed"))
    action = (
        F.when(F.col("_changed").isNull(), INSERTED)
        .when(F.col("_changed"), UPDATED)
        .otherwise(UNCHANGED)
    )
    return batch.join(hits, list(key), "left").withColumn(ACTION, action).drop("_changed")


def action_figures() -> dict[str, Column]:
    actions = {a: F.count_if(F.col(ACTION) == a) for a in (INSERTED, UPDATED, UNCHANGED)}
    return {"received": F.count(F.lit(1)), **actions}


def action_counts(classified: DataFrame) -> DataFrame:
    """One row ``received, inserted, updated, unchanged``."""
    return classified.agg(*[c.alias(n) for n, c in action_figures().items()])


def upserted(
    target: DataFrame, batch: DataFrame, key: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """Target after the upsert; unchanged rows keep their stored load columns.

    One full outer join of two tables unique on ``key``: each side is read and
    shuffled once. ``Warehouse.upsert`` is the form for a small batch and a
    large stored target.
    """
    columns = batch.columns
    old = conform(target, batch.schema).select(*key, F.struct(*columns).alias("_old"))
    new = batch.select(*key, F.struct(*columns).alias("_new"))

    def compared(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in compare])

    keep_old = F.col("_new").isNull() | (
        F.col("_old").isNotNull() & compared("_old").eqNullSafe(compared("_new"))
    )
    row = F.when(keep_old, F.col("_old")).otherwise(F.col("_new")).alias("_row")
    return old.join(new, list(key), "full_outer").select(row).select("_row.*")


def delete_inserted(target: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target without the keys of ``new``, plus ``new`` (S11); columns follow ``new``."""
    kept = target.join(new.select(*key), list(key), "left_anti")
    return new.unionByName(conform(kept, new.schema))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Add columns the schema gained (NULL), drop those it lost, cast those it retyped.

    A stored value that the new type cannot hold fails the job.
    """
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(f) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).cast(f.dataType)

    return df.select(*[column(f).alias(f.name) for f in schema.fields])


class DuplicateKey(ValueError):
    """A batch holds more than one row of a key."""


def require_unique(batch: DataFrame, key: Sequence[str]) -> None:
    """Raise if a key without NULL occurs twice."""
    with shuffles_dropped(batch.sparkSession):
        twice = batch.dropna(subset=list(key)).groupBy(*key).count().filter("count > 1").first()
    if twice:
        names = ", ".join(f"{c}={twice[c]}" for c in key)
        raise DuplicateKey(f"{twice['count']} rows of the batch have the key {names}")


def newer_than(df: DataFrame, loaded: str, high: datetime | None) -> DataFrame:
    """Rows loaded strictly after the target's newest load.

    ``high`` is a collected literal, so the predicate reaches the Parquet scan.
    """
    return df.filter(F.col(loaded) > F.lit(high or EPOCH).cast(df.schema[loaded].dataType))


def guard_full_refresh(name: str, full_refresh: bool, allow: bool) -> None:
    """A protected history is only rebuilt after explicit approval."""
    if full_refresh and not allow:
        raise PermissionError(
            f"full rebuild of {name} is blocked: verify a snapshot, then pass "
            "allow_destructive_full_refresh=True"
        )


# -- stored tables ------------------------------------------------------------


@dataclass(frozen=True)
class Partitioning:
    """How the partition value follows from a key column: by day, month or hash bucket.

    A day is the right grain for a feed of many millions of rows a day; a month
    keeps files reasonable for a small one. Buckets serve small keyed tables.
    """

    column: str
    source: str
    grain: str
    buckets: int = 0

    def value(self) -> Column:
        if self.grain == "bucket":
            return F.pmod(F.xxhash64(self.source), F.lit(self.buckets)).cast("int")
        day = day_of(self.source)
        return day if self.grain == "day" else F.trunc(day, "month").cast("date")

    def on_days(self, days: Sequence[date]) -> Column:
        """Partition predicate for some days of the source column."""
        firsts = {d if self.grain == "day" else d.replace(day=1) for d in days}
        return F.col(self.column).isin(sorted(firsts))

    def of_day(self, day: str) -> Column:
        """Partition value of a day of the source column."""
        return F.col(day) if self.grain == "day" else F.trunc(day, "month").cast("date")


def by_day(source: str, column: str = "p_day") -> Partitioning:
    return Partitioning(column, source, "day")


def by_month(source: str) -> Partitioning:
    return Partitioning("p_month", source, "month")


def by_bucket(source: str, buckets: int = 8) -> Partitioning:
    return Partitioning("p_bucket", source, "bucket", buckets)


@dataclass(frozen=True)
class TableSpec:
    """A stored table. Rows of one key always fall into one partition."""

    name: str
    key: tuple[str, ...]
    layout: Partitioning
    sort: tuple[str, ...] = ()
    protected: bool = False
    #: Columns looked up by value: sorted first, with Bloom filters and narrow row groups.
    lookup: tuple[str, ...] = ()

    @property
    def partition(self) -> str:
        return self.layout.column

    def monthly(self) -> TableSpec:
        """The same table with month partitions."""
        return replace(self, layout=by_month(self.layout.source))


class Warehouse:
    """Parquet tables under one root, each a folder of versions with a pointer file."""

    _POINTER = "_current.json"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = pin_utc(spark)
        self.root = root.rstrip("/")

    # paths

    def home(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.name}"

    def path(self, spec: TableSpec) -> str:
        """Folder of the current version."""
        return f"{self.home(spec)}/{self._pointer(spec)['version']}"

    def _pointer(self, spec: TableSpec) -> dict:
        return self.read_json(f"{self.home(spec)}/{self._POINTER}")

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def exists(self, spec: TableSpec) -> bool:
        """Whether the table was ever completed; a first load that died left only garbage."""
        return self.path_exists(f"{self.home(spec)}/{self._POINTER}")

    def delete_path(self, path: str) -> None:
        fs, jpath = self._fs(path)
        if not fs.delete(jpath, True) and fs.exists(jpath):
            raise OSError(f"{path} was not deleted")

    def path_exists(self, path: str) -> bool:
        fs, jpath = self._fs(path)
        return fs.exists(jpath)

    def rename_path(self, old: str, new: str) -> None:
        fs, jpath = self._fs(old)
        if not fs.rename(jpath, self._fs(new)[1]):
            raise OSError(f"{old} was not renamed to {new}")

    def read_json(self, path: str) -> dict:
        """A small metadata file; Spark's readers skip names with an underscore."""
        fs, jpath = self._fs(path)
        stream = fs.open(jpath)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def write_json(self, path: str, value: dict) -> None:
        """Written aside and renamed over the old file, which stays whole until then."""
        folder, _, name = path.rpartition("/")
        aside = f"{folder}/_{uuid.uuid4().hex}{name}"
        fs, jpath = self._fs(aside)
        stream = fs.create(jpath, True)
        stream.write(bytearray(json.dumps(value, sort_keys=True), "utf-8"))
        stream.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs(path)[1].toUri(), self.spark._jsc.hadoopConfiguration()
        )
        rename = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark._sc._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(fs.makeQualified(jpath), fs.makeQualified(self._fs(path)[1]), options)

    # reading

    def schema(self, spec: TableSpec) -> StructType:
        return StructType.fromJson(self._pointer(spec)["schema"])

    def _switch(self, spec: TableSpec, version: str, schema: StructType) -> None:
        nullable = json.loads(schema.json())
        for field in nullable["fields"]:
            field["nullable"] = True
        self.write_json(f"{self.home(spec)}/{self._POINTER}", {"version": version, "schema": nullable})

    def _replace(self, spec: TableSpec, full: DataFrame, n: int = 0) -> None:
        """Write a new version, switch to it, and drop the old one; ``n`` tells the rows when they are staged."""
        old = self.path(spec) if self.exists(spec) else None
        version = f"v-{uuid.uuid4().hex}"
        path = f"{self.home(spec)}/{version}"
        for k, some in enumerate(self._ranges(spec, full, n, LAID_OUT_ROWS)):
            self._write(spec, full.filter(some), "append" if k else "error", dynamic=False, path=path)
        written = self.spark.read.schema(full.schema).parquet(path)
        self._log(spec, written, (TOUCHED, STORED), version)
        self._switch(spec, version, full.schema)
        if old:
            self.delete_path(old)
            self.delete_path(f"{old}-loads")

    def read(self, spec: TableSpec, with_partition: bool = False) -> DataFrame:
        """The table with its declared schema.

        Files written before a column was added read it as NULL, so a new column
        rewrites nothing; a dropped one is rewritten away (S12).
        """
        schema = self.schema(spec)
        # A partition column is read last; the declared order is kept instead.
        df = self.spark.read.schema(schema).parquet(self.path(spec)).select(*schema.fieldNames())
        technical = spec.partition.startswith(TECHNICAL)
        return df.drop(spec.partition) if technical and not with_partition else df

    def counted(self, spec: TableSpec, within: Column | None = None) -> DataFrame:
        """One row ``n``, the rows of some partitions, from file footers: no column is read.

        Only Spark's newer Parquet source takes a count down to the footers, so the table
        is read through that one here. ``within`` may use the partition column alone.
        """
        conf, listed = self.spark.conf, "spark.sql.sources.useV1SourceList"
        conf.set("spark.sql.parquet.aggregatePushdown", "true")  # of no effect on other reads
        before = conf.get(listed)
        conf.set(listed, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
        try:
            table = self.spark.read.schema(self.schema(spec)).parquet(self.path(spec))
        finally:
            conf.set(listed, before)
        some = table if within is None else table.filter(within)
        return some.agg(F.count(F.lit(1)).alias("n"))

    def _log(self, spec: TableSpec, rows: DataFrame, kinds: Sequence[str], version: str | None = None) -> None:
        """Append the newest load times of ``rows`` to the table's log; they are read once for all kinds."""
        names = [c for c in LOAD_COLUMNS if c in rows.columns]
        newest = [F.max(F.unix_micros(F.col(c).cast("timestamp"))).alias(c) for c in names]
        parts = rows.groupBy(F.col(spec.partition).alias("part")).agg(*newest, F.count(F.lit(1)).alias("n"))
        listed = parts.select(F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"), "*")
        part = F.when(F.col("kind") == TOUCHED, F.col("part")).alias("part")
        table = listed.groupBy("kind", part).agg(*[F.max(c).alias(c) for c in names], F.sum("n").alias("n"))
        each = F.explode(F.map_from_arrays(
            F.array(*[F.lit(c) for c in names]).cast("array<string>"),
            F.array(*[F.col(c) for c in names]).cast("array<bigint>"),
        )).alias("column", "micros")
        version = version or self._pointer(spec)["version"]
        log = table.select("kind", "part", each).filter("micros is not null").coalesce(1)
        with shuffles_dropped(self.spark):
            log.write.mode("append").parquet(f"{self.home(spec)}/{version}-loads")

    def _loads(self, spec: TableSpec, kind: str, loaded: str) -> DataFrame:
        part = self.read(spec, with_partition=True).schema[spec.partition].dataType.simpleString()
        log = self.spark.read.schema(f"kind string, part {part}, column string, micros bigint")
        return log.parquet(f"{self.path(spec)}-loads").filter((F.col("kind") == kind) & (F.col("column") == loaded))

    def high_mark(self, spec: TableSpec, loaded: str) -> datetime | None:
        """Newest load time that was stored, from the log: also of rows deleted since."""
        if not self.exists(spec):
            return None
        micros = self._loads(spec, STORED, loaded).agg(F.max("micros")).first()[0]
        return None if micros is None else datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)

    def newer(self, spec: TableSpec, loaded: str, high: datetime | None) -> DataFrame:
        """Rows loaded after ``high``, read from the partitions that hold such loads."""
        table = self.read(spec, with_partition=True)
        if high is None:
            return table
        late = F.col("micros") > F.unix_micros(F.lit(high).cast("timestamp"))
        touched = self._loads(spec, TOUCHED, loaded).filter(late).select(F.col("part").alias(spec.partition))
        return newer_than(self.near(spec, touched), loaded, high)

    # writing

    def stage(
        self, df: DataFrame, label: str, keep: Column | None = None, more: Sequence[DataFrame] = (), **figures: Column
    ) -> DataFrame:
        """Write ``df`` to the shared folder and read it back: lineage is cut there.

        ``figures`` are aggregates observed while the rows are written, so that no job of
        their own counts them; they are kept with the staged table. They see all rows, of
        which only those with ``keep`` are written. ``more`` rows are written after them, one
        job after the other; figures are then counts, and are summed.
        """
        path, found = work_path(self.spark, label), []
        for k, part in enumerate([df, *more]):
            seen = Observation() if figures else None
            rows = part.observe(seen, *[c.alias(n) for n, c in figures.items()]) if seen else part
            rows = rows if keep is None else rows.filter(keep)
            with shuffles_dropped(self.spark):
                rows.write.mode("append" if k else "error").options(**COMPRESSION).parquet(path)
            found.append(seen.get if seen else {})
        staged = self.spark.read.schema(df.schema).parquet(path)
        staged._obs_path = path
        staged._obs_figures = {n: sum(f[n] for f in found) for n in figures} if more else found[0]
        return staged

    def release(self, *staged: DataFrame) -> None:
        for df in staged:
            self.delete_path(df._obs_path)

    def _with_partition(self, spec: TableSpec, df: DataFrame) -> DataFrame:
        if spec.partition in df.columns:
            return df
        return df.withColumn(spec.partition, spec.layout.value())

    def _write(
        self, spec: TableSpec, df: DataFrame, mode: str, dynamic: bool, path: str | None = None
    ) -> None:
        # Rebalancing groups a partition's rows into few files but splits a hot
        # partition over many tasks; sorting lets scans skip row groups.
        order = [*spec.lookup, *[c for c in spec.sort or spec.key if c not in spec.lookup]]
        laid_out = df.hint("rebalance", spec.partition).sortWithinPartitions(spec.partition, *order)
        with shuffles_dropped(self.spark):
            (
                laid_out.write.mode(mode)
                .options(**COMPRESSION, **self._lookup_options(spec))
                .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
                .partitionBy(spec.partition)
                .parquet(path or self.path(spec))
            )

    @staticmethod
    def _ranges(spec: TableSpec, staged: DataFrame, n: int, most: int) -> list[Column]:
        """Predicates that cut ``n`` rows into ranges of whole partitions of ``most`` rows or so; none is empty."""
        pieces = -(-n // most)
        if pieces < 2:
            return [F.lit(True)]
        part, days = F.col(spec.partition), spec.layout.grain != "bucket"
        number = F.unix_date(part) if days else part
        shares = F.array(*[F.lit(k / pieces) for k in range(1, pieces)])
        found = staged.agg(F.percentile_approx(number, shares).alias("cuts"), F.max(number).alias("last")).first()
        cuts = sorted({c for c in found["cuts"] or () if c < found["last"]})
        if not cuts:
            return [F.lit(True)]
        ends = [F.lit(date(1970, 1, 1) + timedelta(days=c) if days else c) for c in cuts]
        between = [(part > low) & (part <= high) for low, high in zip(ends, ends[1:])]
        return [part <= ends[0], *between, (part > ends[-1]) | part.isNull()]

    @staticmethod
    def _lookup_options(spec: TableSpec) -> dict[str, str]:
        if not spec.lookup:
            return {}
        blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in spec.lookup}
        return {"parquet.block.row.count.limit": str(ROW_GROUP_ROWS), **blooms}

    def rebuild(
        self, spec: TableSpec, df: DataFrame, allow_destructive_full_refresh: bool = False
    ) -> DataFrame:
        """Replace the whole table (S13); protected tables need approval."""
        guard_full_refresh(
            spec.name, spec.protected and self.exists(spec), allow_destructive_full_refresh
        )
        self._replace(spec, self._with_partition(spec, df))
        return self.read(spec)

    @staticmethod
    def extent(part: str) -> dict[str, Column]:
        """Figures of a partition column that :meth:`near` needs."""
        return {"low": F.min(part), "high": F.max(part), "n": F.count(F.lit(1)), "known": F.count(part)}

    def near(self, spec: TableSpec, values: DataFrame, extent: dict | None = None) -> DataFrame:
        """The table's partitions whose value is among ``values(<partition>)``.

        The range of the values prunes partitions when the scan is planned, the join
        those between when it runs; no list of values passes through the driver. A range
        that was observed when the values were staged is not computed again.
        """
        part = spec.partition
        table = self.read(spec, with_partition=True)
        if extent is None:
            extent = values.agg(*[c.alias(k) for k, c in self.extent(part).items()]).first().asDict()
        low, high, n, known = (extent[k] for k in ("low", "high", "n", "known"))
        if not n:
            return table.filter(F.lit(False))
        wanted = values.select(part).distinct().filter(F.col(part).between(F.lit(low), F.lit(high)))
        some = table.filter(F.col(part).between(F.lit(low), F.lit(high))).join(wanted, part, "left_semi")
        some = some.select(*table.columns)
        return some if n == known else some.unionByName(table.filter(F.col(part).isNull()))

    def _merge(
        self,
        spec: TableSpec,
        batch: DataFrame,
        compare: Sequence[str] | None,
        update: bool,
    ) -> MergeResult:
        part = spec.partition
        staged = self.stage(self._with_partition(spec, batch), f"{spec.name}-batch", **self.extent(part))
        extent = staged._obs_figures
        on = [*spec.key, *([] if part in spec.key else [part])]
        require_unique(staged, spec.key)
        if not self.exists(spec):
            n = extent["n"]
            self._replace(spec, staged, n)
            self.release(staged)
            return MergeResult(n, n, 0, 0)

        old = {f.name: f.dataType for f in self.schema(spec).fields}
        new = {f.name: f.dataType for f in staged.schema.fields}
        changed_shape = any(new.get(c) != t for c, t in old.items())
        aligned = conform(self.near(spec, staged, extent), staged.schema)
        hot = F.max((F.col(ACTION) == UPDATED) & F.lit(update)).alias("_rewritten")
        if compare is None:
            # Every row is loaded, and of a partition either all rows are new or it is
            # rewritten, so the partitions' figures tell all and no row is written again.
            figures = {n: c.alias(n) for n, c in action_figures().items()}
            tally = classify(aligned.select(*on), staged.select(*on), on, checked=True).groupBy(part)
            sums = {n: F.coalesce(F.sum(n), F.lit(0)) for n in figures}
            parts = self.stage(tally.agg(hot, *figures.values()), f"{spec.name}-partitions", **sums)
            loads, counts, written = staged, parts._obs_figures, [staged, parts]
            fresh = changed = staged
        else:
            # Counted while it is written: by the tasks whose rows are kept, replays included.
            # Unchanged rows are only counted.
            marked, *more = (
                classify(aligned.filter(some), staged.filter(some), on, compare, checked=True)
                for some in self._ranges(spec, staged, extent["n"], CLASSIFIED_ROWS)
            )
            marked = self.stage(
                marked, f"{spec.name}-classified", F.col(ACTION) != UNCHANGED, more, **action_figures()
            )
            counts = marked._obs_figures
            self.release(staged)  # what is loaded of it is in ``marked``
            parts = self.stage(marked.groupBy(part).agg(hot), f"{spec.name}-partitions")
            loads = marked if update else marked.filter(F.col(ACTION) == INSERTED)
            fresh, changed = marked.filter(F.col(ACTION) == INSERTED).drop(ACTION), marked.drop(ACTION)
            written = [marked, parts]
        result = MergeResult(counts["received"], *(counts[a] for a in (INSERTED, UPDATED, UNCHANGED)))

        def within(df: DataFrame, rewritten: bool) -> DataFrame:
            chosen = parts.filter(F.col("_rewritten") == rewritten).select(F.col(part).alias("_part"))
            return df.join(chosen, F.col(part).eqNullSafe(F.col("_part")), "left_semi")

        if changed_shape:
            # Dropped or retyped columns leave the files too, so the table is written anew.
            whole = conform(self.read(spec, with_partition=True), staged.schema)
            self._replace(spec, delete_inserted(whole, loads.drop(ACTION), on))
            self.release(*written)
            return result
        if list(old) != list(new):
            self._switch(spec, self._pointer(spec)["version"], staged.schema)
        self._log(spec, loads, (TOUCHED,))
        if counts[INSERTED]:
            added = within(fresh, rewritten=False)
            for some in self._ranges(spec, added, counts[INSERTED], LAID_OUT_ROWS):
                self._write(spec, added.filter(some), "append", dynamic=False)
        if update and counts[UPDATED]:
            stored = conform(self.near(spec, parts, extent), staged.schema)
            kept = within(stored, rewritten=True)
            new = within(changed, rewritten=True)
            self._write(spec, delete_inserted(kept, new, on), "overwrite", dynamic=True)
        self._log(spec, loads, (STORED,))
        self.release(*written)
        return result

    def insert_ignore(self, spec: TableSpec, batch: DataFrame) -> MergeResult:
        """Append rows with a new key; the rest counts as unchanged."""
        return self._merge(spec, batch, compare=list(spec.key), update=False)

    def upsert(self, spec: TableSpec, batch: DataFrame, compare: Sequence[str]) -> MergeResult:
        """Insert new keys, replace rows whose compared columns differ."""
        return self._merge(spec, batch, compare=compare, update=True)

    def delete_insert(self, spec: TableSpec, new: DataFrame) -> MergeResult:
        """Replace every key of ``new``."""
        return self._merge(spec, new, compare=None, update=True)

    def delete_where(self, spec: TableSpec, expired: Column, within: Column | None = None) -> int:
        """Delete rows; rewrites only partitions that hold some, drops emptied ones.

        ``within`` names the partitions that can hold such rows, when known.
        """
        part = spec.partition
        table = self.read(spec, with_partition=True)
        if within is not None:
            table = table.filter(within)
        tally = table.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.count_if(expired).alias("gone"))
        total = F.coalesce(F.sum("gone"), F.lit(0))
        tally = self.stage(tally.filter(F.col("gone") > 0), f"{spec.name}-expired", total=total)
        deleted = tally._obs_figures["total"]
        partly = tally.filter("gone < n").select(part)
        if not partly.isEmpty():
            keep = self.near(spec, partly).filter(~F.coalesce(expired, F.lit(False)))
            self._write(spec, keep, "overwrite", dynamic=True)
        # A dynamic overwrite never empties a partition, so its folder goes; the names
        # arrive one by one.
        for row in tally.filter("gone = n").select(F.col(part).cast("string")).toLocalIterator():
            folder = NULL_PARTITION if row[0] is None else row[0]
            self.delete_path(f"{self.path(spec)}/{part}={folder}")
        self.release(tally)
        return deleted

    @property
    def database(self) -> str:
        """Catalog database of this warehouse, so its tables never shadow or replace others."""
        return "obs_" + hashlib.md5(self.root.encode()).hexdigest()[:12]

    def register(self, spec: TableSpec) -> str:
        """Expose the table in the session catalog (external, with its partitions)."""
        name = f"{self.database}.{spec.name}"
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema(spec).fields)
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}/_catalog'"
        )
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
        self.spark.sql(
            f"CREATE TABLE {name} ({ddl}) USING parquet PARTITIONED BY ({spec.partition}) "
            f"LOCATION '{self.path(spec)}'"
        )
        self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return name

    def refresh_stats(self, specs: Sequence[TableSpec]) -> None:
        """Recompute optimizer statistics after large deletes."""
        for spec in specs:
            self.spark.sql(f"ANALYZE TABLE {self.register(spec)} COMPUTE STATISTICS")


def store_failures(failures: DataFrame, root: str, check: str) -> str:
    """Persist the failing rows of a check in its audit table."""
    path = f"{root.rstrip('/')}/audit/{check}"
    failures.write.mode("overwrite").parquet(path)
    return path
