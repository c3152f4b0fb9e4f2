"""All checks of many tables in one pass over each (Q1-Q15).

A check is compiled to *contributions*: what a row of some table says about a key of the
check. Row checks contribute one to no key, and only for rows that fail; a uniqueness check
its key; a relationship the child's key on the left and the parent's on the right; a
comparison of facts with their aggregates one key per entity and day, with counts on both
sides. Every table is read once, its rows unpivoted into their contributions; contributions
of one check and key are added up, partially before the shuffle, and then one row per check
is left. So 194 checks over 17 tables are 17 scans and two aggregations, whatever the
number of checks on a table.

The row checks of a table are one contribution, the set of checks that a row fails as bits:
a row without faults has none, and the sets that occur are few. The sides of a key are
subtracted, so a key needs its rows on either side and one difference per measure.

A null key says nothing. A key that two stored aggregate rows share counts once, with their
sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obs_engine.operators.quality import TableChecks

#: Counts that a key can have on one side.
MEASURES = 3

#: A contribution: what it is about, its key, rows on either side, left less right measures.
ENTRY = ("entry", "key", "l", "r", *[f"d{i}" for i in range(1, MEASURES + 1)])

#: Row checks whose outcomes share a contribution: the bits of a positive long.
BITS = 62

# How failures follow from the keys of a check.
ROWS, UNIQUE, PARENT, COUNT, PRESENT, EQUAL = "rows", "unique", "parent", "count", "present", "equal"


@dataclass(frozen=True)
class KeySide:
    """What a table's rows say on one side of a keyed check."""

    check: str
    key: tuple[Column, ...]
    right: bool = False
    #: Up to ``MEASURES`` numbers that are added up per key; a row counts one by itself.
    measures: tuple[Column, ...] = ()
    where: Column | None = None


@dataclass
class CheckPlan:
    """Checks by name, with what each table contributes to them."""

    kinds: dict[str, str] = field(default_factory=dict)
    severities: dict[str, str] = field(default_factory=dict)
    rows: dict[str, dict[str, Column]] = field(default_factory=dict)
    sides: dict[str, list[KeySide]] = field(default_factory=dict)

    def _new(self, check: str, kind: str, severity: str) -> None:
        if check in self.kinds:
            raise ValueError(f"{check} is declared twice")
        self.kinds[check], self.severities[check] = kind, severity

    def row_check(self, check: str, table: str, failing: Column, severity: str = "error") -> None:
        """Rows where ``failing`` is true fail."""
        self._new(check, ROWS, severity)
        self.rows.setdefault(table, {})[check] = failing

    def key_check(self, check: str, kind: str, sides: Sequence[tuple[str, KeySide]], severity: str = "error") -> None:
        """Failures follow from the keys of the sides, as ``kind`` says."""
        self._new(check, kind, severity)
        for table, side in sides:
            self.sides.setdefault(table, []).append(side)

    def declare(self, table: str, checks: TableChecks) -> None:
        """The column checks of a table."""
        for c in checks.not_null:
            self.row_check(f"not_null_{table}_{c}", table, F.col(c).isNull())
        for c, values in checks.accepted.items():
            self.row_check(f"accepted_values_{table}_{c}", table, ~F.col(c).isin(*values))
        for c in checks.unique:
            name = f"unique_{table}_{c}"
            self.key_check(name, UNIQUE, [(table, KeySide(name, (F.col(c),)))])
        for c, parent in checks.parents.items():
            name = f"relationships_{table}_{c}"
            sides = [(table, KeySide(name, (F.col(c),))), (parent, KeySide(name, (F.col(c),), right=True))]
            self.key_check(name, PARENT, sides)

    # the compiled plan

    def _blocks(self) -> list[tuple[str, list[str]]]:
        """Row checks by table, in blocks of at most ``BITS``."""
        return [
            (table, names[i : i + BITS])
            for table, names in ((t, list(checks)) for t, checks in self.rows.items())
            for i in range(0, len(names), BITS)
        ]

    def contributions(self, table: str, df: DataFrame) -> DataFrame:
        """``entry, key, l, r, d1..`` of one table, from one scan of it.

        ``entry`` is the number of a check, or a negative one for a block of row checks, whose
        key is the set of those that fail.
        """
        numbers = {c: i for i, c in enumerate(self.kinds)}
        zero = F.lit(0).cast("long")
        entries: list[tuple[int, Column, bool, Sequence[Column]]] = []
        for block, (owner, names) in enumerate(self._blocks()):
            if owner == table:
                bits = [F.when(self.rows[table][n], F.lit(1 << i)).otherwise(0) for i, n in enumerate(names)]
                failing = reduce(lambda a, b: a.bitwiseOR(b), [b.cast("long") for b in bits])
                entries.append((-1 - block, F.when(failing != 0, failing.cast("string")), False, ()))
        for s in self.sides.get(table, ()):
            known = reduce(lambda a, b: a & b, [k.isNotNull() for k in s.key])
            ok = known if s.where is None else known & s.where
            texts = [k.cast("string") for k in s.key]
            text = texts[0] if len(texts) == 1 else F.concat_ws("\x1f", *texts)
            entries.append((numbers[s.check], F.when(ok, text), s.right, s.measures))
        named: list[Column] = []
        for i, (number, key, right, measures) in enumerate(entries):
            counts = [F.coalesce(m.cast("long"), zero) for m in measures]
            counts += [zero] * (MEASURES - len(counts))
            one = F.lit(1).cast("long")
            values = [F.lit(number), key, *((zero, one) if right else (one, zero)), *[-m if right else m for m in counts]]
            named += [v.alias(f"{c}_{i}") for c, v in zip(ENTRY, values)]
        rows = ", ".join("(" + ", ".join(f"{c}_{i}" for c in ENTRY) + ")" for i in range(len(entries)))
        wide, names = df.select(*named), ", ".join(ENTRY)
        long = f"SELECT {names} FROM {{wide}} UNPIVOT INCLUDE NULLS (({names}) FOR side IN ({rows})) WHERE key IS NOT NULL"
        return df.sparkSession.sql(long, wide=wide)

    def results(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """``check, severity, failures, status`` of every check whose tables are given."""
        spark = next(iter(tables.values())).sparkSession
        used = [t for t in tables if self.rows.get(t) or self.sides.get(t)]
        wanted = {t for t in (*self.rows, *self.sides)}
        if missing := sorted(wanted - set(tables)):
            raise KeyError(f"tables of declared checks are missing: {', '.join(missing)}")
        parts = [self.contributions(t, tables[t]) for t in used]
        col = F.col
        per_key = reduce(DataFrame.union, parts).groupBy("entry", "key").agg(*[F.sum(c).alias(c) for c in ENTRY[2:]])
        differ = reduce(lambda a, b: a | b, [col(c) != 0 for c in ENTRY[4:]])
        figures = {
            ROWS: F.sum("l"),
            UNIQUE: F.count_if(col("l") > 1),
            PARENT: F.sum(F.when(col("r") == 0, col("l")).otherwise(0)),
            # Keys on the left against rows on the right.
            COUNT: (F.count_if(col("l") > 0) != F.sum("r")).cast("long"),
            PRESENT: F.count_if((col("l") > 0) & ((col("r") == 0) | differ)),
            EQUAL: F.count_if((col("l") == 0) | (col("r") == 0) | differ),
        }
        # One row per keyed check, and per block and set of failing row checks.
        failing = F.when(col("entry") < 0, col("key")).cast("long").alias("failing")
        found = per_key.groupBy("entry", failing).agg(*[f.alias(k) for k, f in figures.items()])
        bits = {n: (-1 - b, 1 << i) for b, (_, names) in enumerate(self._blocks()) for i, n in enumerate(names)}
        listed = spark.createDataFrame(
            [(n, k, self.severities[n], *bits.get(n, (i, None))) for i, (n, k) in enumerate(self.kinds.items())],
            "name STRING, kind STRING, severity STRING, source INT, bit LONG",
        )
        hit = col("bit").isNull() | (col("bit").bitwiseAND(col("failing")) != 0)
        joined = listed.join(found, (col("source") == col("entry")) & hit, "left")
        failures = F.coalesce(F.sum(F.coalesce(*[F.when(col("kind") == k, col(k)) for k in figures])), F.lit(0))
        totals = joined.groupBy("name", "severity").agg(failures.cast("long").alias("failures"))
        status = F.when(col("failures") == 0, "pass").when(col("severity") == "warn", "warn").otherwise("fail")
        return totals.select(col("name").alias("check"), "severity", "failures", status.alias("status"))
