"""Near duplicates by an LSH forest.

Every text becomes a set of word runs (shingles) and a signature of 64 minimum hashes.
The forest holds the signatures in several orders, each a rotation of the 64 values.
In each sorted order, texts whose longest common prefix is long enough lie side by
side: a *region*. Regions start at a prefix length at which a pair just at the
threshold shares one in some order with a chance of at least 1 - 1e-5. Members of a region are
compared on their full sets, and a region hands on only the links that join its groups:
fewer than members, whatever the number of similar pairs. Equal sets are one class from
the start, so copies cost nothing.

A region too large for one task is *crowded*. It is first joined cheaply, by longer
prefixes (adaptive depth) and by its smallest member. If that leaves it in several groups,
an exact join on prefix-filter shingles follows: two sets at the threshold share one of
the rarest shingles of each, as many as one set may lack of the other and one more. Only
shingles that occur in several groups are followed, and those with too many members for a
task are compared part against part. So every pair of every region is compared on its
full sets or is in one group already.

Edge cases: a null or blank text has no shingles and links with nothing. Rows with one
``doc_id`` count as one document. A row without ``doc_id`` belongs to no group
(``component_id`` null, ``kept`` true). Long texts are compared on all their shingles. Of a
group the smallest ``doc_id`` stays, so ties do not arise. Columns other than ``doc_id``
and ``text`` are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.llm.common import components, fresh, stored, trimmed
from obs_engine.llm.textvec import BASE, chunks, flat, mix, shingles, word_hashes

VALUES = 64
#: Bytes of texts sketched at once.
PART = 1 << 20
#: A region with more members or shingles than this is crowded.
REGION_DOCS, REGION_SHINGLES = 4096, 1 << 20
#: Parts of a hot shingle's rows in a join.
SALTS = 16
SKETCH = "doc_id long, n_shingles long, set_hi long, set_lo long, signature binary"


def first_depth(threshold: float, miss: float = 1.1e-5) -> int:
    """Longest prefix at which a pair at the threshold is missed in all orders with chance ``miss``."""
    fits = [d for d in range(1, 9) if (1 - threshold**d) ** (VALUES // d) <= miss]
    return max(fits, default=1)


def multipliers() -> np.ndarray:
    return mix(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)


def signature(s: np.ndarray, by: np.ndarray) -> np.ndarray:
    out = np.full(VALUES, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(s), 2048):
        out = np.minimum(out, ((s[i : i + 2048, None] * by) >> np.uint64(32)).min(0))
    return out.astype(np.uint32)


def sketcher(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = multipliers()
        for batch in batches:
            data, at = flat(batch.column(1))
            n, hi, lo, sig = [], [], [], []
            for a, b in chunks(at, PART):
                words, first = word_hashes(data[at[a] : at[b]], at[a : b + 1] - at[a])
                for i in range(b - a):
                    s = shingles(words[first[i] : first[i + 1]], size)
                    n.append(len(s))
                    if not len(s):
                        hi.append(None), lo.append(None), sig.append(None)
                        continue
                    hi.append(int(mix(s + np.uint64(7)).sum().view(np.int64)))
                    lo.append(int(np.bitwise_xor.reduce(mix(s * np.uint64(BASE))).view(np.int64)))
                    sig.append(signature(s, by).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(hi, pa.int64()),
                 pa.array(lo, pa.int64()), pa.array(sig, pa.binary())],
                names=["doc_id", "n_shingles", "set_hi", "set_lo", "signature"],
            )

    return run


def prefix_keys(depths: list[int], first: int):
    """For each text and order, hashes of the order's prefixes of the given lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = VALUES // first
        for batch in batches:
            if not batch.num_rows:
                continue
            s = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, VALUES).astype(np.uint64)
            keys = []
            for t in range(trees):
                h, done, row = np.full(len(s), np.uint64(t + 1)), 0, []
                for d in depths:
                    for i in range(done, d):
                        h = mix(h * np.uint64(BASE) + s[:, (t * first + i) % VALUES])
                    done = d
                    row.append(h.view(np.int64))
                keys.append(np.stack(row, 1))
            keys = np.stack(keys, 1).reshape(-1)  # text, order, depth
            n = len(s) * trees
            one = lambda x: pa.array(np.repeat(np.asarray(x), trees))
            yield pa.RecordBatch.from_arrays(
                [one(batch.column(0)), one(batch.column(2)), pa.array(np.tile(np.arange(trees, dtype=np.int32), len(s))),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(depths)), pa.array(keys))],
                names=["rep", "n_shingles", "tree", "keys"],
            )

    return run


def keyed(reps: DataFrame, depths: list[int], first: int) -> DataFrame:
    return reps.select("rep", "signature", "n_shingles").mapInArrow(
        trimmed(prefix_keys(depths, first)), "rep long, n_shingles long, tree int, keys array<long>"
    )


def sized(rows: DataFrame) -> DataFrame:
    """Regions with their size and a fingerprint of their members."""
    mark = F.xxhash64("rep")
    return (
        rows.groupBy("key")
        .agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("weight"), F.min("rep").alias("leader"),
             F.bit_xor(mark).alias("x"), F.sum(mark.bitwiseAND(0xFFFFFFFF)).alias("y"))
        .where("docs > 1")
    )


def regions(reps: DataFrame, first: int) -> tuple[DataFrame, DataFrame | None]:
    """``(key, rep)`` of sets that fit one task, and of the crowded regions (None: there are none).

    The first holds all other regions whole, and of the crowded ones what joins them cheaply.
    """
    fits = (F.col("docs") <= REGION_DOCS) & (F.col("weight") <= REGION_SHINGLES)
    rows = stored(keyed(reps, [first], first).select("rep", "n_shingles", "tree", F.col("keys")[0].alias("key")), "forest")
    found = stored(sized(rows), "regions")
    # Regions of several orders with the same members are compared once.
    once = found.where(fits).groupBy("docs", "x", "y").agg(F.min("key").alias("key")).select("key")
    out = rows.join(once, "key").select("key", "rep")
    over = found.where(~fits)
    if over.isEmpty():
        return out, None
    # The crowded ones alone: longer prefixes of the same orders.
    depths = [d for d in (6, 8, 12, 16, 24, 32, 48, VALUES) if d > first]
    inside = stored(
        rows.join(over.select("key", "leader"), "key")
        .select("key", "rep", "n_shingles", "tree", "leader"), "crowded",
    )
    crowded = inside.select("key", "rep")
    deep = keyed(reps.join(inside.select("rep").distinct(), "rep"), depths, first)
    rest = stored(deep.join(inside, ["rep", "n_shingles", "tree"]), "crowded")
    with_leader = inside.where("rep <> leader").select(
        F.xxhash64("rep", "leader").alias("key"), F.explode(F.array("rep", "leader")).alias("rep")
    )
    out = out.union(with_leader.distinct())
    for i, _ in enumerate(depths):
        level = rest.select("rep", "n_shingles", "tree", "keys", F.col("keys")[i].alias("key"))
        found = stored(sized(level), "regions")
        once = found.where(fits).groupBy("docs", "x", "y").agg(F.min("key").alias("key")).select("key")
        out = out.union(level.join(once, "key").select("key", "rep"))
        over = found.where(~fits)
        if over.isEmpty():
            return out, crowded
        rest = stored(level.join(over.select("key", F.col("leader"), "docs", "weight"), "key").drop("key"), "crowded")
        if i + 1 < len(depths):
            rest = rest.select("rep", "n_shingles", "tree", "keys")
    # Equal signatures throughout: parts of bounded size, each with the region's leader.
    parts = F.greatest(F.ceil(F.col("docs") / REGION_DOCS), F.ceil(F.col("weight") / REGION_SHINGLES)) * 2
    part = F.xxhash64("tree", "leader", F.pmod(F.xxhash64("rep"), parts))
    split = rest.select(part.alias("key"), "rep", "leader")
    return out.union(split.select("key", "rep")).union(split.select("key", "leader").distinct()), crowded


def shingler(size: int):
    """The shingles of ``(rep, label, text)``; ``mark`` tells texts of one rep apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat(batch.column(2))
            for a, b in chunks(at, PART):
                words, first = word_hashes(data[at[a] : at[b]], at[a : b + 1] - at[a])
                sets = [shingles(words[first[i] : first[i + 1]], size) for i in range(b - a)]
                ends = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b],
                     pa.array([int(mix(s + np.uint64(7)).sum().view(np.int64)) for s in sets], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))],
                    names=["rep", "label", "mark", "grams"],
                )

    return run


def spread(rows: DataFrame, few: DataFrame) -> DataFrame:
    """``rows`` joined to the one row of ``few`` with their ``gram``; a hot one is dealt over several tasks."""
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)))
    return dealt.join(few.select("*", salts.alias("_salt")), ["gram", "_salt"]).drop("_salt")


def joined(size_of: list[int], owns: list[int], labels: list[int], before: list[frozenset], sets: list[frozenset],
           cross: bool, num: int, den: int) -> Iterator[tuple[int, int]]:
    """Links between different labels; a pair with a common earlier shingle was compared there."""
    root = {x: x for x in labels}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    order = sorted(range(len(sets)), key=size_of.__getitem__)
    for at, i in enumerate(order):
        for j in order[at + 1 :]:
            if den * size_of[i] < num * size_of[j]:
                break
            if cross and owns[i] == owns[j]:
                continue
            ri, rj = find(labels[i]), find(labels[j])
            if ri == rj or not before[i].isdisjoint(before[j]):
                continue
            both = len(sets[i] & sets[j])
            if den * both >= num * (size_of[i] + size_of[j] - both):
                root[rj] = ri
                yield i, j


def compare_parts(num: int, den: int):
    """Walk rows sorted by shingle and pair of parts; yield links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []

        def flush():
            reps, owns, labels, before, sets = zip(*members)
            got = joined([len(s) for s in sets], owns, labels, before, sets, key[1] != key[2], num, den)
            got = [(reps[i], reps[j]) for i, j in got]
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in got], pa.int64()), pa.array([y for _, y in got], pa.int64())], names=["a", "b"]
            )

        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            plain = [batch.column(i).to_pylist() for i in range(3, 6)]
            for n, k in enumerate(keys):
                if k != key:
                    if len(members) > 1:
                        yield flush()
                    key, members = k, []
                lists = (frozenset(batch.column(i)[n].values.to_numpy().tolist()) for i in (6, 7))
                members.append((*(p[n] for p in plain), *lists))
        if len(members) > 1:
            yield flush()

    return run


def exact_links(crowded: DataFrame, texts: DataFrame, groups: DataFrame, size: int, num: int, den: int) -> DataFrame | None:
    """``(a, b)``: all that still joins groups within crowded regions, by an exact join."""
    label = F.coalesce("component", "rep").alias("label")
    named = stored(crowded.join(groups, crowded.rep == groups.node, "left").select("key", "rep", label), "labelled")
    several = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    left = named.join(several, "key").select("rep", "label").distinct()
    # Texts with one doc_id may differ: each is a set of its own.
    sets = stored(
        left.join(texts.where("text is not null").withColumnRenamed("doc_id", "rep"), "rep").select("rep", "label", "text")
        .mapInArrow(trimmed(shingler(size)), "rep long, label long, mark long, grams array<long>")
        .where(F.size("grams") > 0).dropDuplicates(["rep", "mark"]), "sets",
    )
    if sets.isEmpty():
        return None
    each = sets.select("rep", "label", "mark", F.size("grams").cast("long").alias("n"), F.explode("grams").alias("gram"))
    shared = each.groupBy("gram").agg(F.count("*").alias("often")).where("often > 1")
    # The rarest shingles of a set come first, those of no other set before all.
    rare = F.sort_array(F.collect_list(F.struct("often", "gram")))
    kept = F.expr(f"greatest(n - (n * {num} + {den - 1}) div {den} + 1 - (n - size(rare)), 0)").cast("int")
    prefix = spread(each, shared).groupBy("rep", "label", "mark", "n").agg(rare.alias("rare"))
    prefix = stored(
        prefix.select("rep", "label", "mark", "n", F.slice("rare", F.lit(1), kept)["gram"].alias("prefix")), "prefixes"
    )
    posts = prefix.select("*", F.posexplode("prefix").alias("at", "gram")).select(
        "rep", "label", "mark", "n", "gram", F.slice("prefix", F.lit(1), F.col("at")).alias("before")
    )
    parts = F.greatest(F.ceil(F.count("*") / REGION_DOCS), F.ceil(F.sum("n") / REGION_SHINGLES))
    found = (
        posts.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), parts.alias("parts"))
        .where("lo < hi").select("gram", F.when(F.col("parts") > 1, F.col("parts") * 2).otherwise(1).alias("parts"))
    )
    own = F.pmod(F.xxhash64("rep", "mark"), F.col("parts"))
    pairs = (
        spread(posts, found).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select("gram", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                "rep", "own", "label", "before", "mark")
    )
    return (
        pairs.join(sets.select("rep", "mark", "grams"), ["rep", "mark"])
        .select("gram", "i", "j", "rep", "own", "label", "before", "grams")
        .repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j", "rep")
        .mapInArrow(trimmed(compare_parts(num, den)), "a long, b long")
    )


def linked(sets: list[np.ndarray], num: int, den: int) -> Iterator[tuple[int, int]]:
    """Links that join what can be joined, by full sets: fewer than members."""
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sets = [frozenset(s.tolist()) for s in sets]
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    for at, i in enumerate(order):
        a = sets[i]
        for j in order[at + 1 :]:
            b = sets[j]
            if den * len(a) < num * len(b):
                break
            ri, rj = find(i), find(j)
            if ri == rj:
                continue
            both = len(a & b)
            if den * both >= num * (len(a) + len(b) - both):
                root[rj] = ri
                yield i, j


def compare(size: int, num: int, den: int):
    """Walk rows sorted by region; yield its links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, {}

        def flush():
            ids = list(members)
            got = [(ids[i], ids[j]) for i, j in linked(list(members.values()), num, den)]
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in got], pa.int64()), pa.array([y for _, y in got], pa.int64())], names=["a", "b"]
            )

        for batch in batches:
            keys, reps = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            data, at = flat(batch.column(2))
            for a, b in chunks(at, PART):
                words, first = word_hashes(data[at[a] : at[b]], at[a : b + 1] - at[a])
                for i in range(b - a):
                    if keys[a + i] != key:
                        if len(members) > 1:
                            yield flush()
                        key, members = keys[a + i], {}
                    members[reps[a + i]] = shingles(words[first[i] : first[i + 1]], size)
        if len(members) > 1:
            yield flush()

    return run


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``.

    Two documents are linked if ``den * |A & B| >= num * |A | B|`` for their sets of
    ``size``-word shingles; a component is named by its smallest ``doc_id``.
    """
    first = first_depth(num / den)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = stored(texts.mapInArrow(trimmed(sketcher(size)), SKETCH), "sketch")
    same = ["set_hi", "set_lo"]
    classes = stored(
        sketch.where("doc_id is not null and set_hi is not null").groupBy(*same)
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes",
    )
    reps = sketch.join(
        classes.select(*same, F.col("rep").alias("doc_id")), [*same, "doc_id"], "left_semi"
    ).withColumnRenamed("doc_id", "rep")
    members, crowded = regions(reps, first)
    named = members.join(texts.withColumnRenamed("doc_id", "rep"), "rep").select("key", "rep", "text")
    links = (
        named.repartition("key").sortWithinPartitions("key", "rep")
        .mapInArrow(trimmed(compare(size, num, den)), "a long, b long")
    )
    # Rows of one doc_id with different texts are one document: their classes are linked.
    shared = (
        sketch.where("doc_id is not null and set_hi is not null").join(classes, same)
        .groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("a"), F.count("*").alias("n"))
        .where("n > 1 and a <> b").select("a", "b")
    )
    groups = components(links.union(shared))
    if crowded is not None:
        more = exact_links(crowded, texts, groups, size, num, den)
        if more is not None:
            groups = components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    moved = (
        classes.join(groups, classes.rep == groups.node, "left")
        .select(*same, F.coalesce("component", "rep").alias("component"), "copies", "rep")
        .where("copies > 1 or component <> rep").select(*same, "component")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        sketch.drop("signature").join(moved, same, "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest id.

    Rows without ``doc_id`` stay; of several rows with one ``doc_id`` the one whose text
    hashes lowest stays.
    """
    found = near_duplicates(docs.select("doc_id", "text"), size, num, den)
    gone = stored(found.where(~found.kept).select("doc_id").distinct(), "near_copies")
    kept = docs.join(gone, "doc_id", "left_anti")
    twice = stored(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated_ids")
    if twice.isEmpty():
        return kept
    order, rank = Window.partitionBy("doc_id").orderBy(F.xxhash64("text")), fresh(docs, "rank")[0]
    several = kept.join(twice, "doc_id", "left_semi").withColumn(rank, F.row_number().over(order))
    return kept.join(twice, "doc_id", "left_anti").unionByName(several.where(F.col(rank) == 1).drop(rank))
