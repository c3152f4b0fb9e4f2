"""Trie of conversation prefixes, by Spark SQL ROLLUP over positional turn-id columns.

Every turn becomes an id, a hash of its role and text. The turns of a conversation stand
in rows of ``WIDTH`` columns; a long conversation continues in further rows, its blocks,
each keyed by the node at which the block before ended. ``GROUP BY prior, ROLLUP(t0, t1,
...)`` then makes every prefix of every block at once: ``grouping_id`` says how many turns
a row of the result holds, and all conversations that share a node fall into one row, by
partial aggregation before any shuffle.

A node's name is the exact sum of the hashes of its blocks, each salted with its number.
So the key of every block comes from a running sum, and all blocks roll up in one pass,
however long a conversation is.

Sums over subtrees need no walk through the trie. A conversation is the smallest member of
a node at all depths from some ``own`` on, so the nodes that carry its id tell that depth.
A node's leaves are those of its members that are the smallest of a childless node, and
what its subtree saves is the words its members have from its depth to their ``own``, both
sums over members that a second ROLLUP takes.

Positions and running sums are computed in stretches of turns and over the stretches'
totals, so one very long conversation is spread over tasks. Ids of conversations that end
at one node are joined in chunks, then hashed as a stream.

Edge cases: rows without ``conv_id`` take no part. Turns of equal number are ordered by
the MD5 of role and text, so that no text is shuffled; repeated rows are turns of their own. Null role and text are empty. A
negative ``conv_id`` is rebuilt from ``conv_id % 20`` truncated towards zero. Very long
texts are only hashed and counted. Other columns are not read. An empty table has no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.llm.common import stored

#: Turn-id columns of one block.
WIDTH = 8
#: Turn numbers within which positions are counted; conversations whose ids are joined as one text.
STRETCH, CHUNK = 1024, 4096
# Fixed value: what a word is.
WORD = r"[^\x20\x09-\x0D]+"


def numbered(turns: DataFrame) -> DataFrame:
    """``(conv_id, pos, id, words)``: turns in order, counted from 0."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    t = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    # Nulls come first: their stretch is before all others.
    stretch = F.coalesce(F.floor(F.col("turn") / STRETCH) + 1, F.lit(-(1 << 62))).cast("long")
    t = t.select(
        "conv_id", "turn", stretch.alias("stretch"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("id"),
    )
    order = Window.partitionBy("conv_id", "stretch").orderBy(F.asc_nulls_first("turn"), "id")
    t = t.withColumn("_row", F.row_number().over(order) - 1).drop("turn")
    t = stored(t, "turns")
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    start = (
        t.groupBy("conv_id", "stretch").agg(F.count("*").alias("n"))
        .withColumn("_start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    )
    return t.join(start, ["conv_id", "stretch"]).select("conv_id", (F.col("_row") + F.col("_start")).alias("pos"), "id", "words")


def rebuilt(turns: DataFrame, family: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of their family's first: ``(conv_id, pos, id, words)`` and all ids.

    Conversation c takes its first ``crc32(c) % shared`` turns from ``c - c % family``.
    """
    t = stored(numbered(turns), "numbered")
    c = F.col("conv_id")
    convs = (
        t.select("conv_id").distinct()
        .withColumn("head", (F.crc32(c.cast("string").cast("binary")) % shared).cast("int"))
        .withColumn("first", c - c % family)
    )
    heads = t.where(F.col("pos") < shared - 1).select(F.col("conv_id").alias("first"), "pos", "id", "words")
    taken = convs.join(heads, "first").where("pos < head").select("conv_id", "pos", "id", "words")
    length = heads.groupBy("first").agg(F.count("*").alias("n_first"))
    shift = convs.join(length, "first", "left").select(
        "conv_id", "head", (F.least(F.coalesce("n_first", F.lit(0)), "head") - F.col("head")).alias("shift")
    )
    rest = t.join(shift, "conv_id").where("pos >= head").select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "id", "words")
    return taken.union(rest), convs.select("conv_id")


def named(*columns) -> tuple[Column, Column]:
    """Two hashes of the columns, as exact numbers that can be summed."""
    return tuple(F.xxhash64(F.lit(salt), *columns).cast("decimal(38,0)") for salt in (1, 2))


def running(rows: DataFrame, by: str, order: str, sums: dict[str, str]) -> DataFrame:
    """Exclusive running sums in the order of ``order`` (from 0, gapless) within ``by``, stretch by stretch."""
    rows = rows.withColumn("_stretch", F.floor(F.col(order) / STRETCH))
    inner = Window.partitionBy(by, "_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda name: F.lit(0).cast(rows.schema[name].dataType)
    total = rows.groupBy(by, "_stretch").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    total = total.select(by, "_stretch", *[F.coalesce(F.sum(f"_t_{c}").over(outer), zero(c)).alias(f"_b_{c}") for c in sums])
    rows = rows.select("*", *[F.coalesce(F.sum(c).over(inner), zero(c)).alias(f"_w_{c}") for c in sums])
    rows = rows.join(total, [by, "_stretch"])
    for c, name in sums.items():
        rows = rows.withColumn(name, (F.col(f"_w_{c}") + F.col(f"_b_{c}")).cast(rows.schema[c].dataType))
    return rows.drop("_stretch", *[f"{p}{c}" for c in sums for p in ("_w_", "_b_")])


def blocks(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``(conv_id, block, n, t0.., w0.., x, y, words_before)``: turns side by side, keyed by the node before.

    Every conversation has block 0, even without turns. ``x``, ``y`` name the node at
    which the block before ended, ``n`` is how many turns the block has.
    """
    block = F.floor(F.col("pos") / WIDTH).cast("long")
    slot = F.col("pos") % WIDTH
    at = lambda c, i: F.max(F.when(F.col("_slot") == i, F.col(c))).alias(f"{c[0] if c != 'id' else 't'}{i}")
    wide = (
        turns.withColumn("block", block).withColumn("_slot", slot).groupBy("conv_id", "block")
        .agg(F.count("*").cast("int").alias("n"), *[at("id", i) for i in range(WIDTH)], *[at("words", i) for i in range(WIDTH)])
    )
    none = convs.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select("conv_id", F.lit(0).cast("long").alias("block"))
    wide = wide.unionByName(none, allowMissingColumns=True).withColumn("n", F.coalesce("n", F.lit(0)))
    ids = [f"t{i}" for i in range(WIDTH)]
    hx, hy = named("block", *ids)
    words = sum((F.coalesce(F.col(f"w{i}"), F.lit(0)) for i in range(1, WIDTH)), F.coalesce(F.col("w0"), F.lit(0)))
    wide = wide.withColumn("hx", hx).withColumn("hy", hy).withColumn("_words", words)
    return running(wide, "conv_id", "block", {"hx": "x", "hy": "y", "_words": "words_before"}).drop("hx", "hy", "_words")


def rolled(rows: DataFrame, aggregates: dict[str, str]) -> DataFrame:
    """One row per node: ``(x, y, block, level, t0.., aggregates)``; ``{i}`` in an aggregate is each level's slot.

    An aggregate is SQL; those with ``{i}`` are taken of the last turn's slot.
    """
    ids = [f"t{i}" for i in range(WIDTH)]
    plain = {k: v for k, v in aggregates.items() if "{i}" not in v}
    slots = {k: [v.format(i=i) for i in range(WIDTH)] for k, v in aggregates.items() if "{i}" in v}
    # grouping_id has a bit for each column that is rolled up: WIDTH - level of them, the last ones.
    level = f"{WIDTH} - bit_count(grouping_id())"
    chosen = [f"{v} AS {k}" for k, v in plain.items()]
    for k, each in slots.items():
        chosen.append(f"CASE {level} " + " ".join(f"WHEN {i + 1} THEN {v}" for i, v in enumerate(each)) + f" ELSE max(0) END AS {k}")
    out = rows.sparkSession.sql(
        f"SELECT block, x, y, {', '.join(ids)}, CAST({level} AS int) AS level, {', '.join(chosen)} "
        f"FROM {{rows}} GROUP BY block, x, y, ROLLUP({', '.join(ids)})",
        rows=rows,
    )
    last = F.coalesce(*[F.when(F.col("level") == i + 1, F.col(f"t{i}")) for i in range(WIDTH)])
    # A conversation that has ended is no member of deeper nodes; a block's own start is the end of the one before.
    return out.where(((F.col("level") == 0) & (F.col("block") == 0)) | last.isNotNull())


def node_names(nodes: DataFrame) -> DataFrame:
    """Names of nodes and of their parents, from the block's key and its first turns."""
    def name(level: Column, which: int) -> Column:
        ids = [F.when(level > i, F.col(f"t{i}")) for i in range(WIDTH)]
        base = F.col("xy"[which])
        return F.when(level > 0, base + named("block", *ids)[which]).otherwise(base).cast("decimal(38,0)")

    level = F.col("level")
    return nodes.select(
        "*", (F.col("block") * WIDTH + level).alias("depth"), name(level, 0).alias("nx"), name(level, 1).alias("ny"),
        name(level - 1, 0).alias("px"), name(level - 1, 1).alias("py"),
    )


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts ``(conv_id, depth, text)`` sorted by node and order: one SHA-256 per node, of all joined by commas."""
    key, h, out = None, None, []

    def flush(force: bool):
        nonlocal out
        if out and (force or len(out) >= 10_000):
            done, out = out, []
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string()))],
                names=["conv_id", "depth", "ends_sha256"],
            )

    for batch in batches:
        for conv, depth, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if key != (conv, depth):
                if h:
                    out.append((*key, h.hexdigest()))
                key, h = (conv, depth), hashlib.sha256()
            else:
                h.update(b",")
            h.update(text.encode())
        yield from flush(False)
    if h:
        out.append((*key, h.hexdigest()))
    yield from flush(True)


def ends(convs: DataFrame) -> DataFrame:
    """``(conv_id, depth, ends_sha256)`` per node at which conversations ``(conv_id, length, node_conv)`` end."""
    chunk = F.floor(F.col("conv_id") / CHUNK).alias("chunk")
    joined = (
        convs.groupBy(F.col("node_conv").alias("conv_id_"), F.col("length").alias("depth"), chunk)
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("text"))
        .withColumnRenamed("conv_id_", "conv_id")
    )
    ordered = joined.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "chunk")
    return ordered.select("conv_id", "depth", "text").mapInArrow(digests, "conv_id long, depth long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of ``turns(conv_id, pos, id, words)`` over the conversations ``convs(conv_id)``.

    ``(conv_id, depth)`` names a node: a conversation's prefix of one length is one node.
    """
    rows = stored(blocks(turns, convs), "blocks")
    length = stored(rows.groupBy("conv_id").agg(F.sum("n").cast("long").alias("length")), "lengths")
    with_length = rows.join(length, "conv_id")
    first = rolled(
        with_length,
        {"n_convs": "count(*)", "conv_id": "min(conv_id)", "_end": f"count(CASE WHEN length = block * {WIDTH} + {{i}} + 1 THEN 1 END)",
         "_root_end": "count(CASE WHEN length = 0 THEN 1 END)"},
    )
    n_end = F.when(F.col("level") == 0, F.col("_root_end")).otherwise(F.col("_end"))
    nodes = node_names(first.withColumn("n_ends", n_end)).select(
        "depth", "nx", "ny", "px", "py", "conv_id", "n_convs", "n_ends"
    )
    nodes = stored(nodes, "nodes")
    # From depth ``own`` on a conversation is the smallest member of its nodes.
    held = nodes.groupBy("conv_id").agg(F.count("*").alias("held"), F.max((F.col("n_convs") == F.col("n_ends")).cast("long")).alias("leaf"))
    per_conv = length.join(held, "conv_id", "left").select(
        "conv_id", "length", (F.col("length") + 1 - F.coalesce("held", F.lit(0))).alias("own"), F.coalesce("leaf", F.lit(0)).alias("leaf")
    )
    words = lambda i: F.coalesce(F.col(f"w{i}"), F.lit(0))
    rows = rows.join(per_conv, "conv_id")
    begin = F.col("block") * WIDTH
    shared = sum(
        (F.when(begin + i + 1 < F.col("own"), words(i)).otherwise(0) for i in range(1, WIDTH)),
        F.when(begin + 1 < F.col("own"), words(0)).otherwise(0),
    )
    total = rows.groupBy("conv_id").agg(F.sum(shared).alias("total"))
    rows = rows.join(total, "conv_id")
    so_far = F.col("words_before")
    for i in range(WIDTH):
        rows = rows.withColumn(f"s{i}", F.when(begin + i + 1 < F.col("own"), F.col("total") - so_far).otherwise(0).cast("long"))
        so_far = so_far + words(i)
    second = rolled(
        stored(rows.select("conv_id", "block", "x", "y", *[f"t{i}" for i in range(WIDTH)], *[f"s{i}" for i in range(WIDTH)], "total", "leaf"), "shares"),
        {"n_leaves": "sum(leaf)", "_saved": "sum(s{i})", "_root_saved": "sum(total)", "conv_id": "min(conv_id)"},
    )
    sums = node_names(second).select(
        "conv_id", "depth", "n_leaves",
        F.when(F.col("level") == 0, F.col("_root_saved")).otherwise(F.col("_saved")).cast("long").alias("saved_tokens"),
    )
    children = nodes.where("depth > 0").groupBy("px", "py").agg(F.count("*").alias("n_children"))
    # A node's smallest member is its parent's too, but where it becomes the smallest: one node of a conversation.
    known = per_conv.select("conv_id", "own")
    parents = stored(nodes.join(children.select(F.col("px").alias("nx"), F.col("py").alias("ny"), "n_children"), ["nx", "ny"], "left"), "parents")
    asked = stored(parents.join(known, "conv_id"), "asked")
    above = parents.where("n_children > 0").select(F.col("nx").alias("px"), F.col("ny").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    turning = asked.where("depth = own and depth > 0").join(above, ["px", "py"])
    same = asked.where("depth <> own or depth = 0").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    shape = ["conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children")]
    found = turning.select(*shape).union(same.select(*shape))
    # Where a conversation ends: at its own node, or at one of a smaller conversation.
    last = stored(ended_at(rows, length), "last_nodes")
    at_end = last.join(nodes.select("nx", "ny", F.col("conv_id").alias("node_conv")), ["nx", "ny"]).select("conv_id", "length", "node_conv")
    return (
        found.join(sums, ["conv_id", "depth"]).join(ends(at_end), ["conv_id", "depth"], "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    )


def ended_at(rows: DataFrame, length: DataFrame) -> DataFrame:
    """``(conv_id, length, nx, ny)``: the node of each whole conversation."""
    last = rows.drop("length").join(length, "conv_id").where(
        (F.col("block") == F.floor((F.col("length") - 1) / WIDTH)) | ((F.col("length") == 0) & (F.col("block") == 0))
    )
    level = (F.col("length") - F.col("block") * WIDTH).cast("int").alias("level")
    return node_names(last.select("conv_id", "length", "block", "x", "y", *[f"t{i}" for i in range(WIDTH)], level)).select(
        "conv_id", "length", "nx", "ny"
    )


def conversation_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the rebuilt conversations of ``turns(conv_id, turn, role, text)``."""
    built, convs = rebuilt(turns)
    return trie(stored(built, "rebuilt"), stored(convs, "convs"))
