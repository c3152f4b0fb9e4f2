"""Repeated runs of words removed by prefix-partitioned suffix trees.

A word goes if it lies in a window of ``LENGTH`` consecutive words whose sequence also
starts anywhere else. The suffixes of the corpus that can matter are split by prefixes of
variable length into groups that fit a task's memory; a tree is built for each group, and
its internal nodes of depth ``LENGTH`` and more are the repeats.

1. *Suffixes.* Of every window, the smallest hash of ``PREFIX`` words in a row is its
   anchor. Equal windows have it at the same place. So only suffixes that begin at anchors
   need a tree, with the words before them that their windows reach: a *stretch*. Anchors
   whose prefix occurs once are leaves right below the root and go.
2. *Leaves.* Equal stretches are one leaf with a count. A leaf of several has repeats
   throughout.
3. *Groups.* Leaves with one prefix are a group; small groups share a task. A prefix with
   more than ``CROWD`` leaves is made longer: its windows are dealt by where they begin
   before the anchor into ranges, and the windows of one range have a longer prefix in
   common. Stretches shrink to what the range's windows reach, so equal ones fall together
   again, and those whose longer prefix occurs once go. At the last length the prefix is
   the whole window and the group one leaf.
4. *Trees.* A group's leaves are sorted by their words from the common prefix on, and by
   their words before it, backwards; common prefixes of neighbours tell the internal nodes
   of both trees. A window is a node of the first at the depth of its part behind the
   anchor's place, and of the second at the depth of its part before it. If leaves that
   count two or more share both, it is a repeat.
5. Spans of each document are merged and cut out.

Nothing is collected. Results go back to the members of a leaf by a join in which leaves
with many members are dealt into parts.

Edge cases: null and blank texts have no words. Texts shorter than a window lose nothing.
Rows with one ``doc_id`` and the same text are repeats of each other; rows with one
``doc_id`` and different texts are told apart by the text. Long texts are searched whole,
in parts that overlap by a window. Words are compared as 64-bit hashes, stretches by two.
Columns other than ``doc_id`` and ``text`` are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.common import dealt_join, release, stored
from obs_engine.llm.textvec import BASE, SPACE, chunks, flat, mix, powers, prefix_hash, spans

LENGTH, PREFIX = 35, 12
#: Offsets a window may have before its anchor.
OFFSETS = LENGTH - PREFIX + 1
#: Offsets of one range as prefixes get longer; with one, the prefix is the window.
RANGES = (12, 6, 3, 1)
#: Leaves of one prefix above which it is made longer; bytes of leaves whose trees are built at once.
CROWD, TREE_BYTES = 20_000, 1 << 23
#: Bytes of texts searched at once.
PART = 1 << 20
SLICE = 500
PLACE = [("doc", pa.int64()), ("mark", pa.int64())]
STRETCH = [*PLACE, ("begin", pa.int32()), ("lead", pa.int32()), ("windows", pa.int32()), ("prefix", pa.int64()), ("body", pa.int64())]
#: A window of a leaf begins ``low`` to ``high`` words before the anchor.
LEAF = [("prefix", pa.int64()), ("body", pa.int64()), ("copies", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("text", pa.binary())]
PARENT = [("from_prefix", pa.int64()), ("from_body", pa.int64()), ("shift", pa.int32())]
FOUND = [("prefix", pa.int64()), ("body", pa.int64()), ("copies", pa.int64()), ("runs", pa.list_(pa.int32()))]


def ddl(fields) -> str:
    names = {"int64": "long", "int32": "int", "binary": "binary", "list<item: int32>": "array<int>"}
    return ", ".join(f"{n} {names[str(t)]}" for n, t in fields)


def batch_of(fields, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def words_in(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words as they stand, each text's first, and where words begin and end."""
    is_word = np.ones(256, bool)
    is_word[list(SPACE)] = False
    begin, end, first = spans(is_word[data], at)
    p = prefix_hash(data)
    _, down = powers(len(data) + 1)
    return mix((p[end] - p[begin]) * down[begin] + (end - begin).astype(np.uint64)), first, begin, end


def word_prefixes(words: np.ndarray) -> np.ndarray:
    """P with (P[e] - P[s]) / BASE**s the hash of words[s:e]."""
    up, _ = powers(len(words) + 1)
    out = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=out[1:])
    return out


def run_hash(p: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(p) + 1)
    return mix((p[end] - p[begin]) * down[begin] + (end - begin).astype(np.uint64))


def smallest(key: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values in a row."""
    n = len(key) - width + 1
    rows = -(-len(key) // width)
    grid = np.full(rows * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    grid[: len(key)] = key
    grid = grid.reshape(rows, width)
    up = np.minimum.accumulate(grid, 1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], up[width - 1 : width - 1 + n])


def stretches_of(words: np.ndarray, first: np.ndarray):
    """``(text, begin, lead, windows, prefix, body)`` of each anchor, begins counted in its text's words."""
    n = len(words) - LENGTH + 1
    if n <= 0:
        return None
    p = word_prefixes(words)
    place = np.uint64((1 << 24) - 1)
    s = np.arange(len(words) - PREFIX + 1)
    key = (run_hash(p, s, s + PREFIX) & ~place) | s.astype(np.uint64)
    low = smallest(key, OFFSETS)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    start = np.flatnonzero(text[:n] == text[LENGTH - 1 :])
    if not len(start):
        return None
    anchor = (low[start] & place).astype(np.int64)
    edge = np.flatnonzero((anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1))
    begin, last = start[np.append(0, edge + 1)], start[np.append(edge, len(start) - 1)]
    at = anchor[np.append(0, edge + 1)]
    lead, windows = at - begin, last - begin + 1
    # Two hashes: of the prefix, and of the whole stretch with its shape.
    shape = (lead * 64 + windows).astype(np.uint64)
    body = mix(run_hash(p, begin, last + LENGTH) * np.uint64(BASE) + shape)
    return text[begin], begin - first[text[begin]], lead, windows, run_hash(p, at, at + PREFIX), body


def find_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchored stretches of ``(doc, mark, text)``."""
    for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
        docs, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        data, at = flat(batch.column(2))
        for a, b in chunks(at, PART):
            words, first, _, _ = words_in(data[at[a] : at[b]], at[a : b + 1] - at[a])
            # Anchors are found in parts of at most 2**23 words, each window in one part.
            size = 1 << 23
            for x in range(0, max(len(words) - LENGTH + 1, 0), size):
                part = slice(x, min(x + size + LENGTH - 1, len(words)))
                found = stretches_of(words[part], np.clip(first - x, 0, part.stop - x))
                if found is None:
                    continue
                text, begin, lead, windows, prefix, body = found
                begin = begin + np.maximum(x - first[text], 0)
                yield batch_of(STRETCH, (
                    docs[a + text], marks[a + text], begin.astype(np.int32), lead.astype(np.int32), windows.astype(np.int32),
                    prefix.view(np.int64), body.view(np.int64),
                ))


def cut_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted stretches of ``(text, found)`` as leaves."""
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            part = batch.slice(i, SLICE)
            data, at = flat(part.column(0))
            _, first, begin, end = words_in(data, at)
            rows = []
            for base, found in zip(first.tolist(), part.column(1).to_pylist()):
                for s in found:
                    w = base + s["begin"]
                    text = data[begin[w] : end[w + s["windows"] + LENGTH - 2]].tobytes()
                    rows.append((s["prefix"], s["body"], s["copies"], s["lead"] - s["windows"] + 1, s["lead"], text))
                if len(rows) > 5000:
                    yield batch_of(LEAF, list(zip(*rows)))
                    rows = []
            if rows:
                yield batch_of(LEAF, list(zip(*rows)))


def longer_prefixes(width: int):
    """Leaves cut by ranges of ``width`` offsets, with the leaf each is cut from and how many windows come before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                data, at = flat(part.column(5))
                words, first, starts, ends = words_in(data, at)
                p = word_prefixes(words)
                rows, edges = [], []
                for base, (prefix, body, copies, low, high) in zip(first.tolist(), zip(*(part.column(c).to_pylist() for c in range(5)))):
                    anchor = base + high
                    for floor in range(low // width * width, high + 1, width):
                        least, most = max(floor, low), min(floor + width - 1, high)
                        # All windows of the range hold the words of ``core``; those of this leaf reach over ``own``.
                        core, own = (anchor - floor, anchor - floor - width + 1 + LENGTH), (anchor - most, anchor - least + LENGTH)
                        edges.append((*core, *own, floor * 64 + width, least * 64 + most))
                        text = data[starts[own[0]] : ends[own[1] - 1]].tobytes()
                        rows.append((copies, least, most, text, prefix, body, high - most))
                if rows:
                    e = np.array(edges, np.int64)
                    core = mix(run_hash(p, e[:, 0], e[:, 1]) + e[:, 4].astype(np.uint64)).view(np.int64)
                    own = mix(run_hash(p, e[:, 2], e[:, 3]) * np.uint64(BASE) + e[:, 5].astype(np.uint64)).view(np.int64)
                    yield batch_of([*LEAF, *PARENT], [core, own, *zip(*rows)])

    return run


def tree_nodes(group: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each leaf its node at each depth, from the root of its group to the last of ``words``' columns.

    Leaves are sorted by group and words; at each depth, neighbours with a common prefix
    of that many words are in one node.
    """
    n, depths = words.shape
    keys = np.column_stack((group.astype(">u8"), words.astype(">u8")))
    order = np.argsort(np.ascontiguousarray(keys).view(f"S{8 * (depths + 1)}").reshape(-1), kind="stable")
    g, w = group[order], words[order]
    differs = np.column_stack((g[1:] != g[:-1], w[1:] != w[:-1], np.ones(n - 1, bool)))
    lcp = differs.argmax(1)
    nodes = np.empty((n, depths + 1), np.int64)
    for d in range(depths + 1):
        nodes[order, d] = np.concatenate(([0], np.cumsum(lcp <= d)))
    return nodes


def repeats_in(leaves: pa.RecordBatch) -> list[list[int]]:
    """For each leaf the runs of its windows, ``[first, last, ...]`` counted from its begin, that are repeats."""
    n = leaves.num_rows
    group = np.unique(leaves.column(0).to_numpy(), return_inverse=True)[1].astype(np.int64)
    copies, low, high = (leaves.column(c).to_numpy().astype(np.int64) for c in (2, 3, 4))
    words, first, _, _ = words_in(*flat(leaves.column(5)))
    floor, top = int(low.min()), int(high.max())
    at = (first[:-1] + high)[:, None]
    d, b = np.arange(LENGTH), np.arange(max(top, 1))
    pick = lambda place, ok: np.where(ok, words[np.where(ok, place, 0)], np.uint64(0))
    behind = pick(at + d, d < (LENGTH - low)[:, None])
    before = pick(at - 1 - b, b < high[:, None])
    right, left = tree_nodes(group, behind), tree_nodes(group, before)
    hit = np.zeros((n, top - floor + 1), bool)
    for offset in range(floor, top + 1):
        own = np.flatnonzero((low <= offset) & (offset <= high))
        if len(own):
            both = right[own, LENGTH - offset] * (n + 1) + left[own, offset]
            _, node = np.unique(both, return_inverse=True)
            hit[own, offset - floor] = np.bincount(node, copies[own])[node] > 1
    # In text order: the largest offset is the first window.
    flags = np.zeros((n, top - floor + 3), np.int8)
    flags[:, 1:-1] = hit[:, ::-1]
    row, edge = np.nonzero(np.diff(flags, axis=1))
    edge = edge - (top - high)[row]  # windows begin at the leaf's own largest offset
    edge[1::2] -= 1
    cut = np.searchsorted(row, np.arange(n + 1))
    edge = edge.tolist()
    return [edge[x:y] for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]


def build_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves sorted by prefix: trees over as many groups as fit, and the runs of repeats of each leaf."""
    held, size = [], 0

    def flush(parts):
        leaves = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        runs = repeats_in(leaves)
        keep = pa.array([i for i, x in enumerate(runs) if x], pa.int64())
        return batch_of(FOUND, [*(leaves.column(c).take(keep) for c in range(3)), [x for x in runs if x]])

    for batch in batches:
        if not batch.num_rows:
            continue
        if size >= TREE_BYTES:
            # Up to where the last prefix of this batch begins; an earlier batch may hold its first leaves.
            prefix = batch.column(0).to_numpy()
            edge = np.flatnonzero(prefix[1:] != prefix[:-1]) + 1
            cut = int(edge[-1]) if len(edge) else 0
            if not cut and held[-1].column(0)[-1].as_py() != prefix[0]:
                yield flush(held)
                held, size = [], 0
            elif cut:
                yield flush([*held, batch.slice(0, cut)])
                held, size = [], 0
                batch = batch.slice(cut)
        held.append(batch)
        size += batch.column(5).nbytes
    if held:
        yield flush(held)


def trees(leaves: DataFrame) -> DataFrame:
    """``(prefix, body, copies, runs)`` of the leaves that hold repeats."""
    near = leaves.select(*[n for n, _ in LEAF]).repartition("prefix").sortWithinPartitions("prefix", "body")
    return near.mapInArrow(build_trees, ddl(FOUND))


def crowded(leaves: DataFrame) -> DataFrame:
    """The same of prefixes with more leaves than one task may hold, by longer prefixes."""
    out, links = None, []
    for level, width in enumerate(RANGES):
        cut = stored(leaves.mapInArrow(longer_prefixes(width), ddl([*LEAF, *PARENT])), "longer")
        links.append(cut.select("prefix", "body", *[n for n, _ in PARENT]))
        leaf = F.first(F.struct("low", "high", "text")).alias("leaf")
        leaves = stored(
            cut.groupBy("prefix", "body").agg(F.sum("copies").alias("copies"), leaf)
            .select("prefix", "body", "copies", "leaf.low", "leaf.high", "leaf.text"), "leaves",
        )
        sizes = stored(leaves.groupBy("prefix").agg(F.sum("copies").alias("n"), F.count("*").alias("leaves")).where("n > 1"), "sizes")
        leaves = dealt_join(leaves, sizes.drop("n"), ["prefix"], "leaves", ["body"])
        few = leaves if width == 1 else leaves.where(F.col("leaves") <= CROWD)
        runs = stored(trees(few), "tree_runs")
        for link in reversed(links):
            # From a leaf to all leaves it was cut from.
            runs = dealt_join(link, runs, ["prefix", "body"], "copies", ["from_prefix", "from_body"]).select(
                F.col("from_prefix").alias("prefix"), F.col("from_body").alias("body"), "copies",
                F.transform("runs", lambda x: x + F.col("shift")).alias("runs"),
            )
            runs = runs.groupBy("prefix", "body").agg(F.max("copies").alias("copies"), F.flatten(F.collect_list("runs")).alias("runs"))
        out = runs if out is None else out.union(runs)
        if width == 1 or sizes.where(F.col("leaves") > CROWD).isEmpty():
            return out
        leaves = leaves.where(F.col("leaves") > CROWD).select(*[n for n, _ in LEAF])
    return out


def repeated_runs(texts: DataFrame) -> DataFrame:
    """``(doc, mark, begin, end)``: runs of repeated words, in words, of ``texts(doc, mark, text)``."""
    found = stored(texts.mapInArrow(find_stretches, ddl(STRETCH)), "stretches")
    sizes = stored(found.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1"), "prefixes")
    members = stored(dealt_join(found, sizes, ["prefix"], "n", ["doc", "mark", "begin"]).drop("n"), "members")
    release(found)
    bodies = stored(
        members.groupBy("prefix", "body").agg(F.count("*").alias("copies"), F.min(F.struct("doc", "mark", "begin", "lead", "windows")).alias("one")),
        "bodies",
    )
    prefixes = stored(bodies.groupBy("prefix").agg(F.count("*").alias("leaves")), "prefixes")
    twice = stored(dealt_join(bodies, prefixes, ["prefix"], "leaves", ["body"]), "repeated")
    release(bodies)

    def leaves(some: DataFrame) -> DataFrame:
        s = F.struct("one.begin", "one.lead", "one.windows", "prefix", "body", "copies")
        wanted = some.groupBy("one.doc", "one.mark").agg(F.collect_list(s).alias("found"))
        return texts.join(wanted, ["doc", "mark"]).select("text", "found").mapInArrow(cut_leaves, ddl(LEAF))

    # A prefix with one leaf needs no tree: its count tells.
    runs = trees(leaves(twice.where(F.col("leaves").between(2, CROWD)))).select("prefix", "body", "runs")
    if not prefixes.where(F.col("leaves") > CROWD).isEmpty():
        runs = runs.union(crowded(leaves(twice.where(F.col("leaves") > CROWD))).select("prefix", "body", "runs"))
    copies = twice.where("copies > 1").select("prefix", "body", F.array(F.lit(0), F.col("one.windows") - 1).alias("runs"))
    runs = runs.union(copies).groupBy("prefix", "body").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    runs = stored(runs.join(twice.select("prefix", "body", "copies"), ["prefix", "body"]), "runs")
    release(twice)
    members = dealt_join(members.select("doc", "mark", "begin", "prefix", "body"), runs, ["prefix", "body"], "copies", ["doc", "mark", "begin"])
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.floor(F.size("runs") / 2).cast("int") - 1), lambda i: F.slice("runs", i * 2 + 1, 2)))
    each = members.select("doc", "mark", "begin", pair.alias("run"))
    spans_ = each.select("doc", "mark", (F.col("begin") + F.col("run")[0]).alias("begin"), (F.col("begin") + F.col("run")[1] + LENGTH).alias("end"))
    out = stored(spans_, "word_runs")
    release(runs)
    return out


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc_id, text, found)`` to word counts, merged runs, and the words that stay."""
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            part = batch.slice(i, SLICE)
            data, at = flat(part.column(1))
            words, first, begin, end = words_in(data, at)
            count, runs, kept = [], [], []
            for base, nxt, found in zip(first[:-1].tolist(), first[1:].tolist(), part.column(2).to_pylist()):
                out: list[list[int]] = []
                for s in sorted(found or [], key=lambda s: s["begin"]):
                    if out and s["begin"] <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], s["end"])
                    else:
                        out.append([s["begin"], s["end"]])
                stays = np.ones(nxt - base, bool)
                for b, e in out:
                    stays[b:e] = False
                which = base + np.flatnonzero(stays)
                kept.append(b" ".join([data[b:e].tobytes() for b, e in zip(begin[which].tolist(), end[which].tolist())]))
                count.append(nxt - base)
                runs.append([{"begin": b, "end": e} for b, e in out])
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(count, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "n_words", "runs", "kept"],
            )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, runs, kept)`` per row of ``docs(doc_id, text)``; runs are in words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc"),
        F.xxhash64(F.col("doc_id").isNull(), text).alias("mark"), text.alias("text"),
    )
    found = repeated_runs(texts.select("doc", "mark", "text"))
    found = found.groupBy("doc", "mark").agg(F.collect_set(F.struct("begin", "end")).alias("found"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.join(found, ["doc", "mark"], "left").select("doc_id", "text", "found").mapInArrow(
        cut_out, f"doc_id {kind}, n_words long, runs array<struct<begin: int, end: int>>, kept binary"
    )
