"""Repeated passages removed by suffix arrays, exactly and across the whole corpus.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts anywhere else.
No machine can sort all suffixes, and most need no sorting: only places where the corpus
repeats at all can matter.

1. *Anchors.* Of every ``LENGTH`` bytes the smallest hash of ``GRAM`` bytes within them is
   its anchor (winnowing). Equal strings have equal anchors at the same place, so an
   anchor that occurs once has no repeats. The strings of an anchor start side by side;
   what they cover is its window.
2. *Equal windows* are repeats as a whole; of each kind one stays as a partner.
   A window of which no core, the part common to some of its strings, occurs again is
   left out.
3. *Shards.* Windows with the same anchor meet in one shard. Its suffix array is built by
   induced sorting, and suffixes whose permuted common prefixes reach ``LENGTH`` are
   repeats. The windows of an anchor that has too many for one shard are dealt into
   chunks; the chunks' distinct strings meet by hash, packed, and each chunk learns which
   of its strings are repeats.
4. Spans of each document are merged and cut out.

Anchors, windows and spans are spread by hash; nothing is gathered per document but its
own spans, and nothing is collected.

Edge cases: a null text is empty. Rows with one ``doc_id`` and the same text are repeats
of each other; rows with one ``doc_id`` and different texts are told apart by the text.
Long texts are searched whole, in parts that overlap by a string. Which of several equal
windows is kept as the partner makes no difference. Other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.llm.common import release, stored
from obs_engine.llm.sais import permuted_lcp, suffix_array
from obs_engine.llm.textvec import BASE, chunks, flat, mix, powers, prefix_hash

LENGTH, GRAM = 400, 128
SIDE = LENGTH - GRAM
#: Offsets that share a core.
CORE = 68
#: Bytes of windows in one suffix array; more windows of one anchor than CROWD are chunked.
SHARD, CROWD = 1 << 20, 1500
CHUNK_WINDOWS, BUCKET_STRINGS = 1024, 200_000
#: Bytes of texts searched at once; a longer text is searched in parts.
PART = 1 << 18
#: Rows of a batch held as Python objects at once.
SLICE = 500
PLACE = [("doc", pa.int64()), ("mark", pa.int64())]
ANCHOR = [*PLACE, ("begin", pa.int32()), ("lead", pa.int32()), ("size", pa.int32()), ("gram", pa.int64()), ("near", pa.int64())]
CUT = [*ANCHOR, ("copies", pa.int64()), ("bytes", pa.binary()), ("cores", pa.list_(pa.int64()))]
SPAN = [*PLACE, ("begin", pa.int32()), ("end", pa.int32())]


def ddl(fields) -> str:
    names = {"int64": "long", "int32": "int", "binary": "binary", "list<item: int64>": "array<long>"}
    return ", ".join(f"{n} {names[str(t)]}" for n, t in fields)


def batch_of(fields, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            yield batch.slice(i, SLICE)


def anchors_in(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a run of texts that begin at ``at``, their strings' first and last starts, and prefix hashes."""
    p = prefix_hash(data)
    n = len(data) - LENGTH + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return none, none, none, p
    _, down = powers(len(data) + 1)
    h = mix((p[GRAM:] - p[:-GRAM]) * down[: len(data) - GRAM + 1])
    place = np.uint64((1 << 24) - 1)
    key = (h & ~place) | np.arange(len(h), dtype=np.uint64)
    # Smallest key of each w in a row: from the ends of blocks of w.
    w = SIDE + 1
    rows = -(-len(key) // w)
    grid = np.full(rows * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    grid[: len(key)] = key
    grid = grid.reshape(rows, w)
    up = np.minimum.accumulate(grid, 1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].reshape(-1)
    low = np.minimum(back[:n], up[w - 1 : w - 1 + n])
    # Strings over the end of a text are none.
    over = np.zeros(len(data) + 1, np.int32)
    np.add.at(over, np.maximum(at[1:] - LENGTH + 1, at[:-1]), 1)
    np.add.at(over, at[1:], -1)
    start = np.flatnonzero(np.cumsum(over)[:n] == 0)
    if not len(start):
        return none, none, none, p
    anchor = (low[start] & place).astype(np.int64)
    edge = np.flatnonzero(anchor[1:] != anchor[:-1])
    first, last = np.append(0, edge + 1), np.append(edge, len(start) - 1)
    return anchor[first], start[first], start[last], p


def parts_of(data: np.ndarray, at: np.ndarray):
    """``(first row, begin in it, bytes, offsets)``: many texts, or a part of one; each string once."""
    for a, b in chunks(at, PART):
        size = int(at[b] - at[a])
        if b == a + 1 and size > PART:
            for s in range(0, size - LENGTH + 1, PART - LENGTH + 1):
                end = min(s + PART, size)
                yield a, s, data[at[a] + s : at[a] + end], np.array([0, end - s])
        else:
            yield a, 0, data[at[a] : at[b]], at[a : b + 1] - at[a]


def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors with the windows of their strings."""
    for batch in batches:
        docs, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        data, at = flat(batch.column(2))
        for a, shift, part, ends in parts_of(data, at):
            pos, begin, last, p = anchors_in(part, ends)
            if not len(pos):
                continue
            end = last + LENGTH
            row = np.searchsorted(ends, begin, "right") - 1
            _, down = powers(len(part) + 1)
            gram = mix((p[pos + GRAM] - p[pos]) * down[pos])
            shape = ((pos - begin) * 1024 + end - begin).astype(np.uint64)
            near = mix((p[end] - p[begin]) * down[begin] * np.uint64(BASE) + shape)
            yield batch_of(ANCHOR, (
                docs[a + row], marks[a + row], (begin - ends[row] + shift).astype(np.int32), (pos - begin).astype(np.int32),
                (end - begin).astype(np.int32), gram.view(np.int64), near.view(np.int64),
            ))


def cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted windows of each text with their bytes and the hashes of their cores."""
    for batch in slices(batches):
        rows = []
        for doc, mark, text, found in zip(*(batch.column(i).to_pylist() for i in range(4))):
            text = text.encode()
            for w in found:
                data = text[w["begin"] : w["begin"] + w["size"]]
                x = np.frombuffer(data, np.uint8)
                p = prefix_hash(x)
                _, down = powers(len(x) + 1)
                # Offsets of the anchor in its strings, by CORE in a row.
                group = np.arange((w["lead"] - w["size"] + LENGTH) // CORE, w["lead"] // CORE + 1)
                b = w["lead"] - group * CORE
                core = mix((p[b + LENGTH - CORE + 1] - p[b]) * down[b] + group.astype(np.uint64))
                rows.append((doc, mark, w["begin"], w["lead"], w["size"], w["gram"], w["near"], w["copies"], data,
                             core.view(np.int64)))
            if len(rows) > 1000:
                yield batch_of(CUT, list(zip(*rows)))
                rows = []
        if rows:
            yield batch_of(CUT, list(zip(*rows)))


def joined_text(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows with 1 after each and 0 at the end, where each begins, and their sizes."""
    sizes = np.array([len(w) for w in windows])
    first = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    body = np.frombuffer(b"\0".join(windows), np.uint8)
    t = np.zeros(len(body) + 2, np.uint16)
    t[: len(body)] = body
    t[: len(body)] += 2
    t[first[1:] - 1] = t[-2] = 1
    return t, first, sizes


def repeats_in(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Starts of repeated strings in the joined windows, and where each window begins."""
    t, first, sizes = joined_text([r["bytes"] for r in rows])
    sa = suffix_array(t, 258)
    plcp = permuted_lcp(t, sa)
    row = np.repeat(np.arange(len(rows)), sizes + 1)
    row = np.append(row, len(rows) - 1)
    left = (first + sizes)[row] - np.arange(len(t))
    # Runs of suffixes with a common prefix of LENGTH bytes, of those that have as many.
    run = np.cumsum(np.concatenate(([True], plcp[sa[1:]] < LENGTH)))
    long = left[sa] >= LENGTH
    sa, run = sa[long], run[long]
    if not len(sa):
        return sa, first
    # A run is a repeat if it holds two places, or a place in a window that has copies.
    at = row[sa]
    mark = mix(np.array([r["mark"] for r in rows], np.int64).view(np.uint64) + mix(np.array([r["doc"] for r in rows], np.int64).view(np.uint64)))
    begin = np.array([r["begin"] for r in rows], np.int64)
    where = mix(mark[at] + (begin[at] + sa - first[at]).astype(np.uint64))
    copied = np.array([r["copies"] > 1 for r in rows])[at]
    edge = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
    several = np.minimum.reduceat(where, edge) != np.maximum.reduceat(where, edge)
    several |= np.logical_or.reduceat(copied, edge)
    return np.sort(sa[np.repeat(several, np.diff(np.append(edge, len(sa))))]), first


def merged(starts: np.ndarray) -> list[tuple[int, int]]:
    """Spans covered by strings of LENGTH bytes from the given starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > LENGTH)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + LENGTH).tolist()))


def sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows sorted by anchor: a suffix array over as many anchors as fit, and their spans."""
    rows, size, gram = [], 0, None

    def flush():
        starts, first = repeats_in(rows)
        at = np.append(np.searchsorted(starts, first), len(starts))
        out = [
            (r["doc"], r["mark"], r["begin"] + b, r["begin"] + e)
            for i, r in enumerate(rows)
            for b, e in merged(starts[at[i] : at[i + 1]] - first[i])
        ]
        return batch_of(SPAN, list(zip(*out)) or [()] * 4)

    for batch in slices(batches):
        for row in batch.to_pylist():
            if row["gram"] != gram and size >= SHARD:
                yield flush()
                rows, size = [], 0
            gram = row["gram"]
            rows.append(row)
            size += len(row["bytes"])
    if rows:
        yield flush()


def strings_of(windows) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every string of LENGTH bytes of each window, and how many each has."""
    out, n = [], []
    for data in windows:
        x = np.frombuffer(data, np.uint8)
        p, q = prefix_hash(x), prefix_hash(x ^ np.uint8(0x5A))
        _, down = powers(len(x) + 1)
        k = len(x) - LENGTH + 1
        one = mix((p[LENGTH:] - p[:k]) * down[:k])
        two = mix(((q[LENGTH:] - q[:k]) * down[:k]) ^ np.uint64(BASE))
        out.append(np.stack((one, two), 1)), n.append(k)
    return np.ascontiguousarray(np.concatenate(out)).view("u8,u8").reshape(-1), np.array(n)


def ask(buckets: int):
    """A chunk's distinct strings with their number, packed by bucket."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        strings, n = strings_of(rows["bytes"])
        names, at = np.unique(strings, return_inverse=True)
        count = np.bincount(at, np.repeat(rows["copies"].to_numpy(), n)).astype("<i8")
        bucket = (names["f0"] >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(np.diff(bucket[order])) + 1
        groups = np.split(order, cut)
        return pd.DataFrame({
            "bucket": [int(bucket[g[0]]) for g in groups], "chunk": int(rows["chunk"].iloc[0]),
            "strings": [names[g].tobytes() for g in groups], "counts": [count[g].tobytes() for g in groups],
        })

    return run


def answer(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the strings of one bucket, those that occur more than once, back to each chunk."""
    each = [np.frombuffer(s, "u8,u8") for s in rows["strings"]]
    names, at = np.unique(np.concatenate(each), return_inverse=True)
    often = np.bincount(at, np.concatenate([np.frombuffer(c, "<i8") for c in rows["counts"]])) > 1
    parts = np.split(often[at], np.cumsum([len(x) for x in each])[:-1])
    return pd.DataFrame({"chunk": rows["chunk"], "repeats": [x[keep].tobytes() for x, keep in zip(each, parts)]})


def answered(windows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    if not len(windows):
        return pd.DataFrame({"doc": [], "mark": [], "begin": [], "end": []})
    strings, n = strings_of(windows["bytes"])
    known = np.concatenate([np.frombuffer(x, "u8,u8") for x in answers["repeats"]] or [strings[:0]])
    hit = np.isin(strings, known)
    ends = np.cumsum(n)
    out = [
        (doc, mark, begin + b, begin + e)
        for doc, mark, begin, a, z in zip(windows["doc"], windows["mark"], windows["begin"], ends - n, ends)
        for b, e in merged(np.flatnonzero(hit[a:z]))
    ]
    return pd.DataFrame(out, columns=["doc", "mark", "begin", "end"])


def crowded(many: DataFrame) -> DataFrame:
    """Spans of the windows of anchors that have too many of them for one shard."""
    chunks_ = F.ceil(F.col("windows") / CHUNK_WINDOWS)
    chunk = F.xxhash64("gram", F.pmod(F.xxhash64("doc", "mark", "begin"), chunks_)).alias("chunk")
    many = stored(many.select("doc", "mark", "begin", "copies", "bytes", "size", chunk), "crowds")
    total = many.agg(F.sum(F.col("size") - LENGTH + 1)).first()[0] or 0
    if not total:
        return many.select("doc", "mark", "begin", F.col("begin").alias("end"))
    asked = many.groupBy("chunk").applyInPandas(
        ask(max(1, -(-total // BUCKET_STRINGS))), "bucket long, chunk long, strings binary, counts binary"
    )
    answers = asked.groupBy("bucket").applyInPandas(answer, "chunk long, repeats binary")
    return many.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(answered, ddl(SPAN))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``(doc, mark, begin, end)``: spans of repeats, overlapping, of ``texts(doc, mark, text)``."""
    found = stored(texts.mapInArrow(find_anchors, ddl(ANCHOR)), "anchors")
    # Stored, so that the joins have shuffles on both sides and Spark splits a hot anchor.
    grams = stored(
        found.groupBy("gram").agg(F.count("*").alias("n"), F.min("near").alias("a"), F.max("near").alias("b"))
        .where("n > 1").select("gram", (F.col("a") != F.col("b")).alias("mixed")), "grams",
    )
    twice = stored(found.join(grams, "gram"), "repeated_anchors")
    release(found)
    mixed = twice.where("mixed")
    kinds = stored(mixed.groupBy("gram", "near").agg(F.count("*").alias("copies")), "kinds")
    span = ["doc", "mark", "begin", (F.col("begin") + F.col("size")).alias("end")]
    whole = twice.where("not mixed").select(*span).union(
        mixed.join(kinds.where("copies > 1"), ["gram", "near"], "left_semi").select(*span)
    )
    # Of each distinct window of an anchor that has several, one.
    order = Window.partitionBy("gram", "near").orderBy("doc", "mark", "begin")
    one = mixed.withColumn("_r", F.row_number().over(order)).where("_r = 1").join(kinds, ["gram", "near"])
    wanted = one.groupBy("doc", "mark").agg(F.collect_list(F.struct("begin", "lead", "size", "gram", "near", "copies")).alias("found"))
    windows = stored(
        texts.join(wanted, ["doc", "mark"]).select("doc", "mark", "text", "found").mapInArrow(cut_windows, ddl(CUT)), "windows"
    )
    cores = windows.select("gram", "near", "copies", F.explode("cores").alias("core")).distinct()
    again = cores.groupBy("core").agg(F.sum("copies").alias("n")).where("n > 1").select("core")
    useful = stored(cores.join(again, "core", "left_semi").select("gram", "near").distinct(), "useful")
    crowds = useful.groupBy("gram").agg(F.count("*").alias("windows"))
    kept = stored(windows.drop("cores").join(useful, ["gram", "near"], "left_semi").join(crowds, "gram"), "shard_windows")
    release(windows)
    few = kept.where(F.col("windows") <= CROWD)
    arrays = (
        few.select("doc", "mark", "begin", "gram", "near", "copies", "bytes")
        .repartition("gram").sortWithinPartitions("gram", "near").mapInArrow(sort_shards, ddl(SPAN))
    )
    return whole.union(arrays).union(crowded(kept.where(F.col("windows") > CROWD)))


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        size, spans, kept = [], [], []
        for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = text.encode()
            out: list[list[int]] = []
            for s in sorted(found or [], key=lambda s: s["begin"]):
                if out and s["begin"] <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], s["end"])
                else:
                    out.append([s["begin"], s["end"]])
            edges = [0, *(x for s in out for x in s), len(data)]
            size.append(len(data))
            spans.append([{"begin": b, "end": e} for b, e in out])
            kept.append(b"".join(data[b:e] for b, e in zip(edges[::2], edges[1::2])))
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` per row of ``docs(doc_id, text)``; spans are in bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc"),
        F.xxhash64(F.col("doc_id").isNull(), text).alias("mark"), text.alias("text"),
    )
    spans = stored(repeated_spans(texts.select("doc", "mark", "text")), "spans")
    found = spans.groupBy("doc", "mark").agg(F.collect_set(F.struct("begin", "end")).alias("found"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.join(found, ["doc", "mark"], "left").select("doc_id", "text", "found").mapInArrow(
        cut_out, f"doc_id {kind}, n_bytes long, spans array<struct<begin: int, end: int>>, kept binary"
    )
