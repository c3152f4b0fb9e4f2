"""Ranked lexical search by pair-bound MaxScore.

The index is a stored table of blocks: each holds the postings of some thousand documents,
sorted by term. A block is made by the task that reads its documents, so the whole index
takes no shuffle. Document counts, lengths and document frequencies are sums over the
blocks.

For a set of queries, a pack, the index is *prepared*: for every block the impacts of the
pack's terms with their maxima, and for the pairs of each query's terms, heaviest first,
the intersection list with its joint maximum and its best joint impacts. The best joint
impacts of all blocks give each query a score that ``k`` documents reach: its first
threshold.

A block is searched query by query. MaxScore leaves out the lists whose maxima together
stay below the threshold, because a document with no other term cannot be among the best.
Here lists are taken two at a time: a pair adds at most its joint maximum or the larger of
its two maxima, which is less than their sum, so more lists are left out. Candidates are
the documents of the other lists. They meet the pairs left out in order of falling bound
and go as soon as what they have and all remaining bounds do not reach the threshold; a
document's bound for the next pair is the joint maximum if it stands in the intersection
list, else the larger single maximum. Thresholds rise over the blocks of a task. What is
dropped is strictly below a score that ``k`` documents have, so results are exact.

A pack has at most ``PACK_TERMS`` query terms; packs are searched one after the other over
blocks that lie still. The best ``k`` of each task are merged by rank.

Edge cases: null and empty texts have no terms and are no documents of the statistics. A
row is a document: rows with one ``doc_id`` are ranked each for itself, and rows without
``doc_id`` come last among equal scores. Items of one ``item_id`` and equal terms count
once; of different terms, they are ranked each for itself. A repeated word of an item counts once. A long text is one document of one block.
Other columns are not read. With an empty table on either side there are no rows. Terms
are compared as 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.llm.common import stored
from obs_engine.llm.textvec import chunks, flat, lower_table, mix, powers, prefix_hash, spans

#: Documents and postings at which a block is closed.
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 4_000_000
#: Query terms of one pack.
PACK_TERMS = 200_000
NO_ID = np.iinfo(np.int64).max
BLOCK = "n_docs long, n_tokens long, doc_ids binary, lengths binary, terms array<long>, dfs array<int>, docs binary, tfs binary"
PREPARED = (
    "doc_ids binary, terms array<int>, ends binary, docs binary, impacts binary, tops binary, "
    "pairs array<int>, joint binary, list_ends binary, lists binary, best array<array<long>>"
)


def in_word() -> np.ndarray:
    """Whether a byte is part of a word: digits, ASCII letters, and all bytes from 0x80."""
    ok = np.ones(256, bool)
    for low, high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        ok[low : high + 1] = False
    return ok


def term_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, A-Z lower-cased, and each text's first."""
    begin, end, first = spans(in_word()[data], at)
    p = prefix_hash(lower_table()[data])
    _, down = powers(len(data) + 1)
    return mix((p[end] - p[begin]) * down[begin] + (end - begin).astype(np.uint64)), first


def counted(terms: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(term, row, tf)`` sorted by term, then row."""
    row = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
    order = np.argsort(terms, kind="stable")  # rows ascend already
    t, r = terms[order], row[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (r[1:] != r[:-1])
    edge = np.flatnonzero(new)
    return t[edge], r[edge], np.diff(np.append(edge, len(t))).astype(np.int32)


def block_of(parts: list[tuple]) -> pa.RecordBatch:
    """One block from the counted texts of several chunks."""
    ids = np.concatenate([p[0] for p in parts])
    lengths = np.concatenate([p[1] for p in parts])
    shift = np.cumsum([0] + [len(p[0]) for p in parts[:-1]])
    t = np.concatenate([p[2] for p in parts])
    r = np.concatenate([p[3] + s for p, s in zip(parts, shift)]).astype("<i4")
    tf = np.concatenate([p[4] for p in parts])
    if len(parts) > 1:
        order = np.argsort(t, kind="stable")
        t, r, tf = t[order], r[order], tf[order]
    edge = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1]))) if len(t) else np.empty(0, np.int64)
    df = np.diff(np.append(edge, len(t))).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
         pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([lengths.astype("<i8").tobytes()], pa.binary()),
         pa.ListArray.from_arrays(pa.array([0, len(edge)], pa.int32()), pa.array(t[edge].view(np.int64))),
         pa.ListArray.from_arrays(pa.array([0, len(edge)], pa.int32()), pa.array(df)),
         pa.array([r.tobytes()], pa.binary()), pa.array([tf.astype("<i4").tobytes()], pa.binary())],
        names=["n_docs", "n_tokens", "doc_ids", "lengths", "terms", "dfs", "docs", "tfs"],
    )


def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents ``(doc_id, text)`` to blocks of postings."""
    parts, n, postings = [], 0, 0
    for batch in batches:
        ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        data, at = flat(batch.column(1))
        for a, b in chunks(at):
            terms, first = term_hashes(data[at[a] : at[b]], at[a : b + 1] - at[a])
            t, r, tf = counted(terms, first)
            if n and (n + b - a > BLOCK_DOCS or postings + len(t) > BLOCK_POSTINGS):
                yield block_of(parts)
                parts, n, postings = [], 0, 0
            for x in range(0, b - a, BLOCK_DOCS) if b - a > BLOCK_DOCS else ():
                own = (r >= x) & (r < x + BLOCK_DOCS)
                some = slice(x, min(x + BLOCK_DOCS, b - a))
                yield block_of([(ids[a:b][some], np.diff(first)[some], t[own], r[own] - x, tf[own])])
            if b - a <= BLOCK_DOCS:
                parts.append((ids[a:b], np.diff(first), t, r, tf))
                n, postings = n + b - a, postings + len(t)
    if parts:
        yield block_of(parts)


def item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(item_id, item, terms)``: the distinct terms of each item, and a name for them with the id."""
    for batch in batches:
        data, at = flat(batch.column(1))
        terms, first = term_hashes(data, at)
        each = [np.unique(terms[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:])]
        kept = [i for i, x in enumerate(each) if len(x)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(kept, pa.int64())), pa.array([each[i].tolist() for i in kept], pa.list_(pa.int64()))],
            names=["item_id", "terms"],
        )


class Pack:
    """Queries of one pack: their terms by number, weights, and term pairs."""

    def __init__(self, rows: list):
        by_item: dict[int, list[tuple[int, int]]] = {}
        for r in rows:
            by_item.setdefault(r["item"], []).append((r["w"], r["term"]))
        self.names = list(by_item)
        self.terms = np.unique(np.array([r["term"] for r in rows], np.int64).view(np.uint64))
        self.weights = np.zeros(len(self.terms), np.int64)
        number = {int(t): i for i, t in enumerate(self.terms.view(np.int64))}
        pairs: dict[tuple[int, int], int] = {}
        #: Per query its pairs, heaviest first; a term left alone is a pair with itself.
        self.queries: list[list[int]] = []
        for heavy in by_item.values():
            heavy.sort(key=lambda x: (-x[0], x[1]))
            for w, t in heavy:
                self.weights[number[t]] = w
            own = [number[t] for _, t in heavy]
            both = [tuple(sorted((a, b))) for a, b in zip(own[::2], own[1::2])] + ([(own[-1],) * 2] if len(own) % 2 else [])
            self.queries.append([pairs.setdefault(p, len(pairs)) for p in both])
        self.pairs = np.array(list(pairs), np.int32).reshape(-1, 2)


def preparer(pack: Pack, docs: int, tokens: int, k: int):
    """Blocks with the impacts of the pack's terms and the intersection lists of its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lengths, own_docs, tfs = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in ((1, "<i8"), (4, "<i4"), (5, "<i4")))
                terms = batch.column(2)[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                dfs = batch.column(3)[i].values.to_numpy(zero_copy_only=False)
                ends = np.cumsum(dfs, dtype=np.int64)
                at = np.searchsorted(terms, pack.terms)
                held = np.flatnonzero(terms[np.minimum(at, len(terms) - 1)] == pack.terms) if len(terms) else np.empty(0, np.int64)
                # A document's length against the mean, in hundredths; without tokens none is asked.
                m = 10 + (90 * lengths * docs) // max(tokens, 1)
                lists, impacts, tops = [], [], []
                for t in held:
                    own = slice(ends[at[t]] - dfs[at[t]], ends[at[t]])
                    d, tf = own_docs[own], tfs[own].astype(np.int64)
                    x = pack.weights[t] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[d]))
                    lists.append(d), impacts.append(x), tops.append(int(x.max()))
                place = {int(t): n for n, t in enumerate(held)}
                seen = [j for j, (a, b) in enumerate(pack.pairs) if a in place or b in place]
                joint, members, best = [], [], []
                dense = np.zeros(len(lengths), np.int64)
                for j in seen:
                    a, b = (place.get(int(x)) for x in pack.pairs[j])
                    both, joint_top = np.empty(0, "<i4"), 0
                    if a is None or b is None or a == b:
                        top = impacts[b if a is None else a]
                    else:
                        dense[lists[a]] = impacts[a]
                        with_b = dense[lists[b]]
                        dense[lists[a]] = 0
                        inside = with_b > 0
                        both, top = lists[b][inside], with_b[inside] + impacts[b][inside]
                        joint_top = int(top.max(initial=0))
                        if len(top) < k:
                            # Other documents score at least what the stronger term alone gives them.
                            strong = a if tops[a] >= tops[b] else b
                            top = np.concatenate((top, impacts[strong][~np.isin(lists[strong], both)]))
                    joint.append(joint_top)
                    members.append(both)
                    best.append(np.sort(top)[::-1][:k].tolist())
                cat = lambda x, t: np.concatenate([np.empty(0, t), *x]).astype(t).tobytes()
                count = lambda x: np.cumsum([0] + [len(y) for y in x]).astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([held.tolist()], pa.list_(pa.int32())), pa.array([count(lists)], pa.binary()),
                     pa.array([cat(lists, "<i4")], pa.binary()), pa.array([cat(impacts, "<i8")], pa.binary()),
                     pa.array([np.array(tops, "<i8").tobytes()], pa.binary()), pa.array([seen], pa.list_(pa.int32())),
                     pa.array([np.array(joint, "<i8").tobytes()], pa.binary()), pa.array([count(members)], pa.binary()),
                     pa.array([cat(members, "<i4")], pa.binary()), pa.array([best], pa.list_(pa.list_(pa.int64())))],
                    names=["doc_ids", "terms", "ends", "docs", "impacts", "tops", "pairs", "joint", "list_ends", "lists", "best"],
                )

    return run


class Block:
    """A prepared block in memory."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["doc_ids"], "<i8")
        ends, docs, impacts = (np.frombuffer(row[c], t) for c, t in (("ends", "<i8"), ("docs", "<i4"), ("impacts", "<i8")))
        tops = np.frombuffer(row["tops"], "<i8")
        self.lists = {t: (docs[a:b], impacts[a:b], int(x)) for t, a, b, x in zip(row["terms"], ends, ends[1:], tops)}
        ends, lists = np.frombuffer(row["list_ends"], "<i8"), np.frombuffer(row["lists"], "<i4")
        joint = np.frombuffer(row["joint"], "<i8")
        self.pairs = {p: (int(x), lists[a:b]) for p, x, a, b in zip(row["pairs"], joint, ends, ends[1:])}


def contains(sorted_: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each asked document stands in a sorted list, and where."""
    if not len(sorted_):
        return np.zeros(len(asked), bool), np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(sorted_, asked), len(sorted_) - 1)
    return sorted_[at] == asked, at


def best_of(block: Block, pairs: list[tuple[int, tuple[int, int]]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block, and their scores, that reach ``least`` (at least 1) for a query's pairs."""
    parts = []
    for number, (a, b) in pairs:
        if number not in block.pairs:
            continue
        joint, both = block.pairs[number]
        lists = [block.lists[t] for t in ((a, b) if a != b else (a,)) if t in block.lists]
        single = max(x[2] for x in lists)
        parts.append((max(joint, single), joint, single, both, lists))
    parts.sort(key=lambda x: x[0])
    bounds = np.cumsum([0] + [p[0] for p in parts])
    # The longest run of pairs from the weakest whose bounds together stay below the threshold.
    left_out = int(np.searchsorted(bounds[1:], least, "left"))
    score = np.zeros(len(block.ids), np.int64)
    for _, _, _, _, lists in parts[left_out:]:
        for docs, impacts, _ in lists:
            score[docs] += impacts
    found = np.flatnonzero(score)
    score = score[found]
    for i in range(left_out - 1, -1, -1):
        keep = score + bounds[i + 1] >= least
        found, score = found[keep], score[keep]
        _, joint, single, both, lists = parts[i]
        in_both, _ = contains(both, found)
        keep = score + np.where(in_both, joint, single) + bounds[i] >= least
        found, score = found[keep], score[keep]
        for docs, impacts, _ in lists:
            has, at = contains(docs, found)
            score = score + np.where(has, impacts[at] if len(impacts) else 0, 0)
    keep = score >= max(least, 1)
    return found[keep], score[keep]


def searcher(pack: Pack, least: dict[int, int], k: int):
    """The best of each task's blocks for every query of the pack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [[(p, tuple(pack.pairs[p])) for p in q] for q in pack.queries]
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(queries)
        bar = [max([1, *(least.get(p, 0) for p in q)]) for q in pack.queries]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                for q, pairs in enumerate(queries):
                    found, score = best_of(block, pairs, bar[q])
                    if not len(found):
                        continue
                    ids, score = np.concatenate((best[q][0], block.ids[found])), np.concatenate((best[q][1], score))
                    order = np.lexsort((ids, -score))[:k]
                    best[q] = ids[order], score[order]
                    if len(order) == k:
                        bar[q] = max(bar[q], int(best[q][1][-1]))
        n = [len(x[0]) for x in best]
        ids = np.concatenate([np.empty(0, np.int64), *(x[0] for x in best)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(pack.names, np.int64), n), pa.int64()), pa.array(ids, pa.int64(), mask=ids == NO_ID),
             pa.array(np.concatenate([np.empty(0, np.int64), *(x[1] for x in best)]), pa.int64())],
            names=["item", "doc_id", "score"],
        )

    return run


class Index:
    """Stored blocks of postings of ``docs(doc_id, text)`` with their counts."""

    def __init__(self, docs: DataFrame):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.blocks = stored(rows.mapInArrow(invert, BLOCK), "blocks")
        n = self.blocks.agg(F.sum("n_docs").alias("docs"), F.sum("n_tokens").alias("tokens")).first()
        self.docs, self.tokens = n["docs"] or 0, n["tokens"] or 0

    def weights(self, terms: DataFrame) -> DataFrame:
        """``terms(term)`` that occur, with the weight of their document frequency."""
        per_block = self.blocks.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).select("x.terms", "x.dfs")
        df = per_block.join(terms.select(F.col("term").alias("terms")).distinct(), "terms").groupBy("terms").agg(F.sum("dfs").alias("df"))
        w = F.floor(1000 * F.log((F.lit(2 * self.docs + 2)).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
        return df.select(F.col("terms").alias("term"), w.alias("w")).where("w > 0")

    def prepare(self, pack: Pack, k: int) -> tuple[DataFrame, dict[int, int]]:
        """The stored lists of a pack, and for its pairs the k-th best score over all blocks."""
        ready = stored(self.blocks.select("doc_ids", "lengths", "terms", "dfs", "docs", "tfs").mapInArrow(
            preparer(pack, self.docs, self.tokens, k), PREPARED), "prepared")
        values = ready.select(F.explode(F.arrays_zip("pairs", "best")).alias("x")).select("x.pairs", F.explode("x.best").alias("value"))
        order = Window.partitionBy("pairs").orderBy(F.desc("value"))
        kth = values.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).where(F.col("r") == k)
        return ready, {r["pairs"]: r["value"] for r in kth.select("pairs", "value").collect()}

    def search(self, items: DataFrame, k: int = 10) -> DataFrame:
        """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents."""
        spark = items.sparkSession
        kind = items.schema["item_id"].dataType.simpleString()
        asked = items.select("item_id", F.col("text").cast("string").alias("text")).mapInArrow(item_terms, f"item_id {kind}, terms array<long>")
        asked = stored(asked.distinct().withColumn("item", F.xxhash64(F.col("item_id").isNull(), "item_id", "terms")), "items")
        terms = asked.select("item", F.explode("terms").alias("term"))
        weighed = stored(terms.join(self.weights(terms), "term").select("item", "term", "w"), "weights")
        packs = max(1, math.ceil(weighed.count() / PACK_TERMS))
        schema = "item long, doc_id long, score long"
        found = spark.createDataFrame([], schema)
        for i in range(packs):
            rows = weighed.where(F.pmod(F.xxhash64("item", F.lit(packs)), F.lit(packs)) == i).collect()
            if rows:
                pack = Pack(rows)
                ready, least = self.prepare(pack, k)
                found = found.union(ready.mapInArrow(searcher(pack, least, k), schema))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
