"""Nearest neighbours by collision counting over query-aware projections.

Largest inner products become smallest distances: every vector x gets one more component,
sqrt(M^2 - |x|^2) with M the largest norm, queries get 0. The vectors are dealt by hash
into blocks of about ``BLOCK``; each block's index is ``PROJECTIONS`` arrays, the block's
projections on single random lines in sorted order. A query is projected on the same
lines. Around its projections windows are opened in every array and widened together by
a fixed ratio (virtual rehashing); a vector collides in an array when the window reaches
it. Vectors that collide in at least ``ALPHA`` of the arrays are candidates. With 64
components only wide windows tell near from far, so they open wide, and what is counted
is the fewer vectors that they have not reached. Windows stop when a block has candidates
for ``k``, ``SPARE`` more and the share ``BETA`` of its vectors; the candidates are
verified by exact inner products of the original vectors.

Every block is searched by every query, queries in packs; a group holds one block and one
pack, whatever the table's size. The best ``k`` of each block are merged by rank.

Edge cases: rows without id, and vectors that are null, zero, hold null or non-finite
components, take no part. Vectors of one length are searched among themselves, since
those of different lengths have no product. Equal rows count once. With fewer than ``k``
other vectors all are returned. Equal products are ordered by id. Very long vectors are
searched like short ones; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.llm.common import stored

BLOCK, PACK = 8192, 16_384
PROJECTIONS, ALPHA, BETA, SPARE = 128, 0.92, 0.05, 300
#: Half the first window's width, for vectors scaled to a largest norm of 1.
FIRST_WIDTH, RATIO = 1.5, 1.06
INDEX = "dims int, block int, packs int, ids binary, vectors binary, lines binary, places binary"


def usable(vector: str) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & whole & F.exists(vector, lambda x: x != 0)


def directions(dims: int) -> np.ndarray:
    return np.random.default_rng(dims).standard_normal((dims, PROJECTIONS)).astype(np.float32)


def build(double: bool):
    """One block's sorted projections, beside its vectors as they are."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["vector"].to_numpy()).astype("<f8" if double else "<f4")
        top = float(rows["top"].iloc[0])
        rest = np.sqrt(np.maximum(1 - ((x.astype(np.float64) / top) ** 2).sum(1), 0))
        p = np.column_stack((x / top, rest)).astype(np.float32) @ directions(x.shape[1] + 1)
        order = np.argsort(p, 0, kind="stable").astype(np.int32)
        return pd.DataFrame({
            "dims": [x.shape[1]], "block": [int(rows["block"].iloc[0])], "packs": [int(rows["packs"].iloc[0])], "ids": [rows["id"].to_numpy("<i8").tobytes()], "vectors": [x.tobytes()],
            "lines": [np.ascontiguousarray(np.take_along_axis(p, order, 0).T).tobytes()],
            "places": [np.ascontiguousarray(order.T).tobytes()],
        })

    return run


def candidates(q: np.ndarray, lines: np.ndarray, places: np.ndarray, want: int, width: float) -> tuple[list[np.ndarray], float]:
    """For each projected query the rows of a block that collide with it often enough, and the usual width.

    Windows open at ``width``; counting what they miss costs the less, the wider they open.
    """
    n = lines.shape[1]
    spare = PROJECTIONS - int(np.ceil(ALPHA * PROJECTIONS))  # arrays that may not collide
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(q)
    missed = [np.zeros(n, np.int64)] * len(q)
    low = high = None
    live, widths = np.arange(len(q)), np.zeros(len(q))
    while len(live):
        lo = np.stack([np.searchsorted(s, x - width, "left") for s, x in zip(lines, q[live].T)], 1)
        hi = np.stack([np.searchsorted(s, x + width, "right") for s, x in zip(lines, q[live].T)], 1)
        on = np.ones(len(live), bool)
        for i, name in enumerate(live):
            if low is None:
                ring = [p[:a] for p, a in zip(places, lo[i])] + [p[b:] for p, b in zip(places, hi[i])]
                missed[name] = np.bincount(np.concatenate(ring), minlength=n)
            else:
                ring = [p[a:b] for p, a, b in zip(places, lo[i], low[i])] + [p[a:b] for p, a, b in zip(places, high[i], hi[i])]
                missed[name] -= np.bincount(np.concatenate(ring), minlength=n)
            found = np.flatnonzero(missed[name] <= spare)
            if len(found) >= want:
                out[name], on[i], widths[name] = found, False, width
        low, high, live = lo[on], hi[on], live[on]
        width *= RATIO
    return out, float(np.median(widths))


def search(k: int, double: bool):
    """All queries of one pack in one block."""

    def run(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "query": [], "vec_id": [], "score": []}
        if len(queries) and len(index):
            ids = np.frombuffer(index["ids"].iloc[0], "<i8")
            x = np.frombuffer(index["vectors"].iloc[0], "<f8" if double else "<f4").reshape(len(ids), -1)
            lines = np.frombuffer(index["lines"].iloc[0], np.float32).reshape(PROJECTIONS, -1)
            places = np.frombuffer(index["places"].iloc[0], np.int32).reshape(PROJECTIONS, -1)
            want = min(len(ids), k + 1 + SPARE + int(BETA * len(ids)))
            original = np.stack(queries["vector"].to_numpy()).astype(np.float64)
            # The extra component of a query is 0; its length doesn't matter to the order.
            unit = original / np.sqrt((original**2).sum(1, keepdims=True))
            projected = unit.astype(np.float32) @ directions(x.shape[1] + 1)[:-1]
            # The first queries tell how wide windows get in this block; the others open them there.
            found, width = [], FIRST_WIDTH
            while len(found) < len(projected):
                part = projected[len(found) : len(found) + (64 if found else 8)]
                some, usual = candidates(part, lines, places, want, width)
                found += some
                width = max(FIRST_WIDTH, usual / RATIO)
            for name, mark, q, c in zip(queries["id"], queries["query"], original, found):
                c = c[ids[c] != name]
                score = (x[c].astype(np.float64) * q).sum(1)
                best = np.lexsort((ids[c], -score))[:k]
                out["query_id"] += [name] * len(best)
                out["query"] += [mark] * len(best)
                out["vec_id"] += ids[c][best].tolist()
                out["score"] += score[best].tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "query": "int64", "vec_id": "int64", "score": "float64"})

    return run


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for rows where ``queries`` holds, their ``k`` nearest others."""
    double = "double" in vectors.schema[vector].dataType.simpleString()
    good = vectors.where(F.col(id).isNotNull() & usable(vector)).select(
        F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    ).dropDuplicates(["id", "vector"])
    # Scaled by the largest component first: squares of very large or small numbers are no numbers.
    most = F.array_max(F.transform("vector", F.abs))
    norm = most * F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / most) * (x / most)))
    good = stored(good.withColumn("norm", norm).withColumn("dims", F.size("vector")), "vectors")
    # Vectors of one length are a space of their own.
    spaces = good.groupBy("dims").agg(F.count("*").alias("n"), F.max("norm").alias("top"), F.count_if("asks").alias("q"))
    spaces = stored(spaces.select(
        "dims", "top", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.greatest(F.lit(1), F.ceil(F.col("q") / PACK)).cast("int").alias("packs")
    ), "spaces")
    good = good.join(spaces, "dims")
    mark = F.xxhash64("id", "vector")
    block = F.pmod(mark, F.col("blocks")).cast("int").alias("block")
    index = stored(good.select("id", "vector", "top", "dims", block, "packs").groupBy("dims", "block").applyInPandas(build(double), INDEX), "index")
    pack = F.pmod(F.xxhash64(F.lit(1), mark), F.col("packs")).cast("int").alias("pack")
    asked = good.where("asks").select("id", "vector", mark.alias("query"), pack, "dims", "blocks")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    index = index.withColumn("pack", F.explode(F.sequence(F.lit(0), F.col("packs") - 1)))
    by = ["dims", "block", "pack"]
    found = (
        asked.groupBy(*by).cogroup(index.groupBy(*by))
        .applyInPandas(search(k, double), "query_id long, query long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
