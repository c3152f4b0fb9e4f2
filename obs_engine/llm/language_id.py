"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed byte trigrams of its lower-cased letters, weighted by
1 + ln(count) and inverse document frequency and normalised. The labelled texts of each
language are clustered (spherical k-means) into a few centroids; a text gets the
language of the centroid with the largest cosine. A text whose cosine stays below two
fifths of what nearly all training texts of its length and predicted language reach is
rejected: it is far from every centroid. Lengths shorter than those of the training texts
take the bound of longer ones, less by the root of the length.

Document frequencies and bounds come from all training texts. Clustering uses a sample of about
``SAMPLE`` texts per language, chosen by hash. What reaches the driver is bounded by the
number of features and languages.

Edge cases: a null text, or one without a letter, is ``und`` with score 0 and rejected. One with a letter but without a
trigram says nothing of its language and is not rejected.
Without any training text all are ``und``. A row without ``doc_id`` is classified but
not learned from. Ties go to the language first in the alphabet.
Long texts are classified whole, repeated rows alike. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obs_engine.llm.common import trimmed
from obs_engine.llm.textvec import chunks, flat, lower_table

FEATURES = 1 << 13
SAMPLE, CLUSTERS, ROUNDS = 1500, 4, 12
#: Below this share of the training texts' low cosines a text is rejected.
REJECT = 0.4
LENGTHS = 24
#: The low quantile of cosines, steps of their histogram, and texts a length needs for a bound of its own.
LOW, STEPS, ENOUGH = 0.005, 1024, 20


def letters_table() -> np.ndarray:
    """Lower case for A-Z, a blank for other ASCII than letters."""
    t = lower_table()
    ascii_letters = np.zeros(256, bool)
    ascii_letters[97:123] = True
    ascii_letters[128:] = True
    t[~ascii_letters[t]] = 32
    return t


def grams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of hashed trigrams: a row for each text."""
    rows = len(at) - 1
    if len(data) < 3:
        return np.zeros((rows, FEATURES), np.float32)
    x = letters_table()[data].astype(np.uint32)
    gram = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    blank = x == 32
    # No gram over a text's end, around two blanks in a row, or of a single letter.
    good = ~((blank[:-2] & blank[1:-1]) | (blank[1:-1] & blank[2:]))
    row = np.repeat(np.arange(rows), np.diff(at))
    good &= row[:-2] == row[2:]
    feature = (gram[good] * np.uint32(2654435761)) >> np.uint32(32 - 13)
    cell = row[:-2][good] * FEATURES + feature
    return np.bincount(cell, minlength=rows * FEATURES).reshape(rows, FEATURES).astype(np.float32)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    norm = np.sqrt((v * v).sum(1, keepdims=True))
    return v / np.maximum(norm, 1e-12)


def length_class(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(1 + counts.sum(1)).astype(int), LENGTHS - 1)


def small_chunks(column: pa.Array):
    """``(first row, bytes, offsets)`` of at most 256 texts at a time."""
    data, at = flat(column)
    for a, b in chunks(at):
        for i in range(a, b, 256):
            j = min(b, i + 256)
            yield i, data[at[i] : at[j]], at[i : j + 1] - at[i]


def document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, n = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for _, data, at in small_chunks(batch.column(0)):
            df += (grams(data, at) > 0).sum(0)
            n += len(at) - 1
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, FEATURES), pa.int32()), pa.array(np.concatenate(([n], df)))], names=["feature", "n"]
        )


def cluster(idf: np.ndarray):
    """Centroids of one language."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", kind="stable")
        parts = [grams(d, a) for _, d, a in small_chunks(pa.array(rows["text"], pa.large_string()))]
        counts = np.concatenate(parts)
        v = weighted(counts, idf)
        # Centres begin far from each other.
        centres = [int(np.argmax(v @ v.mean(0)))]
        near = v @ v[centres[0]]
        for _ in range(min(CLUSTERS, len(v)) - 1):
            centres.append(int(np.argmin(near)))
            near = np.maximum(near, v @ v[centres[-1]])
        c = v[centres]
        for _ in range(ROUNDS):
            own = np.argmax(v @ c.T, 1)
            c = np.stack([v[own == k].sum(0) if (own == k).any() else c[k] for k in range(len(c))])
            c /= np.maximum(np.sqrt((c * c).sum(1, keepdims=True)), 1e-12)
        return pd.DataFrame({
            "lang": rows["lang"].iloc[0], "cluster": range(len(c)),
            "centroid": [x.astype("<f4").tobytes() for x in c],
        })

    return run


def cosines(shared, of: np.ndarray, langs: int):
    """Counts of training texts per predicted language, length class and step of the cosine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, centroids = shared.value
        shape = (langs, LENGTHS, STEPS + 1)
        n = np.zeros(shape, np.int64)
        for batch in batches:
            for _, data, at in small_chunks(batch.column(0)):
                counts = grams(data, at)
                cos = weighted(counts, idf) @ centroids
                step = np.clip(cos.max(1) * STEPS, 0, STEPS).astype(int)
                np.add.at(n, (of[np.argmax(cos, 1)], length_class(counts), step), 1)
        cell = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(n.reshape(-1)[cell])], names=["cell", "n"])

    return run


def bounds(n: np.ndarray) -> np.ndarray:
    """Least cosine of a text that stays, per language and length class."""

    def low(c: np.ndarray) -> np.ndarray:
        total, up = c.sum(1), c.cumsum(1)
        at = (up > (LOW * np.maximum(total - 1, 0))[:, None]).argmax(1) / STEPS
        at = np.where(total >= ENOUGH, at, np.nan)
        known = np.flatnonzero(np.isfinite(at))
        if not len(known):
            return at
        for k in range(known[0] + 1, LENGTHS):
            at[k] = at[k] if np.isfinite(at[k]) else at[k - 1]
        for k in range(known[0] - 1, -1, -1):
            at[k] = at[k + 1] / np.sqrt(2)
        return at

    # A language with too few texts of every length takes the bounds of all.
    pooled = low(n.sum(0))
    out = np.stack([x if np.isfinite(x).any() else pooled for x in map(low, n)])
    out = np.nan_to_num(out) * REJECT
    out[:, 0] = 0  # no trigram at all
    return out


def classifier(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, centroids, langs, low = shared.value
        for batch in batches:
            best, who, gone = [], [], []
            for _, data, at in small_chunks(batch.column(batch.num_columns - 2)):
                counts = grams(data, at)
                cos = weighted(counts, idf) @ centroids
                k = np.argmax(cos, 1)
                score = cos[np.arange(len(k)), k]
                best.append(score), who.append(k), gone.append(score < low[k, length_class(counts)])
            flat_ = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
            score, k, gone = flat_(best, float), flat_(who, int), flat_(gone, bool)
            lettered = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            names = [langs[i] if has else "und" for i, has in zip(k, lettered)]
            score = np.where(lettered, np.clip(score.astype(float), 0, 1), 0.0)
            carried = batch.schema.names[:-2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(names, pa.string()), pa.array(score), pa.array(gone | ~lettered)],
                names=[*carried, "lang_pred", "score", "rejected"],
            )

    return run


def remainder(doc_id: str, n: int) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def identify(docs: DataFrame, folds: int = 5, fold: int | None = 0) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, rejected)`` for every row of ``docs(doc_id, text, lang)``.

    Learns from rows with a ``lang`` whose ``crc32(doc_id)`` modulo ``folds`` is not
    ``fold`` (None: from all); only the text enters a prediction.
    """
    return _classified(docs.select("doc_id", "text", "lang"), ["doc_id"], folds, fold)


def recognised(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is recognised, all columns unchanged."""
    names = docs.columns
    plain = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(names)), "doc_id", "text", "lang")
    kept = _classified(plain, [f"_{i}" for i in range(len(names))], 5, None).where("not rejected")
    return kept.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(names)))


def _classified(docs: DataFrame, carried: list[str], folds: int, fold: int | None) -> DataFrame:
    spark = docs.sparkSession
    lettered = F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))
    held = F.lit(False) if fold is None else F.coalesce(remainder("doc_id", folds) == fold, F.lit(False))
    texts = docs.select(
        *carried, held.alias("held_out"), F.col("text").cast("string").alias("text"), lettered.alias("lettered")
    )
    train = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held.alias("held_out")
    ).where(lettered & ~F.col("held_out") & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return texts.select(
            *carried, "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")
        )
    counted = (
        train.select("text").mapInArrow(trimmed(document_frequencies), "feature int, n long")
        .groupBy("feature").agg(F.sum("n").alias("n"))
    )
    df = {r["feature"]: r["n"] for r in counted.collect()}
    idf = np.log((1 + df[-1]) / (1.0 + np.array([df[i] for i in range(FEATURES)]))).astype(np.float32) + np.float32(1)
    rates = [F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, SAMPLE / n))]
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = train.where(unit < F.element_at(F.create_map(*rates), F.col("lang"))).select("doc_id", "lang", "text")
    found = sample.groupBy("lang").applyInPandas(
        cluster(idf), "lang string, cluster int, centroid binary"
    )
    found = sorted(found.collect(), key=lambda r: (r["lang"], r["cluster"]))
    if not found:  # a handful of texts, none in the sample
        return _classified(docs.withColumn("lang", F.lit(None).cast("string")), carried, folds, fold)
    centroids = np.stack([np.frombuffer(r["centroid"], "<f4") for r in found], 1)
    langs = sorted({r["lang"] for r in found})
    of = np.array([langs.index(r["lang"]) for r in found])
    model = (idf, np.ascontiguousarray(centroids))
    counted = (
        train.select("text").mapInArrow(trimmed(cosines(spark.sparkContext.broadcast(model), of, len(langs))), "cell long, n long")
        .groupBy("cell").agg(F.sum("n").alias("n"))
    )
    n = np.zeros(len(langs) * LENGTHS * (STEPS + 1), np.int64)
    for r in counted.collect():
        n[r["cell"]] = r["n"]
    low = bounds(n.reshape(len(langs), LENGTHS, STEPS + 1))[of]
    shared = spark.sparkContext.broadcast((*model, [r["lang"] for r in found], low))
    out = T.StructType().add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    schema = T.StructType([*texts.schema.fields[:-2], *out.fields])
    return texts.mapInArrow(trimmed(classifier(shared)), schema)
