"""Toxicity by non-negative positive-unlabelled learning.

Linear classifiers over hashed words are trained with numpy from two kinds of text:
confirmed toxic ones, and unlabelled ones of which a share (the class prior) is toxic
too. Only words whose frequency in the two differs by more than chance have a weight. The risk is prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive));
where a batch makes the last term negative, the step goes the other way, so the
classifier can't overfit by driving it below zero. Several classifiers, each from its
own part of the unlabelled sample, are averaged; their output is calibrated to probabilities on
labelled texts that none of them was trained with.

Training uses about ``POSITIVE`` toxic, ``UNLABELLED`` any and ``CALIBRATION`` labelled
texts, chosen by hash; scoring covers every text whole. What reaches the driver is one
weight vector per classifier and the calibration counts.

Edge cases: a null or empty text has no words and gets the score of the intercept.
Several labels of one document: toxic if any says so. Without toxic labels every score
is 0. A row without ``doc_id`` is scored but not learned from. Long texts are
scored whole, equal texts alike, so there are no ties to break. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.language_id import remainder
from obs_engine.llm.textvec import chunks, flat, lower_table, mix, powers, prefix_hash, spans

FEATURES = 1 << 18
POSITIVE, UNLABELLED, CALIBRATION = 12_000, 24_000, 12_000
CLASSIFIERS, EPOCHS, BATCHES = 4, 20, 8
RATE, DECAY, DEVIATIONS = 0.05, 1e-4, 4.0


def word_features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)`` of the distinct words (letters, digits) of each text, in order."""
    data = lower_table()[data]
    is_word = np.zeros(256, bool)
    is_word[48:58] = is_word[97:123] = is_word[128:] = True
    begin, end, first = spans(is_word[data], at)
    p = prefix_hash(data)
    _, down = powers(len(data) + 1)
    h = mix((p[end] - p[begin]) * down[begin] + (end - begin).astype(np.uint64))
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    cell = np.unique(row * FEATURES + (h % np.uint64(FEATURES)).astype(np.int64))
    return cell // FEATURES, cell % FEATURES


def features_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, at = flat(column)
    rows, cols = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for a, b in chunks(at):
        r, c = word_features(data[at[a] : at[b]], at[a : b + 1] - at[a])
        rows.append(r + a), cols.append(c)
    return np.concatenate(rows), np.concatenate(cols)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def nnpu(row: np.ndarray, col: np.ndarray, positive: np.ndarray, prior: float, seed: int) -> np.ndarray:
    """Weights, the intercept last. ``positive``: per text, else it is unlabelled."""
    rng = np.random.default_rng(seed)
    n = len(positive)
    # Words about as frequent in either kind keep weight zero.
    in_positive = np.bincount(col[positive[row]], minlength=FEATURES)
    in_all = np.bincount(col, minlength=FEATURES)
    a, b = positive.sum(), n - positive.sum()
    share = in_all / n
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / a + 1 / b))
    keep = np.abs(in_positive / a - (in_all - in_positive) / b) > DEVIATIONS * spread
    names = np.flatnonzero(keep)
    number = np.zeros(FEATURES, np.int64)
    number[names] = np.arange(len(names))
    used = keep[col]
    row, col = row[used], number[col[used]]
    first = np.searchsorted(row, np.arange(n + 1))
    w, b = np.zeros(len(names)), float(np.log(prior / (1 - prior)))
    m, v, step = np.zeros(len(names) + 1), np.zeros(len(names) + 1), 0
    groups = [np.flatnonzero(positive), np.flatnonzero(~positive)]
    for _ in range(EPOCHS):
        for p, u in zip(*(np.array_split(rng.permutation(g), BATCHES) for g in groups)):
            if not len(p) or not len(u):
                continue
            at = np.concatenate((p, u))
            size = first[at + 1] - first[at]
            cell = np.repeat(first[at] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            mine, cols = np.repeat(np.arange(len(at)), size), col[cell]
            z = b + np.bincount(mine, w[cols], len(at))
            zp, zu = z[: len(p)], z[len(p) :]
            rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            g = np.zeros(len(at))
            if rest >= 0:
                g[: len(p)] = -prior * sigmoid(-zp) / len(p) - prior * sigmoid(zp) / len(p)
                g[len(p) :] = sigmoid(zu) / len(u)
            else:
                g[: len(p)] = prior * sigmoid(zp) / len(p)
                g[len(p) :] = -sigmoid(zu) / len(u)
            grad = np.append(np.bincount(cols, g[mine], len(names)) + DECAY * w, g.sum())
            step += 1
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            w -= move[:-1]
            b -= move[-1]
    out = np.zeros(FEATURES + 1)
    out[names], out[-1] = w, b
    return out


def train(prior: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", kind="stable")
        part = int(rows["part"].iloc[0])
        row, col = features_of(pa.array(rows["text"], pa.large_string()))
        positive = rows["positive"].to_numpy(bool)
        if not positive.any() or positive.all():
            return pd.DataFrame({"part": [], "weights": []})
        w = nnpu(row, col, positive, prior, part)
        return pd.DataFrame({"part": [part], "weights": [w.astype("<f4").tobytes()]})

    return run


def logits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            z = np.full(batch.num_rows, float(w[-1]))
            data, at = flat(batch.column(2))
            for a, b in chunks(at):
                row, col = word_features(data[at[a] : at[b]], at[a : b + 1] - at[a])
                z[a:b] += np.bincount(row, w[col], b - a)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(z)], names=["doc_id", batch.schema.names[1], "logit"]
            )

    return run


def calibrate(z: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits the counts, by Newton's method."""
    a, b = 1.0, 0.0
    n = toxic + clean
    for _ in range(50):
        p = sigmoid(a * z + b)
        r, s = toxic - n * p, n * p * (1 - p)
        g = np.array([(r * z).sum() - 1e-3 * (a - 1), r.sum()])
        h = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-3]])
        da, db = np.linalg.solve(h, g)
        a, b = a + float(np.clip(da, -1, 1)), b + float(np.clip(db, -2, 2))
    return max(a, 1e-3), b


def score(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int | None = 2, threshold: float = 0.3,
          prior: float | None = None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text)``.

    Learns labels from rows whose ``crc32(doc_id)`` modulo ``folds`` is not ``fold``
    (None: from all). ``prior`` is the share of toxic texts, by default that among
    those labels.
    """
    spark = docs.sparkSession
    held = F.lit(False) if fold is None else F.coalesce(remainder("doc_id", folds) == fold, F.lit(False))
    texts = docs.select("doc_id", held.alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    known = (
        labels.where("doc_id is not null and toxic is not null").where(~held)
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    total, toxic = known.agg(F.count("*"), F.sum("toxic")).first()
    toxic = int(toxic or 0)
    if not toxic:
        return texts.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    prior = prior or min(max(toxic / total, 1e-4), 0.5)
    unit = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # One in five labelled texts calibrates; of the others the toxic ones train.
    apart = unit(1) < 0.2
    ids = known.where(
        (apart & (unit(2) < min(1.0, CALIBRATION / (0.2 * total)))) | (~apart & (F.col("toxic") == 1) & (unit(2) < min(1.0, POSITIVE / toxic)))
    ).select("doc_id", "toxic", apart.alias("apart"))
    n = texts.where("not held_out and doc_id is not null").count()
    chosen = texts.where("not held_out and doc_id is not null").join(F.broadcast(ids), "doc_id", "left")
    role = F.when(F.col("apart"), "calibration").when(F.col("toxic") == 1, "positive")
    free = ~apart & (unit(3) < min(1.0, UNLABELLED / max(n, 1)))
    roles = F.filter(F.array(role, F.when(free, "unlabelled")), lambda x: x.isNotNull())
    sample = chosen.select("doc_id", "text", "toxic", F.explode(roles).alias("role"))
    positive = F.col("role") == "positive"
    own = F.array(F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(CLASSIFIERS)).cast("int"))
    parts = F.when(positive, F.sequence(F.lit(0), F.lit(CLASSIFIERS - 1))).otherwise(own)
    rows = sample.where("role <> 'calibration'").select("doc_id", "text", positive.alias("positive"), F.explode(parts).alias("part"))
    found = rows.groupBy("part").applyInPandas(train(prior), "part int, weights binary").collect()
    weights = [np.frombuffer(r["weights"], "<f4") for r in sorted(found, key=lambda r: r["part"])]
    w = np.mean(weights, 0).astype(np.float64) if weights else np.zeros(FEATURES + 1)
    shared = spark.sparkContext.broadcast(w)
    seen = sample.where("role = 'calibration'").select("doc_id", "toxic", "text").mapInArrow(logits(shared), f"doc_id {kind}, toxic int, logit double")
    bins = seen.groupBy(F.round(F.col("logit") * 10).alias("bin")).agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).collect()
    a, b = 1.0, 0.0
    if sum(r["toxic"] for r in bins) >= 10:
        a, b = calibrate(*(np.array([float(r[c]) for r in bins]) for c in ("bin", "toxic", "clean")))
        a *= 10
    p = 1 / (1 + F.exp(-(F.col("logit") * a + b)))
    scored = texts.mapInArrow(logits(shared), f"doc_id {kind}, held_out boolean, logit double")
    return scored.select("doc_id", "held_out", p.alias("score")).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
