"""Documents packed into token sequences of a fixed capacity by harmonic classes.

Class k holds pieces of at most capacity / k tokens, and each of its bins takes exactly
k of them. A document is cut at whole capacities; what remains is either nearly as long
as its class allows and stays whole, or gives a piece of exactly capacity / k' tokens,
k' being the next class, and a remainder that is cut again. Workers fill the bins of a
class independently: a piece's place follows from its rank in its class, and ranks come
from counts per part of the table. Only what is left of each class, less than one bin
each, is packed together, first fit by falling length.

Edge cases: a null or empty text is a document of one token, the end mark. Long texts are
encoded whole and cut. Rows with equal or no ``doc_id`` are packed each for itself; pieces
of equal length are ordered by a hash. Only ``doc_id`` and ``text`` are read. An empty
table gives no pieces.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.llm.common import offsets, release, stored, trimmed, worker_cache

CAPACITY = 2048
END_ID = 1
#: A piece stays whole if its bins lose at most this share; below TINY tokens always.
LOSS, TINY = 1 / 32, 16
#: Pieces per part of a class within which ranks are counted.
PART = 50_000
REMEMBERED = 1_000_000
ENCODED = "doc_id long, doc_tokens long, ids binary, pieces array<struct<start: long, length: long, class: int>>"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def classes(capacity: int) -> list[int]:
    """Documents per bin of each class: all up to 16, then a quarter more each time."""
    out = list(range(1, min(16, capacity) + 1))
    while out[-1] * 1.25 < capacity:
        out.append(int(out[-1] * 1.25))
    return out


def cuts(n: int, capacity: int, ks: list[int]) -> list[tuple[int, int]]:
    """``(length, class)`` of each piece of ``n`` tokens, in order."""
    out = [(capacity, 1)] * (n // capacity)
    limits = [-(capacity // k) for k in ks]
    r = n % capacity
    while r:
        # The largest class whose pieces may have r tokens.
        i = bisect_left(limits, -r)
        i = i if i < len(ks) and -limits[i] == r else i - 1
        if r <= TINY or i + 1 == len(ks) or r * ks[i] >= (1 - LOSS) * capacity:
            out.append((r, ks[i]))
            break
        out.append((-limits[i + 1], ks[i + 1]))
        r += limits[i + 1]
    return out


# Signs behind letters are a unit of their own; not those that begin a contraction or a special token.
SIGNS = re.compile(rb"([A-Za-z\x80-\xff]+)([!-&(-/:;=>?@\[-`{}~]+)")
#: Stands between words that are encoded together; its last id tells where each ends.
BETWEEN = "\u25c6"


#: A byte no text holds, as the end of a word.
WORD_END = b"\xff"


def lower_letters(words: list[bytes]) -> list[bytes]:
    """Words of Latin letters alone in lower case; others are empty."""
    texts = [w.decode().lower() for w in words]
    return [t.encode() if t.isalpha() and max(t) < "\u0250" else b"" for t in texts]


def letter_merges(path: str):
    """The vocabulary's merges as a function of one word of letters, if it is lower-case BPE with word ends.

    A word of letters is one unit to the tokenizer, whose ids are the vocabulary's merges by
    rank. ``tiktoken`` does the same merges on the same table many times faster.
    """
    import sys

    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    end, vocab = model.get("end_of_word_suffix"), model["vocab"]
    merged = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    ids = [vocab["".join(m)] for m in merged]
    if not end or ids != sorted(ids) or sys.byteorder != "little":
        return None
    # Fixed rule of byte-level vocabularies: printable bytes stand for themselves, others from U+0100 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {}
    for token, i in vocab.items():
        body = token.removesuffix(end)
        if body and all(c in byte for c in body):
            ranks[bytes(byte[c] for c in body) + (WORD_END if token != body else b"")] = i
    if not all(bytes([b]) in ranks for b in range(256)):
        return None
    return tiktoken.Encoding("letters", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class Ids:
    """Little-endian ids of texts, 16 bits each if the vocabulary allows it, word by word from a bounded memory."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.known: dict[bytes, bytes] = {}
        self.between = np.array(self.ids_of(BETWEEN))
        self.letters = letter_merges(path)

    def ids_of(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def learn(self, words: list[bytes]) -> None:
        """Words, none with the separator, encoded together."""
        mark = len(self.between)
        if self.letters:
            code, piece = "H" if self.kind == "<u2" else "I", self.letters
            own = [(w, t) for w, t in zip(words, lower_letters(words)) if t]
            self.known.update((w, array(code, piece(t + WORD_END)).tobytes()) for w, t in own)
            words = [w for w in words if w not in self.known]
        for i in range(0, len(words), 2000):
            part = words[i : i + 2000]
            text = f" {BETWEEN} ".join([w.decode() for w in part])
            ids = np.array(self.ids_of(f"{text} {BETWEEN}"), self.kind)
            ends = np.flatnonzero(ids == self.between[-1])
            if len(ends) == len(part):
                raw, size = ids.tobytes(), ids.itemsize
                starts = np.append(0, ends[:-1] + 1) * size
                stops = (ends - mark + 1) * size
                self.known.update((w, raw[a:b]) for w, a, b in zip(part, starts.tolist(), stops.tolist()))
            else:  # a word holds the separator's last id
                self.known.update((w, np.array(self.ids_of(w.decode()), self.kind).tobytes()) for w in part)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [(t.lower() if t.isascii() and "<|" not in t else t).encode().split() for t in texts]
        new = set().union(*split)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
        new.difference_update(self.known)
        signed = [(w, m[1], m[2]) for w in new if (m := SIGNS.fullmatch(w))] if self.letters else []
        signed = [x for x, letters in zip(signed, lower_letters([b for _, b, _ in signed])) if letters]
        new.difference_update([w for w, _, _ in signed])
        new.update([x for _, *both in signed for x in both if x not in self.known])
        self.learn(list(new))
        known = self.known
        known.update((w, known[a] + known[b]) for w, a, b in signed)
        return [b"".join(map(known.__getitem__, words)) for words in split]


def encoder(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_cache("packing")
        if kept.get("path") != path:
            kept.update(path=path, ids=Ids(path))
        own, ks = kept["ids"], classes(capacity)
        end = np.array([END_ID], own.kind).tobytes()
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                ids = [x + end for x in own.encode([t or "" for t in part.column(1).to_pylist()])]
                n = [len(x) // len(end) for x in ids]
                cut = [cuts(x, capacity, ks) for x in n]
                count = np.cumsum([0] + [len(c) for c in cut])
                flat = np.array([x for c in cut for x in c], np.int64).reshape(-1, 2)
                begin = np.cumsum(flat[:, 0]) - flat[:, 0]
                begin -= np.repeat(begin[count[:-1]], np.diff(count))
                pieces = pa.StructArray.from_arrays(
                    [pa.array(begin), pa.array(flat[:, 0]), pa.array(flat[:, 1].astype(np.int32))], names=["start", "length", "class"]
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.ListArray.from_arrays(pa.array(count.astype(np.int32)), pieces)],
                    names=["doc_id", "doc_tokens", "ids", "pieces"],
                )

    return run


def encode(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Ids of all documents and the pieces ``(start, length, class)`` they are cut into; every id is in exactly one."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(trimmed(encoder(tokenizer_path, capacity)), ENCODED)


def first_fit(capacity: int):
    """Left-over pieces, at most one bin of each class, into as few sequences as they need."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc", "start"], ascending=[False, True, True], kind="stable")
        free: list[int] = []
        bins, at = [], []
        for length in rows["length"]:
            i = next((i for i, room in enumerate(free) if room >= length), len(free))
            if i == len(free):
                free.append(capacity)
            bins.append(i), at.append(capacity - free[i])
            free[i] -= length
        return rows.assign(sequence_id=np.array(bins, "int64") + rows["base"], offset=np.array(at, "int64"))

    return run


def laid_out(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces(doc, start, length, class)`` with ``sequence_id`` and ``offset``."""
    totals = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count("*").alias("n")).collect()}
    full = {k: n // k for k, n in totals.items()}
    base, first = {}, 0
    for k in sorted(full):
        base[k], first = first, first + full[k]
    of = lambda d: F.element_at(F.create_map(*[F.lit(x) for kv in d.items() for x in kv]), F.col("class"))
    parts = -(-sum(totals.values()) // PART)
    rows = pieces.withColumn("h", F.xxhash64("doc", "start")).withColumn("part", F.pmod("h", F.lit(parts)))
    before = offsets(rows.groupBy("class", "part").agg(F.count("*").alias("n")), ["class"], "part", "n")
    within = Window.partitionBy("class", "part").orderBy("h", "doc", "start")
    placed = (
        rows.withColumn("row", F.row_number().over(within) - 1)
        .join(before.drop("n"), ["class", "part"])
        .withColumn("rank", F.col("row") + F.col("offset_before"))
        .withColumn("bin", F.floor(F.col("rank") / F.col("class")))
        .withColumn("full", F.col("bin") < of(full))
        .select("doc", "start", "length", "class", "rank", "bin", "full")
    )
    placed = stored(placed, "placed")
    filled = Window.partitionBy("class", "bin").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = placed.where("full").select(
        "doc", "start", "length", (F.col("bin") + of(base)).cast("long").alias("sequence_id"),
        F.coalesce(F.sum("length").over(filled), F.lit(0)).cast("long").alias("offset"),
    )
    rest = placed.where("not full").select("doc", "start", "length", F.lit(first).cast("long").alias("base"))
    schema = "doc long, start long, length long, base long, sequence_id long, offset long"
    tail = rest.groupBy("base").applyInPandas(first_fit(capacity), schema).drop("base")
    out = stored(whole.union(tail), "layout")
    release(placed)
    return out


def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's ids dealt to its pieces, 32 bits each."""
    for batch in batches:
        for i in range(0, batch.num_rows, 200):
            rows = []
            for doc, n, raw, placed in zip(*(batch.slice(i, 200).column(c).to_pylist() for c in range(4))):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4").tobytes()
                for p in placed:
                    start, length = p["start"], p["length"]
                    rows.append((doc, start, length, n, p["sequence_id"], p["offset"], ids[4 * start : 4 * (start + length)]))
            if rows:
                kinds = (pa.int64(),) * 6 + (pa.binary(),)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )


def pack(encoded: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """All pieces of ``encoded`` documents with their ids, ``sequence_id`` and ``offset``.

    Only places are shuffled and sorted; the ids are joined to the finished layout, once.
    """
    # The number is fixed when the table is written; nothing counts it again.
    rows = stored(encoded.withColumn("doc", F.monotonically_increasing_id()), "encoded")
    pieces = rows.select("doc", F.explode("pieces").alias("p")).select("doc", "p.*")
    layout = laid_out(pieces, capacity)
    of_doc = layout.groupBy("doc").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("placed"))
    joined = rows.select("doc", "doc_id", "doc_tokens", "ids").join(of_doc, "doc")
    return joined.select("doc_id", "doc_tokens", "ids", "placed").mapInArrow(trimmed(assemble), PIECES)
