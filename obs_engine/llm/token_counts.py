"""Token counts of a unigram tokenizer without its tokens.

A text is cut before every space, as the tokenizer does, and each word goes through
one Viterbi pass that keeps two numbers per position: the best score and how many
pieces reach it. An Aho-Corasick automaton lists the vocabulary pieces ending at a
position, longest first. Ties follow the tokenizer: pieces are tried by where they
begin, and only a strictly better score replaces one already found. A character that
is no piece of its own may become an unknown one, at the lowest score less ten; with
byte pieces in the vocabulary it counts one piece per UTF-8 byte, else a run of
unknown characters counts one.

Words already counted are remembered per worker up to a fixed number of words. A null
or empty text has no tokens, a long one is counted whole, repeated rows count alike. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.common import worker_cache

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Words that a worker remembers, and the longest such word.
REMEMBERED, LONGEST = 1_000_000, 64


class Vocabulary(NamedTuple):
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    bytes_known: bool


def zipf_vocabulary(model_path: str) -> Vocabulary:
    """Pieces of a sentencepiece model, scored by Zipf's law over their order in it.

    The public file at hand orders its pieces by merge and has no probabilities; the
    frequency of the piece of rank r is taken as proportional to 1 / r.
    """
    import math

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = [i for i in range(len(model)) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))]
    return Vocabulary(
        tuple(model.id_to_piece(i) for i in ids),
        tuple(-math.log(rank) for rank in range(1, len(ids) + 1)),
        any(model.is_byte(i) for i in range(len(model))),
    )


class Counter(dict):
    """Word -> number of pieces."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.trie = ahocorasick.Automaton()
        for piece, score in zip(vocabulary.pieces, vocabulary.scores):
            self.trie.add_word(piece, (len(piece), score))
        self.trie.make_automaton()
        self.single = {p for p in vocabulary.pieces if len(p) == 1}
        # The lowest score counts the unknown and byte pieces too, at zero.
        self.unknown = min(0.0, *vocabulary.scores) - UNKNOWN_PENALTY
        self.by_bytes = vocabulary.bytes_known

    def __missing__(self, word: str) -> int:
        n = self.pieces(SPACE + word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n

    def pieces(self, text: str) -> int:
        best: list[float | None] = [0.0] + [None] * len(text)
        count = [0] * (len(text) + 1)
        unknown = [False] * (len(text) + 1)
        matches = self.trie.iter(text)
        end, found = next(matches, (-1, None))
        for i, char in enumerate(text):
            top, n, odd = None, 0, False
            while end == i:
                length, score = found
                score += best[i + 1 - length]
                if top is None or score > top:
                    top, n = score, count[i + 1 - length] + 1
                end, found = next(matches, (-1, None))
            if char not in self.single:
                score = best[i] + self.unknown
                if top is None or score > top:
                    top, odd = score, True
                    n = count[i] + (len(char.encode()) if self.by_bytes else not unknown[i])
            best[i + 1], count[i + 1], unknown[i + 1] = top, n, odd
        return count[-1]

    def text(self, text: str) -> int:
        words = text.replace(SPACE, " ").split(" ")
        if words[0] == "":
            del words[0]
        return sum(map(self.__getitem__, words))


def counting(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = Vocabulary(*vocabulary.value)
        kept = worker_cache("token_counts")
        if kept.get("vocabulary") != shared:
            kept.update(vocabulary=shared, counter=Counter(shared))
        counter = kept["counter"]
        for batch in batches:
            counts = [counter.text(t) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(doc_id, n_tokens)`` for every row of ``docs(doc_id, text)``; one pass, no shuffle.

    The vocabulary is broadcast: its size is that of the tokenizer's file.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vocabulary))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(counting(shared), f"doc_id {kind}, n_tokens long")
