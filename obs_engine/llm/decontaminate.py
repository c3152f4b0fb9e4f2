"""Benchmark passages in training text, by a distributed positional inverted index.

Postings ``(term, doc, position)`` of the corpus are intersected as a search engine does
for a phrase query. Every run of ``window`` consecutive item words is a phrase; its
rarest term (by count over all training text) is looked up first, for exact matches
together with the word beside it. Postings of the benchmark's terms are stored where a
looked-up word stands, for as many words around it as a phrase reaches. A posting at position p of the item's word j belongs to the alignment p - j:
postings of one document, item and alignment are the offset-adjusted lists, and a run of
``window`` consecutive words among them is an exact phrase match. With ``least`` below
``window`` the same lists give proximity matches: stretches of ``window`` places in which
that many words stand where they should.

The corpus is split into words twice: once to count the terms of the benchmark, once for
the postings. All of it is DataFrame operations. The benchmark's terms are broadcast
while they number at most ``TERMS``; more are joined by a shuffle.

Edge cases: null and empty texts have no words. An item of fewer words than ``window``
is one phrase. Rows with one ``doc_id`` are told apart by their text; equal rows each
get the result. Several items with one ``item_id`` count as one.
Of equally rare words the first of a phrase is looked up. Long texts are read whole. With
an empty table on either side nothing matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obs_engine.llm.common import fresh, stored

WINDOW = 10
TERMS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed value: runs of bytes below 0x80 that are no letter or digit part words.
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def cut(text: str = "text") -> Column:
    """Array of the words of a text, with an empty one where it begins or ends in a break."""
    return F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), BREAKS, -1)


def folded(word: Column) -> Column:
    """A-Z in lower case, no other letter changed."""
    plain = F.octet_length(word) == F.char_length(word)
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def n_words(parts: Column) -> Column:
    empty = lambda i: (F.element_at(parts, i) == "").cast("long")
    return F.size(parts) - empty(1) - F.when(F.size(parts) > 1, empty(-1)).otherwise(0)


def item_words(items: DataFrame) -> DataFrame:
    """``(item, n, j, term)``; an item is a number for each distinct (item_id, text)."""
    found = items.select("item_id", F.transform(F.filter(cut(), lambda w: w != ""), folded).alias("w")).where(F.size("w") > 0).distinct()
    found = found.withColumn("item", F.xxhash64("item_id", "w"))
    return found.select("item_id", "item", F.size("w").alias("n"), F.posexplode("w").alias("j", "term"))


def bounded(terms: DataFrame) -> DataFrame:
    return F.broadcast(terms) if terms.count() <= TERMS else terms


def row_name() -> Column:
    """Name of a document row: of its ``doc_id`` and text."""
    name = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("text").cast("string"))
    return F.unhex(F.md5(name.cast("binary")))


class Index:
    """Stored word counts, item phrases and postings of one corpus for one benchmark."""

    def __init__(self, docs: DataFrame, items: DataFrame, window: int = WINDOW, least: int | None = None):
        self.window, self.least = window, least or window
        self.docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("row", row_name())
        self.items = stored(item_words(items), "item_words")
        terms = stored(self.items.select("term").distinct().withColumn("t", F.xxhash64("term")), "terms")
        self.terms = bounded(terms)
        self.anchors = stored(self._anchors(), "anchors")
        self.postings = stored(self._postings(), "postings")

    def _anchors(self) -> DataFrame:
        """``(item, j, term, side, beside)``: the words to look up first, some of each phrase.

        A proximity match may miss ``window - least`` words of its stretch, so one more
        than that are looked up, the rarest ones, by themselves. A word of an exact phrase
        is looked up with the next or, at the end, the previous word.
        """
        corpus = self.docs.select(F.explode(cut()).alias("word")).select(folded(F.col("word")).alias("term"))
        n = corpus.join(self.terms, "term").groupBy("term").agg(F.count("*").alias("n_corpus"))
        counted = self.items.join(n, "term", "left").withColumn("n_corpus", F.coalesce("n_corpus", F.lit(0)))
        last = F.greatest(F.col("n") - self.window, F.lit(0))
        starts = counted.withColumn(
            "phrase", F.explode(F.sequence(F.greatest(F.col("j") - self.window + 1, F.lit(0)), F.least("j", last)))
        )
        rank = Window.partitionBy("item", "phrase").orderBy("n_corpus", "j")
        picked = starts.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= self.window - self.least + 1)
        alone = (F.col("n") == 1) | F.lit(self.least < self.window)
        end = F.col("phrase") + F.least("n", F.lit(self.window)) - 1
        picked = picked.withColumn("side", F.when(alone, 0).when(F.col("j") < end, 1).otherwise(-1))
        beside = self.items.select("item", F.col("j").alias("_j"), F.col("term").alias("beside"))
        near = (F.col("j") + F.col("side")) == F.col("_j")
        picked = picked.select("item", "j", "term", "side").distinct()
        return picked.join(beside.withColumnRenamed("item", "_item"), near & (F.col("item") == F.col("_item"))).drop("_item", "_j")

    def _postings(self) -> DataFrame:
        """``(row, p, t)`` of benchmark terms at most a phrase away from a looked-up word."""
        wanted = bounded(self.anchors.select("term", "side", "beside").distinct())
        parts = self.docs.select("row", cut().alias("w"))
        placed = parts.select("row", "w", F.posexplode("w").alias("p", "word")).withColumn("term", folded(F.col("word")))
        found = placed.join(wanted, "term").where(folded(F.get("w", F.col("p") + F.col("side"))) == F.col("beside"))
        begin = F.greatest(F.col("p") - self.window + 1, F.lit(0))
        lead = (F.element_at("w", 1) == "").cast("int")
        around = found.select("row", begin.alias("b"), lead.alias("lead"), F.slice("w", begin + 1, F.col("p") - begin + self.window).alias("near"))
        around = around.select("row", "b", "lead", F.posexplode("near").alias("k", "word"))
        terms = around.select("row", (F.col("b") + F.col("k") - F.col("lead")).alias("p"), folded(F.col("word")).alias("term"))
        return terms.join(self.terms, "term").select("row", "p", "t").distinct()

    def alignments(self) -> DataFrame:
        """``(row, item, n, a, j)``: words in place, for alignments that hold a looked-up word."""
        item_terms = self.items.select("item", "n", "j", F.xxhash64("term").alias("t"))
        looked = self.anchors.select("item", "j", F.xxhash64("term").alias("t"))
        place = (F.col("p") - F.col("j")).alias("a")
        first = self.postings.join(looked, "t").select("row", "item", place).distinct()
        expected = first.join(item_terms, "item").select("row", "item", "n", "a", "j", (F.col("a") + F.col("j")).alias("p"), "t")
        return expected.join(self.postings, ["row", "p", "t"], "left_semi").select("row", "item", "n", "a", "j")

    def matches(self) -> DataFrame:
        """``(row, item, first, last, n_words)``: each phrase or proximity match, in document positions."""
        w = self.window
        need = F.least(F.col("n"), F.lit(w)) - (w - self.least)
        length = F.least(F.col("n"), F.lit(w))
        words_in = stored(self.alignments(), "alignments")
        # Of w places from each word in place, how many are in place too.
        ahead = Window.partitionBy("row", "item", "a").orderBy("j").rangeBetween(0, w - 1)
        runs = words_in.withColumn("k", F.count("*").over(ahead)).withColumn("need", need).withColumn("length", length)
        runs = runs.where("k >= need and j + length <= n" if self.least == w else "k >= need")
        begin = F.col("a") + F.col("j")
        return runs.select("row", "item", begin.alias("first"), (begin + F.col("length") - 1).alias("last"), F.col("k").alias("n_words"))


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``n_words, n_hit, item_ids`` (sorted as text) of exact phrases."""
    index = Index(docs, items, window)
    found = stored(index.matches(), "matches")
    hit = found.select("row", F.explode(F.sequence("first", "last")).alias("p")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    names = index.items.select("item", F.col("item_id").cast("string").alias("item_id")).distinct()
    ids = found.select("row", "item").distinct().join(names, "item").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    per_row = hit.join(ids, "row", "left")
    counted = index.docs.select("doc_id", "row", cut().alias("w")).select("doc_id", "row", n_words(F.col("w")).alias("n_words"))
    return counted.join(per_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any exact phrase of ``items``, all columns unchanged."""
    name = fresh(docs, "row")[0]
    found = stored(Index(docs, items, window).matches().select(F.col("row").alias(name)).distinct(), "contaminated")
    return docs.withColumn(name, row_name()).join(found, name, "left_anti").drop(name)
