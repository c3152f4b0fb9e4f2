"""Ranked search, repeated words and the conversation trie against brute force and odd input."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from obs_engine.llm import prefix_trie, queries, ranked_search, substring_dedup
from obs_engine.llm.common import dealt_join

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- ranked search


def brute_search(docs, items, k=10):
    """``docs``: (id, text), ids unique; one entry per item and its distinct terms."""
    counted = [(d, Counter(w.translate(LOWER) for w in TERM.findall(t or ""))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, terms in {(i, frozenset(w.translate(LOWER) for w in TERM.findall(t or ""))) for i, t in items}:
        scores = []
        for d, c in counted:
            m = 10 + (90 * sum(c.values()) * n) // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in terms if w in c
            )
            if s > 0:
                scores.append((-s, d is None, d))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(scores[:k])]
    return sorted(out, key=str)


def searched(docs, items, k=10):
    return sorted((tuple(r) for r in ranked_search.Index(docs).search(items, k).collect()), key=str)


@pytest.mark.parametrize("k", [1, 10, 1000])
def test_search_matches_brute_force(spark, k):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    mine = searched(docs, items, k)
    assert mine == brute_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], k)


def test_search_over_packs_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "PACK_TERMS", 3)
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(30)] + ["É", "é", "ÀB", "x9"]
    weights = 1 / np.arange(1, 35)
    texts = [" ".join(rng.choice(words, rng.integers(0, 40), p=weights / weights.sum())) for _ in range(300)]
    texts += texts[:50]  # equal scores
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    asked = [(i, " ".join(rng.choice(words, rng.integers(1, 12)))) for i in range(25)]
    items = spark.createDataFrame(asked, "item_id long, text string")
    assert searched(docs, items) == brute_search(list(enumerate(texts)), asked)


def test_search_of_odd_rows(spark):
    long = "needle " + "hay " * 200_000
    docs = spark.createDataFrame(
        [(1, "Needle in hay", 5), (2, "needle in hay", 5), (3, None, 5), (4, "", 5), (5, " .,! ", 5), (None, "needle", 5), (6, long, None)],
        "doc_id long, text string, score long",
    ).withColumn("rank", F.lit("x")).withColumn("terms", F.lit(1))
    asked = [(1, "NEEDLE needle"), (1, "needle."), (2, None), (3, ""), (4, "absent"), (None, "in hay"), (7, "hay")]
    items = docs.sparkSession.createDataFrame(asked, "item_id long, text string").withColumn("item", F.lit("y"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert searched(docs, items) == brute_search(rows, asked)
    assert searched(docs.limit(0), items) == [] and searched(docs, items.limit(0)) == []


def test_pairs_bound_what_a_document_can_add(spark):
    """A block's best documents by any threshold are those of a full scan."""
    docs = spark.createDataFrame([(i, " ".join(f"t{j}" for j in range(9) if (i * 7 + j * j) % (j + 2) == 0) or "zz") for i in range(500)], "doc_id long, text string")
    items = spark.createDataFrame([(0, "t0 t1 t2 t3 t4 t5 t6 t7 t8")], "item_id long, text string")
    index = ranked_search.Index(docs)
    weighed = index.weights(spark.createDataFrame([(int(t),) for t in ranked_search.term_hashes(np.frombuffer(b"t0 t1 t2 t3 t4 t5 t6 t7 t8", np.uint8), np.array([0, 26]))[0].view(np.int64)], "term long"))
    pack = ranked_search.Pack([{"item": 1, "term": r.term, "w": r.w} for r in weighed.collect()])
    ready, least = index.prepare(pack, 10)
    full = {r.doc_id: r.score for r in index.search(items, 500).collect()}
    for row in ready.collect():
        block = ranked_search.Block(row.asDict())
        for bar in [1, *sorted(set(full.values()))[::7]]:
            found, score = ranked_search.best_of(block, [(p, tuple(pack.pairs[p])) for p in pack.queries[0]], bar)
            own = {int(block.ids[i]): int(s) for i, s in zip(found, score)}
            assert own == {d: full[d] for d in block.ids.tolist() if full.get(d, 0) >= bar}
    tenth = sorted(full.values())[-10]
    assert least and max(least.values()) <= tenth


# --- repeated words


def brute_repeats(texts, length=35):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def removed(df):
    out = substring_dedup.remove_repeats(df).collect()
    return [(r.n_words, sum(x["end"] - x["begin"] for x in r.runs), hashlib.sha256(r.kept).hexdigest()) for r in out]


@pytest.mark.parametrize("crowd", [20_000, 2])
def test_repeated_words_match_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(substring_dedup, "CROWD", crowd)
    rng = np.random.default_rng(3)
    passage = [" ".join(rng.choice(["a", "b", "c", "Dé", " x"], 60)) for _ in range(3)]
    texts = []
    for i in range(60):
        own = lambda n: " ".join(f"u{i}_{j}" for j in range(n))
        p = passage[i % 3].split()
        cut = p[rng.integers(0, 20) : rng.integers(45, 61)]
        texts.append(f"{own(int(rng.integers(0, 50)))}\n{' '.join(cut)}\t{own(int(rng.integers(0, 50)))}")
    texts += ["same " * 34, "same " * 35, "same " * 36, "same " * 400, texts[0], texts[0] + " more", None, "", " \n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(removed(df)) == sorted(brute_repeats(texts))


def test_repeated_words_of_odd_rows(spark, monkeypatch):
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
    run = " ".join(f"p{i}" for i in range(40))
    texts = [(1, run), (1, run), (2, run + " x"), (2, "y " + run), (None, run), (None, None), (3, long), (4, "Same " * 20), (5, "same " * 40)]
    df = spark.createDataFrame([(*r, 7, "b") for r in texts], "doc_id long, text string, mark int, prefix string")
    expected = brute_repeats([t for _, t in texts])
    assert sorted(removed(df)) == sorted(expected)
    monkeypatch.setattr(substring_dedup, "PART", 1 << 10)
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0
    only = spark.createDataFrame([(1, run)], "doc_id long, text string")
    assert removed(only) == brute_repeats([run])


def test_trees_find_the_windows_two_leaves_share():
    words = np.array([[1, 2, 3, 4], [1, 2, 3, 5], [1, 2, 9, 9], [7, 2, 3, 4]], np.uint64)
    nodes = substring_dedup.tree_nodes(np.array([0, 0, 0, 1]), words)
    same = lambda i, j: [d for d in range(5) if nodes[i, d] == nodes[j, d]]
    assert same(0, 1) == [0, 1, 2, 3] and same(0, 2) == [0, 1, 2] and same(0, 3) == []


def test_hot_keys_are_dealt(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("k"), "id")
    sizes = rows.groupBy("k").agg(F.count("*").alias("n"))
    out = dealt_join(rows, sizes, ["k"], "n", ["id"])
    assert out.count() == 5000 and out.where("k = 0 and n = 4000").count() == 4000 and set(out.columns) == {"k", "id", "n"}


# --- conversation trie


def brute_trie(rows):
    """Nodes by rows (conv_id, turn, role, text), each prefix spelled out."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[c].append(((t is not None, t or 0, tie), (role, text)))
    own = {c: [x for _, x in sorted(v, key=lambda x: x[0])] for c, v in turns.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    out = []
    for path, m in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(path)))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(m), len(path), parent, len(m), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes_of(df):
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(df).collect()), key=str)


CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("width", [1, 3, 8])
def test_trie_matches_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(prefix_trie, "WIDTH", width)
    monkeypatch.setattr(prefix_trie, "STRETCH", 4)
    monkeypatch.setattr(prefix_trie, "CHUNK", 8)
    rng = np.random.default_rng(width)
    rows = []
    for c in range(70):
        n = int(rng.integers(1, 13)) if c != 41 else 60
        start = int(rng.integers(0, 3))
        for t in range(n):
            rows.append((c, start + 2 * t, "user" if t % 2 else "bot", " ".join(["so"] * int(rng.integers(0, 3)))))
    assert nodes_of(spark.createDataFrame(rows, CONV)) == brute_trie(rows)


def test_trie_of_odd_rows(spark):
    rows = [
        (None, 1, "u", "nobody's"), (0, None, "u", "first"), (0, 3, None, None), (0, 3, None, None), (0, -5, "u", "a b"), (1, 1, "u", "hi"),
        (2, 7, "u", "x"), (2, 7, "u", "x"), (2, 7, "v", "x"), (45, 1, "u", "lonely"), (46, 1, "u", "gone"), (47, 1, "a", "bc"), (48, 1, "ab", "c"),
        (100, None, None, " \n" + "w " * 100_000), (101, None, None, None),
    ]
    df = spark.createDataFrame([(*r, "k", 3) for r in rows], CONV + ", id string, words int")
    assert nodes_of(df) == brute_trie(rows)
    assert nodes_of(df.limit(0)) == []


def test_the_queries_derive_their_digests(spark):
    trie = queries.op13_prefix_trie(spark, SF)
    assert trie.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert queries.op12_substring_dedup(spark, SF).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    plan = queries.op13_prefix_trie(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
