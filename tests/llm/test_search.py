"""Lexical search: against SQL and plain Python; bounds, ties, query blocks, edge texts."""

import math
import random
import re

import compare
import numpy as np
import pyarrow as pa
from llm import helpers
from pyspark.sql import functions as F

from nextpick.llm import search, tokens

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]


def plain(docs, queries, top=10):
    """(item_id, rank, doc_id, score) over all documents."""
    cut = [(i, terms(t)) for i, t in docs]
    cut = [(i, t) for i, t in cut if t]
    n, length = len(cut), sum(len(t) for _, t in cut)
    wanted = {}
    for item, text in queries:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, query in wanted.items():
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in set(d) for _, d in cut) + 1))) for t in query}
        found = []
        for doc_id, d in cut:
            m = 10 + 90 * len(d) * n // length
            score = sum(w[t] * (10**9 * d.count(t) // (1000 * d.count(t) + 8 * m)) for t in query if t in d)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k, f[3], -f[0]) for k, f in enumerate(sorted(found)[:top], 1)]
    return out


def run(spark, docs, queries, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for name in ("n", "terms", "rank", "score", "query"):
        d = d.withColumn(name, F.lit("extra"))
    q = spark.createDataFrame(queries, "item_id long, text string").withColumn("terms", F.lit(1))
    return sorted((tuple(r) for r in search.top_documents(d, q, **options).collect()), key=str)


def corpus(seed=0, count=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ü", "ß1"]
    text = lambda n: " ".join(words[min(61, int(rng.expovariate(0.1)))] for _ in range(n))
    docs = [(i, text(rng.randrange(1, 80))) for i in range(count)]
    docs += [(1000 + i, docs[5][1]) for i in range(40)]  # equal scores
    return docs, [(i, text(rng.randrange(1, 12))) for i in range(15)]


def test_query(spark):
    assert compare.spark_rows(search.op13_search(spark, SF_DIR)) == compare.duckdb_rows(compare.connect(SF_DIR), search.ORACLE)


def test_against_plain(spark, monkeypatch):
    docs, queries = corpus()
    queries += [(5, docs[5][1])]
    want = sorted(plain(docs, queries), key=str)
    assert run(spark, docs, queries) == want
    assert run(spark, docs, queries, block_cells=1) == want  # every query in a block of its own


def test_edges(spark):
    docs = [(i, t) for i, t in enumerate(helpers.EDGE_TEXTS)] + [(None, "plain words only"), (4, "plain words only"), (None, None)]
    queries = [(1, "plain words"), (2, None), (3, ""), (4, "nowhere"), (None, "joe MAIL"), (6, "word"), (6, "password"), (8, "😀 é")]
    assert run(spark, docs, queries) == sorted(plain(docs, queries), key=str)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == [] == run(spark, [(1, "a")], [])
    assert run(spark, [(1, None), (2, " ")], [(1, "a")]) == []


def vectors(docs, queries):
    vocabulary = search.Vocabulary(pa.array([t for _, t in queries]))
    n, rows, which, times = vocabulary.counts(pa.array([t for _, t in docs]))
    offsets = np.searchsorted(rows, np.arange(len(docs) + 1))
    weights = np.random.default_rng(0).integers(1, 9000, (vocabulary.size, len(queries)))
    return offsets, which, times * 1000 + 7, weights


def test_bounds_hold_for_every_document():
    docs, queries = corpus(1)
    offsets, which, values, weights = vectors(docs, queries)
    found = search.Queries(weights, 10)
    tree = search.BallTree(offsets, which, values, found.scale, leaf=8)
    dense = np.zeros((len(docs), len(weights)), np.int64)
    dense[np.repeat(np.arange(len(docs)), np.diff(offsets)), which] = values
    exact, every = dense @ weights, np.arange(len(queries))

    def below(node):
        if tree.below[node] is None:
            return list(tree.members[node])
        return [r for child in tree.below[node] for r in below(child)]

    assert sorted(below(0)) == list(range(len(docs)))
    for node in range(len(tree.radius)):
        assert (tree.bounds(node, every, found) >= exact[below(node)].max(axis=0)).all()
        if tree.below[node] is None:
            assert (tree.scores(node, every, found) == exact[tree.members[node]]).all()


def test_pruning_keeps_the_best_and_skips_leaves():
    docs, queries = corpus(2, 3000)
    offsets, which, values, weights = vectors(docs, queries)
    ids = np.array([i for i, _ in docs])
    found = search.Queries(weights, 5)
    tree = search.BallTree(offsets, which, values, found.scale, leaf=8)
    scored = search.search_tree(tree, ids, found)
    assert scored < 0.7 * sum(m is not None for m in tree.members) * len(queries)
    dense = np.zeros((len(docs), len(weights)), np.int64)
    dense[np.repeat(np.arange(len(docs)), np.diff(offsets)), which] = values
    for q, exact in enumerate((dense @ weights).T):
        want = sorted(((int(s), -int(i)) for s, i in zip(exact, ids) if s > 0), reverse=True)[:5]
        assert sorted(found.best[q], reverse=True) == want


def test_long_queries_use_integers():
    huge = search.Queries(np.full((4, 2), 1 << 40), 3)
    assert huge.weights.dtype == np.int64 and search.Queries(np.ones((4, 2), np.int64), 3).weights.dtype == np.float64


def test_terms_that_share_a_hash(monkeypatch):
    monkeypatch.setattr(search, "word_hashes", lambda w: np.full(len(w.row), 7, np.uint64))
    vocabulary = search.Vocabulary(pa.array(["one two three", "two"]))
    n, rows, which, times = vocabulary.counts(pa.array(["three two two x", None, "four"]))
    assert n.tolist() == [4, 0, 1] and sorted(zip(rows.tolist(), times.tolist())) == [(0, 1), (0, 2)]
    assert vocabulary.size == 3 and len(set(which.tolist())) == 2


def test_words():
    texts = ["Ab-c d", None, "", "x", "é\n9", "\u0000", "😀a"]
    w = tokens.words_of(pa.array(texts).slice(1, 5))
    assert [w.join(i, i + 1).decode() for i in range(len(w.row))] == ["x", "é", "9"] and w.row.tolist() == [2, 3, 3]
    w = tokens.words_of(pa.array(texts))
    assert [w.join(i, i + 1).decode() for i in range(len(w.row))] == [t for text in texts for t in terms(text)]
