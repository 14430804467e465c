"""Ranked lexical search: exact top documents of each query by inner product, in sparse ball trees.

Only terms of the queries matter, so a document is a sparse vector of integer impacts over them,
and its score for a query is the inner product with the query's integer weights. Documents are cut into terms once
and their counts are staged; term statistics are sums over all of them.

Each task builds ball trees over blocks of at most TREE documents and searches all queries in
each. A node has the centroid of its vectors, their largest distance from it, and the largest distance
in each coordinate (a ball of the weighted maximum norm); a document below the node scores at most
``q . centroid + |q| * radius`` and at most ``q . (centroid + coordinate radii)``. The second bound is what prunes text vectors: the
first, over thousands of dimensions, does so for close copies only. Going down, a query leaves a subtree as soon as the
smaller bound is under its TOP-th score so far, which is kept from block to block. Of the leaves that are left it takes the best
bounds first, in growing rounds, so that a leaf is scored for several queries at once. Vectors are scaled by the root
of the term's largest weight for the distances, and queries by its inverse, which leaves products as they are. Bounds are
computed in doubles and widened by more than all rounding can take (SAFE, relative, and one unit), and a subtree is
dropped only if its bound is below the score, so ties are never lost. Leaf scores are exact integers: sums below 2**53 are
exact in doubles too, and 64-bit integers are used where queries are so long that they could be larger. Each task returns TOP
documents a query at most, and the best of all tasks are the result: no document is left out, and what is
shuffled grows with the number of tasks.

Queries are read to the driver in blocks of at most BLOCK_CELLS (one query at least) and each block is broadcast;
one block after the other goes against all documents if there are several.

Edges: null and empty texts have no term and are not counted in N. A query without terms, or whose terms no document holds, has no
rows. Queries that share an id (null too) are one query with the terms of all its rows. Rows that repeat a doc_id are ranked one by one, null ids after all
others of an equal score. Empty tables give no rows. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nextpick.llm.common import table
from nextpick.llm.tokens import pieces, same_words, word_hashes, words_of
from nextpick.sources.stage import stage

TOP = 10
BLOCK_CELLS = 8 << 20  # queries times distinct terms, at most, that are broadcast together
TREE = 4096
LEAF = 64
FIRST_ROUND = 4  # leaves of a query that are scored before its best score is looked at again; doubled every round
SAFE = 1e-6
MOST_IMPACT = 1_000_000
NO_ID = (1 << 63) - 1  # stands for a null doc_id in comparisons


class Vocabulary:
    """Terms of a block of queries: sorted by hash, and their bytes to compare with."""

    def __init__(self, queries: pa.Array):
        words = words_of(queries)
        hashes = word_hashes(words)
        terms = sorted({(int(h), words.folded[s:e].tobytes()) for h, s, e in zip(hashes, words.start, words.end, strict=True)})
        self.size = len(terms)
        self.hash = np.array([h for h, _ in terms], np.uint64)
        self.length = np.array([len(t) for _, t in terms], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.text = np.frombuffer(b"".join(t for _, t in terms), np.uint8)
        self.ties = int(np.unique(self.hash, return_counts=True)[1].max(initial=1))  # terms that share a hash

    def find(self, words) -> tuple[np.ndarray, np.ndarray]:
        """Words that are terms, and their term numbers."""
        if not self.size or not len(words.row):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = word_hashes(words)
        low = np.searchsorted(self.hash, hashes)
        which, term = [], []
        for step in range(self.ties):
            place = np.minimum(low + step, self.size - 1)
            at = np.flatnonzero(self.hash[place] == hashes)
            at = at[same_words(words, at, self.text, self.start[place[at]], self.length[place[at]])]
            which.append(at)
            term.append(place[at])
        return np.concatenate(which), np.concatenate(term)

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(words of each text, and text, term, times of all terms found), by text and term."""
        words = words_of(column)
        which, term = self.find(words)
        pairs, times = np.unique(words.row[which] * max(self.size, 1) + term, return_counts=True)
        return words.per_row(), pairs // max(self.size, 1), pairs % max(self.size, 1), times.astype(np.int64)


def _lists(rows: np.ndarray, count: int, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.searchsorted(rows, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def count_terms(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, times) of each row with a term; `vocabulary` is a broadcast Vocabulary."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                n, rows, terms, times = vocabulary.value.counts(part.column("text"))
                made = pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(n), _lists(rows, len(n), terms, pa.int32()), _lists(rows, len(n), times, pa.int64())],
                    names=["doc_id", "n", "terms", "times"])
                yield made.filter(pa.array(n > 0))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id bigint, n bigint, terms array<int>, times array<bigint>")


def frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term: one array per task is summed."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size, np.int64)
        for batch in batches:
            found += np.bincount(np.asarray(batch.column("terms").flatten()), minlength=size)
        held = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(found[held])], names=["term", "df"])

    sums = counted.select("terms").mapInArrow(total, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(size, np.int64)
    df[np.asarray(sums.column("term"))] = np.asarray(sums.column("df"))
    return df


class BallTree:
    """Sparse integer vectors in compressed rows, in nodes of a binary tree.

    A node has its `columns` (terms that occur), the `mean` and the largest `upper` value in each of them, the `radius`,
    and two nodes `below` or its `members`.
    """

    def __init__(self, offsets: np.ndarray, terms: np.ndarray, values: np.ndarray, scale: np.ndarray, leaf: int = LEAF):
        self.offsets, self.terms, self.values, self.scale, self.leaf = offsets, terms, values, scale, leaf
        self.scaled = values * scale[terms]
        sums = np.r_[0.0, np.cumsum(self.scaled ** 2)]
        self.norm = sums[offsets[1:]] - sums[offsets[:-1]]
        self.columns, self.mean, self.upper, self.radius, self.below, self.members = [], [], [], [], [], []
        self._grow(np.arange(len(offsets) - 1))

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the entries of `rows`, and where each row's begin and end among them."""
        size = self.offsets[rows + 1] - self.offsets[rows]
        ends = np.cumsum(size)
        return np.repeat(self.offsets[rows] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0), np.r_[0, ends]

    def _distances(self, rows: np.ndarray, columns: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Distances of rows to a sparse vector, rounded up."""
        whole = np.zeros(len(self.scale))
        whole[columns] = vector
        at, ends = self.entries(rows)
        products = np.diff(np.r_[0.0, np.cumsum(self.scaled[at] * whole[self.terms[at]])][ends])
        square = self.norm[rows] + vector @ vector
        return np.sqrt(np.maximum(square - 2 * products, 0) + (square + self.norm.sum()) * 1e-12)

    def _row(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.offsets[row], self.offsets[row + 1])
        return self.terms[span], self.scaled[span]

    def _grow(self, rows: np.ndarray) -> int:
        me = len(self.radius)
        at, _ = self.entries(rows)
        columns, place = np.unique(self.terms[at], return_inverse=True)
        mean = np.bincount(place, self.scaled[at], len(columns)) / max(len(rows), 1)
        upper = np.zeros(len(columns), np.int64)
        np.maximum.at(upper, place, self.values[at])
        far = self._distances(rows, columns, mean) if len(rows) else np.zeros(1)
        self.columns.append(columns)
        self.mean.append(mean)
        self.upper.append(upper.astype(np.float64))
        self.radius.append(far.max())
        self.below.append(None)
        self.members.append(rows)
        if len(rows) > self.leaf:
            apart = self._distances(rows, *self._row(rows[np.argmax(far)]))
            nearer = apart <= self._distances(rows, *self._row(rows[np.argmax(apart)]))
            if min(nearer.mean(), 1 - nearer.mean()) <= 0.1:  # keeps the tree shallow; copies of one vector are halved
                nearer = np.zeros(len(rows), bool)
                nearer[np.argsort(apart, kind="stable")[:len(rows) // 2]] = True
            self.members[me] = None
            self.below[me] = (self._grow(rows[nearer]), self._grow(rows[~nearer]))
        return me

    def bounds(self, node: int, which: np.ndarray, queries: Queries) -> np.ndarray:
        """What no vector below `node` exceeds in its product with each of these queries."""
        columns = self.columns[node]
        at = np.ix_(columns, which)
        ball = self.mean[node] @ queries.scaled[at] + self.radius[node] * queries.norm[which]
        box = self.upper[node] @ queries.weights[at]
        return np.minimum(ball, box) * (1 + SAFE) + 1

    def scores(self, node: int, which: np.ndarray, queries: Queries) -> np.ndarray:
        """Exact products (member, query) of a leaf's vectors with these queries."""
        rows, columns = self.members[node], self.columns[node]
        at, ends = self.entries(rows)
        dense = np.zeros((len(rows), len(columns)), queries.weights.dtype)
        dense[np.repeat(np.arange(len(rows)), np.diff(ends)), np.searchsorted(columns, self.terms[at])] = self.values[at]
        return dense @ queries.weights[np.ix_(columns, which)]


class Queries:
    """Integer weights of terms (row) in queries (column), and each query's best documents so far."""

    def __init__(self, weights: np.ndarray, top: int):
        longest = int(weights.sum(axis=0).max(initial=0)) * MOST_IMPACT
        self.scale = np.sqrt(np.maximum(weights.max(axis=1, initial=0), 1).astype(np.float64))
        self.weights = weights.astype(np.float64 if longest < 1 << 53 else np.int64)
        self.scaled = weights / self.scale[:, None]
        self.norm = np.sqrt((self.scaled ** 2).sum(axis=0))
        self.top, self.best = top, [[] for _ in range(weights.shape[1])]  # heaps of (score, -doc_id)
        self.least = np.ones(weights.shape[1], np.int64)  # a lower score can't be among them any more

    def offer(self, query: int, score: int, doc_id: int) -> None:
        heap = self.best[query]
        if len(heap) < self.top:
            heapq.heappush(heap, (score, -doc_id))
        elif (score, -doc_id) > heap[0]:
            heapq.heapreplace(heap, (score, -doc_id))
        if len(heap) == self.top:
            self.least[query] = heap[0][0]


def search_tree(tree: BallTree, ids: np.ndarray, queries: Queries) -> int:
    """Offer a tree's documents to the queries; the number of leaf and query pairs that were scored."""
    waiting, leaves, whose, limits = [(0, np.arange(len(queries.best)))], [], [], []
    while waiting:
        node, which = waiting.pop()
        limit = tree.bounds(node, which, queries)
        near = limit >= queries.least[which]
        which = which[near]
        if not len(which):
            continue
        if tree.below[node] is not None:
            waiting += [(child, which) for child in tree.below[node]]
        else:
            leaves.append(np.full(len(which), node))
            whose.append(which)
            limits.append(limit[near])
    if not leaves:
        return 0
    leaves, whose, limits = np.concatenate(leaves), np.concatenate(whose), np.concatenate(limits)
    order = np.lexsort((-limits, whose))
    leaves, whose, limits = leaves[order], whose[order], limits[order]
    turn = np.arange(len(whose)) - np.searchsorted(whose, whose)
    low, step, scored = 0, FIRST_ROUND, 0
    while low <= turn.max():
        now = np.flatnonzero((turn >= low) & (turn < low + step) & (limits >= queries.least[whose]))
        now = now[np.argsort(leaves[now], kind="stable")]
        for group in np.split(now, np.flatnonzero(np.diff(leaves[now])) + 1) if len(now) else ():
            which, rows = whose[group], tree.members[leaves[group[0]]]
            found = tree.scores(leaves[group[0]], which, queries)
            scored += len(which)
            for i, q in zip(*np.nonzero(found >= queries.least[which]), strict=True):
                queries.offer(int(which[q]), int(found[i, q]), int(ids[rows[i]]))
        low, step = low + step, step * 2
    return scored


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, count = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - count)
            held.append(part)
            count += part.num_rows
            batch = batch.slice(part.num_rows)
            if count == rows:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if count:
        yield pa.Table.from_batches(held)


def search(counted: DataFrame, weights: np.ndarray, documents: int, length: int, top: int = TOP, tree: int = TREE) -> DataFrame:
    """(query, doc_id, score): the best documents of each task for every query, by column of `weights`."""
    shipped = counted.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries(shipped.value, top)
        for block in _blocks(batches, tree):
            block = block.combine_chunks()
            ids = block.column("doc_id").fill_null(NO_ID).to_numpy()
            lists = block.column("terms").combine_chunks()
            offsets = np.asarray(lists.offsets).astype(np.int64)
            offsets = offsets - offsets[0]
            terms = np.asarray(lists.flatten()).astype(np.int64)
            times = np.asarray(block.column("times").combine_chunks().flatten())
            m = 100 - 90 + (90 * block.column("n").to_numpy() * documents) // max(length, 1)
            impacts = (1_000_000_000 * times) // (1000 * times + 8 * np.repeat(m, np.diff(offsets)))
            search_tree(BallTree(offsets, terms, impacts, queries.scale), ids, queries)
        found = [(q, None if -doc == NO_ID else -doc, score) for q, heap in enumerate(queries.best) for score, doc in heap]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], names=["query", "doc_id", "score"])

    return counted.mapInArrow(run, "query bigint, doc_id bigint, score bigint")


def query_blocks(queries: DataFrame, most_cells: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of queries, in blocks of at most `most_cells` but one query at least.

    A text of n bytes has at most (n + 1) / 2 terms, so cells are bounded before any text is cut.
    """
    ids, texts, size = [], [], 0
    key = queries.schema["item_id"].dataType
    kind = pa.int64() if key.typeName() in ("long", "integer", "short", "byte") else pa.string()
    rows = queries.select("item_id", F.coalesce("text", F.lit("")).alias("text")).orderBy("item_id", "text")
    for item_id, text in rows.toLocalIterator(prefetchPartitions=False):
        more = len(text.encode("utf-8", "surrogatepass")) + 1
        if ids and item_id == ids[-1]:
            texts[-1] += " " + text
        else:
            if ids and (len(ids) + 1) * (size + more) // 2 > most_cells:
                yield pa.array(ids, kind), pa.array(texts, pa.string())
                ids, texts, size = [], [], 0
            ids.append(item_id)
            texts.append(text)
        size += more
    if ids:
        yield pa.array(ids, kind), pa.array(texts, pa.string())


def _search_block(docs: DataFrame, ids: pa.Array, texts: pa.Array, top: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = Vocabulary(texts)
    counted = stage(count_terms(docs, spark.sparkContext.broadcast(vocabulary)), "terms")
    documents, length = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = frequencies(counted, vocabulary.size)
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    _, rows, terms, _ = vocabulary.counts(texts)
    weights = np.zeros((vocabulary.size, len(texts)), np.int64)
    weights[terms, rows] = weight[terms]
    best = search(counted, weights, documents, length, top)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = spark.createDataFrame(pa.table({"query": pa.array(range(len(ids)), pa.int64()), "item_id": ids}))
    return best.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def top_documents(docs: DataFrame, queries: DataFrame, top: int = TOP, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """(item_id, rank, doc_id, score) of the `top` documents of every query."""
    queries = stage(queries.select("item_id", "text"), "queries")
    found, paths = None, []
    for ids, texts in query_blocks(queries, block_cells):
        if found is not None:
            paths.append(stage(found, "found"))
        found = _search_block(docs, ids, texts, top)
    if found is None:
        return queries.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).limit(0)
    for earlier in paths:
        found = found.unionByName(earlier)
    return found


def op13_search(spark, sf_dir: str) -> DataFrame:
    """Ten best documents of every benchmark item; see `top_documents`."""
    return top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = rf"""
WITH terms AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS MATERIALIZED (SELECT r, doc_id, len(w)::BIGINT AS n, w FROM terms WHERE len(w) > 0),
tf AS MATERIALIZED (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
size AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS len FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, size WHERE term IN (SELECT term FROM q) GROUP BY term, docs),
scores AS (SELECT q.item_id, r, d.doc_id, sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * d.n * size.docs) // size.len))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN d USING (r), size GROUP BY q.item_id, r, d.doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}"""
