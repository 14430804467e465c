"""Fingerprints and components against brute force; the partition loses no pair."""

import numpy as np
import pytest
import xxhash
from llm import helpers

from nextpick.llm import simhash
from nextpick.llm.components import components

SF_DIR = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(points):
    """Smallest id reachable; ids by union-find over all pairs."""
    parent = list(range(len(points)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    fps = np.array([p for _, p in points], np.uint64)
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 2) + i + 1:
            parent[top(int(j))] = top(i)
    groups = {}
    for i, (doc_id, _) in enumerate(points):
        groups.setdefault(top(i), []).append(doc_id)
    return [min((d for d in groups[top(i)] if d is not None), default=None) for i in range(len(points))]


def test_query(spark):
    docs = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    want = dict(zip([d for d, _ in docs], plain_components(docs), strict=True))
    rows = simhash.op8_simhash(spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    assert {r.doc_id: r.fingerprint for r in rows} == {d: f"{p:016x}" for d, p in docs}
    assert {r.doc_id: r.component_id for r in rows} == want
    assert len(set(want.values())) < len(want)


def test_edges(spark):
    frame = helpers.documents(spark, [*helpers.EDGE_TEXTS, "A b C", "a\tB\x0bc"], extra=True)
    rows = sorted(((r.doc_id, r.fp & (2 ** 64 - 1), r.component_id) for r in simhash.near_duplicates(frame).collect()), key=str)
    given = [(r.doc_id, plain_fingerprint(r.text)) for r in frame.collect()]
    want = sorted(((d, p, c) for (d, p), c in zip(given, plain_components(given), strict=True)), key=str)
    assert rows == want


def test_one_of_each(spark):
    frame = helpers.documents(spark, extra=True)
    out = simhash.one_of_each(frame, ["doc_id", "text"]).collect()
    given = [(r.doc_id, plain_fingerprint(r.text)) for r in frame.collect()]
    assert sorted(r.doc_id for r in out) == sorted(set(plain_components(given)))


def test_empty_and_all_null_ids(spark):
    assert simhash.near_duplicates(helpers.documents(spark, [])).count() == 0
    assert simhash.one_of_each(helpers.documents(spark, []), ["doc_id"]).count() == 0
    frame = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(frame).collect()] == [None, None]
    assert simhash.one_of_each(frame, ["doc_id"]).count() == 1


def clustered(n, rng):
    """Random points, and chains and balls of near ones."""
    points = list(rng.integers(0, 2 ** 63, n).astype(np.uint64))
    for centre in points[:40]:
        one = centre
        for _ in range(12):
            one = one ^ np.uint64(1 << int(rng.integers(0, 64)))
            points.append(one)
            points.append(centre ^ np.uint64((1 << int(rng.integers(0, 64))) | (1 << int(rng.integers(0, 64)))))
    return np.unique(np.array(points, np.uint64))


@pytest.mark.parametrize("leaf", [4, 64, 5000])
def test_pairs_are_exact(leaf):
    points = clustered(1500, np.random.default_rng(leaf))
    want = {(i, j) for i in range(len(points)) for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 2).tolist() if i < j}
    got = {(min(a, b), max(a, b)) for x, y in simhash.linked_pairs(points, leaf=leaf) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    assert got == want


def test_pairs_meet_in_a_shard():
    points = clustered(4000, np.random.default_rng(5))
    row, shard = simhash.shards_of(simhash.build_tree(points[::3], 6), points)
    held = {}
    for r, s in zip(row.tolist(), shard.tolist(), strict=True):
        held.setdefault(r, set()).add(s)
    assert len(set(shard.tolist())) > 8 and len(row) < 6 * len(points)
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 2).tolist():
            assert held[i] & held[j]


def test_near_copies_are_compared_seldom():
    """A ball of near copies, which no vantage point splits well, costs little more than all its pairs once."""
    rng = np.random.default_rng(3)
    flips = np.uint64(1) << rng.integers(0, 64, (8000, 6)).astype(np.uint64)
    points = np.unique(np.bitwise_xor.reduce(np.where(np.arange(6) < rng.integers(0, 7, (8000, 1)), flips, np.uint64(0)), axis=1))
    pairs = [(a, b) for a, b in simhash.linked_pairs(points)]
    got = np.unique(np.concatenate([np.minimum(a, b) * len(points) + np.maximum(a, b) for a, b in pairs]))
    want = sum(int((np.bitwise_count(points[i + 1:] ^ points[i]) <= 2).sum()) for i in range(len(points)))
    assert len(got) == want and sum(len(a) for a, _ in pairs) < 4 * want


@pytest.mark.parametrize("crowd", [simhash.CROWD, 40])
def test_shards_over_spark(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "SHARD", 100)
    monkeypatch.setattr(simhash, "CROWD", crowd)
    points = clustered(1000, np.random.default_rng(9))
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(frame)).collect()}
    root = simhash.forest(len(points), simhash.linked_pairs(points))
    same = {}
    for i, p in enumerate(points.view(np.int64).tolist()):
        assert (p in roots) == bool((root == root[i]).sum() > 1)
        if p in roots:
            same.setdefault(int(root[i]), set()).add(roots[p])
    assert all(len(s) == 1 for s in same.values()) and len(set.union(*same.values())) == len(same)


def test_components_of_a_long_chain(spark):
    n = 700
    order = np.random.default_rng(2).permutation(n).tolist()
    frame = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(n + 1, n + 2), (n + 5, n + 5)], "a long, b long")
    got = {r.node: r.root for r in components(frame).collect()}
    assert {got[i] for i in range(n)} == {0} and got[n + 2] == n + 1 and n + 5 not in got
