"""Targets, knapsack and takes against plain Python versions."""

import itertools
import re
from collections import defaultdict

import numpy as np
import pytest
from llm import helpers

from nextpick.llm import mixing

SF_DIR = "/root/testdata/sf0.01"


def plain_targets(sizes):
    """Resharing step by step, as the contract says it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(order)
    budget = float(total)
    while open_:
        whole = sum(weight[s] for s in open_)
        share = {s: budget * weight[s] / whole for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            return target | share
        for s in above:
            target[s] = 3.0 * sizes[s]
            budget -= target[s]
            open_.discard(s)
    return target


def test_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = mixing.op6_mixing(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text))
        assert r.taken in {k * r["size"] for k in range(4)}
        sizes[docs[r.doc_id].source] += r["size"]
        taken[docs[r.doc_id].source] += r.taken
    want = plain_targets(sizes)
    for r in rows:
        s = docs[r.doc_id].source
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    again = {(r.doc_id, r.taken) for r in mixing.op6_mixing(spark, SF_DIR).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, "c": 1000}, {"a": 0, "b": 5}, {"a": 0}, {None: 100, "b": 3, "c": 1, "d": 7, "e": 900}, {}])
def test_targets(spark, sizes):
    totals = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(totals).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s])


@pytest.mark.parametrize("seed", range(12))
def test_knapsack_finds_the_best_sum(seed):
    rng = np.random.default_rng(seed)
    sizes = np.sort(rng.choice(np.arange(1, 40), 4, replace=False))
    counts = rng.integers(1, 4, 4)
    budget = int(rng.integers(1, (sizes * counts).sum() + 5))
    best = max(t for t in (int((sizes * np.array(c)).sum()) for c in itertools.product(*[range(c + 1) for c in counts])) if t <= budget)
    found = mixing._knapsack(sizes, counts, budget)
    assert sum(int(sizes[i]) * n for i, n in found) == best
    assert all(sum(n for j, n in found if j == i) <= counts[i] for i in range(4))


def test_large_counts_meet_the_budget():
    sizes, counts = np.array([3, 50, 700, 20_000]), np.array([10_000_000, 2_000_000, 3_000_000, 5_000])
    budget = 987_654_321
    taken = mixing.fit_counts(sizes, counts, budget)
    assert (taken <= counts).all() and (taken >= 0).all()
    assert int((taken * sizes).sum()) == budget


@pytest.fixture(scope="module")
def edges(spark):
    return helpers.documents(spark, extra=True)


def test_edges(spark, edges):
    rows = mixing.mix(edges).collect()
    assert len(rows) == len(helpers.EDGE_TEXTS) + 3
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert r.taken <= 3 * r["size"]
    want = plain_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= max(r["size"] for r in rows if r.source == s) for s in sizes)


def test_mixed_rows_repeat_as_taken(spark, edges):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = sum(r.taken for r in mixing.mix(edges).collect())
    out = mixing.mixed(edges)
    assert out.columns == edges.columns
    assert sum(words(r.text) for r in out.collect()) == want


def test_mixed_rows_of_one_key(spark):
    frame = spark.range(30).selectExpr("cast(null as long) doc_id", "concat('two ', id % 3) text", "if(id < 10, 'a', 'b') source")
    taken = [r.taken for r in mixing.mix(frame).collect()]
    out = mixing.mixed(frame).groupBy("source").count().collect()
    assert len(taken) == 30 and max(taken) <= 6
    assert {r.source: r["count"] for r in out} == {"a": 10, "b": 20}
    uneven = frame.filter("source = 'b' or text = 'two 0'")  # 4 and 20 rows; targets 8 and 16
    assert {r.source: r["count"] for r in mixing.mixed(uneven).groupBy("source").count().collect()} == {"a": 8, "b": 16}


def test_one_length_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    frame = spark.range(300).selectExpr("id doc_id", "'one two three' text", "if(id < 100, 'a', 'b') source")
    rows = mixing.mix(frame).collect()
    taken = {s: sum(r.taken for r in rows if r.source == s) for s in "ab"}
    assert taken == {"a": 300, "b": 600} and {r.taken % 3 for r in rows} == {0}


def test_empty(spark):
    assert mixing.mix(helpers.documents(spark, [])).count() == 0
    assert mixing.mixed(helpers.documents(spark, [])).count() == 0
