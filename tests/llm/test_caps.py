"""Links, counts and components of vectors against brute force."""

import math

import numpy as np
import pytest

from nextpick.llm import caps

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """{place: (n_links, places linked)} by all pairs of a label."""
    units = []
    for _, v, label in rows:
        good = v is not None and len(v) and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        u = np.array(v, np.float64) if good else None
        units.append(None if u is None else u / np.linalg.norm(u))
    linked = [set() for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.93:
                linked[i].add(j)
                linked[j].add(i)
    return linked


def roots(rows, linked):
    out = [None] * len(rows)
    for i in range(len(rows)):
        if out[i] is None:
            seen, open_ = {i}, [i]
            while open_:
                for k in linked[open_.pop()] - seen:
                    seen.add(k)
                    open_.append(k)
            low = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
            for k in seen:
                out[k] = low
    return out


def planted(n, seed, labels=3, dim=64):
    """Random vectors with near ones at cosines around the threshold, and copies."""
    rng = np.random.default_rng(seed)
    rows = []
    while len(rows) < n:
        base, label = rng.standard_normal(dim), int(rng.integers(0, labels))
        rows.append((base, label))
        for _ in range(int(rng.integers(0, 4))):
            noise = rng.standard_normal(dim) * rng.choice([0.05, 0.2, 0.3, 0.38, 0.45])
            rows.append((base + noise, label))
        if rng.random() < 0.1:
            rows += [(base, label)] * 3
    return [(i, v.astype(np.float32).tolist(), label) for i, (v, label) in enumerate(rows[:n])]


def test_recall_and_precision(spark):
    rows = planted(3000, 1)
    linked = plain(rows)
    got = {r.vec_id: r for r in caps.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    found, true = sum(got[i].n_links for i in range(len(rows))), sum(map(len, linked))
    assert all(got[i].n_links <= len(linked[i]) for i in range(len(rows)))
    assert true > 1500 and found / true > 0.98
    want = roots(rows, linked)
    assert np.mean([got[i].component_id == want[i] for i in range(len(rows))]) > 0.98
    assert all(got[i].kept == (got[i].component_id == i) for i in range(len(rows)))


@pytest.mark.parametrize(("block", "n"), [(16, 300), (2048, 300)])
def test_dense_group_is_counted_whole(spark, monkeypatch, block, n):
    monkeypatch.setattr(caps, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    centre = rng.standard_normal(64)
    rows = [(i, (centre + 0.1 * rng.standard_normal(64)).astype(np.float32).tolist(), 1) for i in range(n)]
    linked = plain(rows)
    got = {r.vec_id: r for r in caps.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(r.n_links for r in got.values()) / sum(map(len, linked)) > 0.98
    assert {r.component_id for r in got.values()} == {0}


def test_edges(spark):
    one, nan, inf = [1.0] * 64, float("nan"), float("inf")
    rows = [(0, one, 1), (1, one, 1), (2, one, None), (3, None, 1), (4, [0.0] * 64, 1), (5, [nan] * 64, 1), (6, [inf] * 64, 1),
            (7, [None] + [1.0] * 63, 1), (8, [], 1), (9, [2.0] * 64, 1), (9, [2.0] * 64, 1), (None, one, 1), (None, None, None),
            (10, [1.0, 0.0], 1), (11, [1.0, 0.1], 1), (12, [3.0], 2), (13, [4.0], 2), (14, [-4.0], 2), (15, one, 2), (16, [1e38] * 64, 1), (17, [1e-40] * 64, 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("key", "dim", "copies", "filter", "side", "root"):
        frame = frame.selectExpr("*", f"'x' {name}")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in caps.near_duplicates(frame).collect()), key=str)
    linked = plain(rows)
    want = sorted(zip([r[0] for r in rows], map(len, linked), roots(rows, linked), strict=True), key=str)
    assert got == want


def test_query_has_every_vector(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = {r.vec_id: r for r in caps.op9_caps(spark, SF_DIR).collect()}
    linked = plain(rows)
    assert len(got) == len(rows)
    assert sum(r.n_links for r in got.values()) >= 0.9 * sum(map(len, linked))


def test_empty(spark):
    assert caps.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(("count", "dim"), [(100, 64), (100_000, 64), (50_000, 384), (1000, 12)])
def test_decoding_is_complete_and_as_frequent_as_planned(count, dim):
    cap, words = caps.parameters(count, dim)
    code = caps.Code(dim, words, 0)
    rng = np.random.default_rng(0)
    x = rng.standard_normal((200, dim))
    y = 0.93 * x / np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((200, dim))
    z -= (z * x).sum(axis=1, keepdims=True) / (x * x).sum(axis=1, keepdims=True) * x
    y += math.sqrt(1 - 0.93 ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sets = []
    for units in (x, y):
        row, filters = caps.decode(units, cap, words)
        sets.append([set(filters[row == i].tolist()) for i in range(len(units))])
    parts = [x[:5] @ code.rotation[:, p] @ w.T for p, w in zip(code.parts, code.words, strict=True)]
    whole = (parts[0][:, :, None] + parts[1][:, None, :]).reshape(5, -1)
    own = [{f // caps.CODES for f in s if f % caps.CODES == 0} for s in sets[0][:5]]
    assert [set(np.flatnonzero(s >= cap).tolist()) for s in whole] == own
    assert np.mean([bool(a & b) for a, b in zip(*sets, strict=True)]) > 0.97
