"""Merkle manifest: against SQL, a plain tree in Python, folding, tampering and edge rows."""

import hashlib
import zlib

import compare
import pytest
from llm import helpers
from pyspark.sql import functions as F

from nextpick.llm import manifest

SF_DIR = "/root/testdata/sf0.001"
FAN = 16


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """(root, siblings of every node level by level as (left, right))."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            run = p // FAN * FAN
            paths[i].append(("".join(nodes[run:p]), "".join(nodes[p + 1:run + FAN])))
            place[i] = p // FAN
        nodes = [h(*nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)]
    return nodes[0], paths


def plain(rows):
    """Result of op11 for rows (doc_id, source, lang, n_chars, text), by lists."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found, roots = [], []
    for name in names:
        inside = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        root, paths = tree([leaf_of(r) for r in inside])
        roots.append(root)
        found.append((inside, root, paths))
    whole, over = tree(roots)
    out = []
    for (inside, subroot, paths), above in zip(found, over, strict=True):
        for row, path in zip(inside, paths, strict=True):
            path = path + above
            node = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = leaf_of([*row[:4], row[4].translate({c: c + 32 for c in range(65, 91)})])
            for left, right in path:
                node = h(left, node, right)
            out.append((row[0], leaf_of(row), subroot, whole, h(*[x for s in path for x in s]), node, node == whole))
    return out


def run(spark, tmp_path, rows, schema="doc_id long, source string, lang string, n_chars long, text string", **columns):
    frame = spark.createDataFrame(rows, schema)
    for name in columns:
        frame = frame.withColumn(name, F.lit("extra"))
    path = str(tmp_path)
    frame.write.parquet(f"{path}/documents.parquet")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(r) for r in manifest.op11_manifest(spark, path).select(*names).collect()]


def key(rows):
    return sorted(rows, key=str)


def test_query(spark):
    expected = compare.duckdb_rows(compare.connect(SF_DIR), manifest.ORACLE)
    assert compare.spark_rows(manifest.op11_manifest(spark, SF_DIR)) == expected
    assert {r[-1] for r in expected[1]} == {"True", "False"}


@pytest.mark.parametrize("counts", [[0], [1], [1, 2, 16, 17, 256, 257, 600]])
def test_sizes_of_sources(spark, tmp_path, counts):
    rows = [(i * 3, f"s{n}", "en", i, f"Text {i}") for n in counts for i in range(n)]
    assert key(run(spark, tmp_path, rows)) == key(plain(rows) if rows else [])


def test_several_rounds_of_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "DIGITS", 1)
    rows = [(i, "hot" if i % 3 else f"s{i % 37}", None, None, f"Text {i}") for i in range(900)]
    assert key(run(spark, tmp_path, rows)) == key(plain(rows))


def test_edge_rows(spark, tmp_path):
    rows = [(i, ["b", None, "", "Ä", "a"][i % 5], ["en", None][i % 2], None if i % 7 == 0 else i, t)
            for i, t in enumerate(helpers.EDGE_TEXTS)]
    rows += [rows[0], rows[0], (None, None, None, None, None), (None, "b", None, None, "X"), (5, "b", "de", 1, "same id"),
             (5, "b", "de", 1, "SAME id"), (-40, "b", None, 0, "negative")]
    rows += [(77, "copies", "en", 3, "Copy")] * 300
    assert key(run(spark, tmp_path, rows, rank=1, hash=1, tree=1, body=1, path=1)) == key(plain(rows))


def test_proofs_are_usable(spark):
    leaves = spark.createDataFrame([(i, f"s{i % 3}", h(str(i)), i * 2) for i in range(50)], "doc_id long, source string, leaf string, more long")
    rows = manifest.proofs(leaves, "source", ["doc_id"]).collect()
    assert len(rows) == 50
    for r in rows:
        node = r.leaf
        for step in r.path:
            node = h(step.left, node, step.right)
        assert node == r.root and r.more == 2 * r.doc_id
