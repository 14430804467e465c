"""Decontamination: against SQL and plain Python, both ways of the window set, removal, edge texts."""

import hashlib
import random
import re

import compare
import pyarrow as pa
import pytest
from llm import helpers
from pyspark.sql import functions as F

from nextpick.llm import decontaminate as dec
from nextpick.llm import tokens

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(texts, benchmark, length=10):
    """(n_words, items, hit places) of each text."""
    windows = []
    for item, text in benchmark:
        w = words(text)
        size = min(len(w), length)
        windows += [("" if item is None else str(item), w[i:i + size]) for i in range(len(w) - size + 1) if size]
    out = []
    for text in texts:
        w, hit, items = words(text), set(), set()
        for item, window in windows:
            for i in range(len(w) - len(window) + 1):
                if w[i:i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    items.add(item)
        out.append((len(w), sorted(items), sorted(hit)))
    return out


def found(rows):
    return [(r.n_words, list(r["items"]), [i for s in r.spans for i in range(s.start, s.end)]) for r in rows]


def cases():
    rng = random.Random(3)
    vocab = ["a", "b", "ü", "1", "Zed", "o'k", "😀"]
    text = lambda n: " ,\n"[rng.randrange(3)].join(rng.choice(vocab) for _ in range(n))
    benchmark = [(i, text(n)) for i, n in enumerate([0, 1, 3, 9, 10, 11, 25])]
    benchmark = [b for b in benchmark if b[0] != 1] + [(1, "rareword"), (None, "null id item"), (3, benchmark[2][1]), (90, None), (90, "!!")]
    docs = [text(rng.randrange(60)) for _ in range(60)]
    docs += [text(5) + " " + (benchmark[6][1] or "") + " tail", "RAREWORD", "x null ID item y", *helpers.EDGE_TEXTS]
    return docs, benchmark


def frames(spark, docs, benchmark):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
    return d, spark.createDataFrame(benchmark, "item_id long, text string")


def test_query(spark):
    assert compare.spark_rows(dec.op12_decontamination(spark, SF_DIR)) == compare.duckdb_rows(compare.connect(SF_DIR), dec.ORACLE)


@pytest.mark.parametrize("most_bytes", [None, 0])
def test_against_plain(spark, most_bytes):
    docs, benchmark = cases()
    d, b = frames(spark, docs, benchmark)
    rows = sorted(dec.scan(d, b, ["doc_id"], most_bytes=most_bytes, bits=1 << 12).collect(), key=lambda r: r.doc_id)
    want = plain(docs, benchmark)
    assert found(rows) == want
    assert any(w[2] for w in want) and not all(w[2] for w in want)


@pytest.mark.parametrize("most_bytes", [None, 0])
def test_repeated_rows_null_ids_and_clashing_columns(spark, most_bytes):
    docs = helpers.documents(spark, ["one two three", "none"], extra=True)
    for name in ("item", "items", "gram", "n_words", "_text"):
        docs = docs.withColumn(name, F.lit("extra"))
    bench = spark.createDataFrame([(1, "two three", 5)], "item_id long, text string, spans long")
    rows = dec.scan(docs, bench, ["doc_id"], most_bytes=most_bytes).collect()
    assert sorted((str(r.doc_id), r.n_words, len(r.spans)) for r in rows) == [
        ("0", 3, 1), ("1", 1, 0), ("1", 1, 0), ("None", 0, 0), ("None", 1, 0)]


@pytest.mark.parametrize("most_bytes", [None, 0])
def test_empty_tables(spark, most_bytes):
    d, b = frames(spark, ["some words"], [(1, "x")])
    assert dec.scan(d.limit(0), b, ["doc_id"], most_bytes=most_bytes).count() == 0
    assert found(dec.scan(d, b.limit(0), ["doc_id"], most_bytes=most_bytes).collect()) == [(2, [], [])]


@pytest.mark.parametrize("most_bytes", [None, 0])
def test_remove(spark, most_bytes):
    docs = ["Keep this, then: Alpha-beta; GAMMA delta! And é that.", None, "", "alpha beta gamma delta", "clean text"]
    d, b = frames(spark, docs, [(7, "alpha beta gamma delta")])
    d = d.withColumn("spans", F.lit(1))
    rows = {r.doc_id: r.text for r in dec.remove(d, b, most_bytes=most_bytes).collect()}
    assert rows == {0: "Keep this, then: ! And é that.", 1: None, 2: "", 3: "", 4: "clean text"}
    left = dec.remove(d, b, documents=True, most_bytes=most_bytes)
    assert left.columns == d.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 4]


def test_long_text_and_small_pieces(spark, monkeypatch):
    rng = random.Random(1)
    long = " ".join(str(rng.randrange(1000)) for _ in range(200_000))
    item = " ".join(long.split()[150_000:150_012])
    monkeypatch.setattr(tokens, "BLOCK", 1 << 10)
    w = tokens.words_of(pa.array([long, "x" * 5000, None, item]))
    assert [len(words(t)) for t in (long, "x" * 5000, None, item)] == w.per_row().tolist()
    grams = dec.Grams(["7"], pa.array([item]))
    items, spans = dec._scan_piece(w, grams)
    assert items == [["7"], [], [], ["7"]] and spans[0] == [{"start": 150_000, "end": 150_012}]


def test_hashes_decide_nothing(spark, monkeypatch):
    """With a hash that is the same for all windows, comparing the words still gives right results."""
    import numpy as np
    monkeypatch.setattr(dec, "window_hashes", lambda h, n: np.zeros(max(0, len(h) - n + 1), np.uint64))
    docs, benchmark = cases()
    w = tokens.words_of(pa.array(docs))
    ids = ["" if i is None else str(i) for i, _ in benchmark]
    items, spans = dec._scan_piece(w, dec.Grams(ids, pa.array([t for _, t in benchmark])))
    assert [(i, [k for s in p for k in range(s["start"], s["end"])]) for i, p in zip(items, spans)] == [x[1:] for x in plain(docs, benchmark)]


def test_digest_of_items(spark):
    rows = dec.op12_decontamination(spark, SF_DIR).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r.items_sha256 == empty) == (r.n_items == 0) == (not r.contaminated) for r in rows)
    assert any(r.contaminated for r in rows)
