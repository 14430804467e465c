"""Fingerprints: order, insertion and deletion, likeness, neighbours against plain Python."""

import hashlib

import pytest
from llm import helpers

from nextpick.llm import fingerprint
from nextpick.llm.fingerprint import Fingerprint

SF_DIR = "/root/testdata/sf0.001"


def plain(rows):
    """(doc_id, n_chars, edited_sha256) by a sorted list."""
    rows = sorted((i, t or "") for i, t in rows)
    out = []
    for k, (doc_id, text) in enumerate(rows):
        q = len(text) // 4
        new = text[:len(text) - q] + rows[(k + 1) % len(rows)][1][:q]
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), new))
    return out


def test_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = {r.doc_id: r for r in fingerprint.op7_fingerprints(spark, SF_DIR).collect()}
    assert len(got) == len(texts)
    for doc_id, n, sha, new in plain(texts):
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.edited_fingerprint == Fingerprint.of(new).text()
    assert all(r.fingerprint == Fingerprint.of(dict(texts)[i] or "").text() for i, r in got.items())
    mean = lambda c: sum(r[c] for r in got.values()) / len(got)
    assert mean("near_edited") > 0.6 > 0.3 > mean("near_next")


def test_order_insertion_and_deletion():
    a = Fingerprint.of("one.\ntwo.\nthree.\n")
    assert a.text() == Fingerprint.of("three.\none.\ntwo.\n").text() != Fingerprint.of("one.\ntwo.\ntwo.\n").text()
    b = Fingerprint.of("one.\n")
    b.insert(["two.\n", "three.\n"])
    assert a.text() == b.text()
    b.delete(["one.\n", "two.\n", "three.\n"])
    assert b.text() == Fingerprint().text()


def test_paragraphs_cover_the_text():
    for text in [t for t in helpers.EDGE_TEXTS if t]:
        assert "".join(fingerprint.PARAGRAPH.findall(text)) == text


def test_likeness_estimates_the_common_share():
    a = [f"paragraph {i}.\n" for i in range(400)]
    for share in (0.25, 0.5, 0.75):
        b = a[:int(400 * share)] + [f"other {i}.\n" for i in range(int(400 * (1 - share)))]
        assert fingerprint.likeness(Fingerprint.of("".join(a)), Fingerprint.of("".join(b))) == pytest.approx(share, abs=0.15)
    assert fingerprint.likeness(Fingerprint(), Fingerprint()) == 1
    assert fingerprint.likeness(Fingerprint(), Fingerprint.of("x")) == 0


def test_edges(spark):
    docs = helpers.documents(spark, extra=True)
    rows = fingerprint.fingerprints(docs).collect()
    assert len(rows) == len(helpers.EDGE_TEXTS) + 3
    numbered = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in rows if r.doc_id is not None) == sorted(x[:3] for x in plain(numbered))
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


@pytest.mark.parametrize("texts", [[], ["only one document here."]])
def test_few(spark, texts):
    frame = spark.createDataFrame([(5, t) for t in texts], "doc_id long, text string")
    rows = fingerprint.fingerprints(frame).collect()
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in rows] == [x[:3] for x in plain([(5, t) for t in texts])]
    assert all(r.near_next == 1 for r in rows)


def test_many_rows_over_many_buckets(spark):
    frame = spark.range(0, 5000, 3).selectExpr("id * id - 1000 doc_id", "concat('text number ', id, '. ', repeat('x', cast(id % 40 as int))) text")
    rows = {r.doc_id: r for r in fingerprint.fingerprints(frame).collect()}
    for doc_id, n, sha, _ in plain([(r.doc_id, r.text) for r in frame.collect()]):
        assert (rows[doc_id].n_chars, rows[doc_id].edited_sha256) == (n, sha)


def test_rows_that_repeat_an_id_over_batches(spark):
    frame = spark.range(300).selectExpr("cast(if(id < 200, 7, id) as long) doc_id", "concat('text ', id, '. and more of it') text")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        rows = fingerprint.fingerprints(frame).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == sorted(x[:3] for x in plain([(r.doc_id, r.text) for r in frame.collect()]))
