"""Exact round trip: pieces give back every document's ids; padding; tokens as the library gives them."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm import helpers
from tokenizers import Tokenizer

from nextpick.llm import packing

SF_DIR = "/root/testdata/sf0.01"
TOKENIZER = Tokenizer.from_file(packing.default_path())
OWN = packing.Tokens(packing.default_path())


def ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'st 0\n\t é😀.,　\x1c\x85\xa0!ſ½Ⅷ")), max_size=30) | st.text(max_size=20))
def test_tokens_equal_the_librarys(text):
    assert [*OWN.ids(text), 0] == ids(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a  <|endoftext|>  b", "x" * 3000, " " * 500 + "a", "don't  won't'll", "a\n\n \nb", *[t for t in helpers.EDGE_TEXTS if t]])
def test_tokens_of_odd_texts(text):
    assert [*OWN.ids(text), 0] == ids(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab1 \n\t é.　\x1c\x85\xa0", "<|endoftext|>"]), max_size=30).map("".join))
def test_runs_of_white_space_cut_out(text):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(packing, "LONG_RUN", re.compile(packing.LONG_RUN.pattern.replace("10000", "2")))
        assert [*OWN.ids(text), 0] == ids(text)


@pytest.mark.parametrize("text", [" " * 20_000 + "a", "x" + "\n" * 20_001 + " <|endoftext|> " + "\t " * 10_000, "\u2003" * 10_000])
def test_long_runs_of_white_space(text):
    assert [*OWN.ids(text), 0] == ids(text)


def test_a_run_of_millions():
    assert len(OWN.ids(" " * 2_000_000 + "a")) == 2_000_000


def check(rows, texts):
    """Every document's ids lie in exactly one piece each; sequences have no gaps. Share of padding."""
    want = {i: ids(t) for i, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
        part = np.array(want[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(part) and r.doc_tokens == len(want[r.doc_id])
    assert pieces.keys() == want.keys()
    for doc_id, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0
            at += r.length
        assert at == len(want[doc_id])
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
        total += at
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    return padding / total, len(sequences)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = packing.op10_packing(spark, SF_DIR).collect()
    padding, _ = check(rows, texts)
    assert padding < 0.002
    again = packing.op10_packing(spark, SF_DIR).collect()
    assert sorted(rows) == sorted(again)


def test_edges(spark):
    frame = helpers.documents(spark, [*helpers.EDGE_TEXTS, "word " * 1023, "word " * 1024 + "word"], extra=True)
    texts = {r.doc_id: r.text for r in frame.collect() if r.doc_id is not None}
    unique = frame.filter("doc_id is not null").dropDuplicates(["doc_id"])
    padding, sequences = check(packing.pack(unique).collect(), texts)
    assert padding * sequences < 1.1
    # Repeated rows and null ids: each row's tokens are there, each place is taken once.
    rows = packing.pack(frame).collect()
    assert sum(r.length for r in rows) == sum(len(ids(r.text)) for r in frame.collect())
    places = {(r.sequence_id, r.offset + k) for r in rows for k in range(r.length)}
    assert len(places) == sum(r.length for r in rows)


def test_one_length_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 9)
    frame = spark.range(400).selectExpr("id doc_id", "repeat('word ', cast(if(id < 300, 700, 3 * id) as int)) text")
    texts = {r.doc_id: r.text for r in frame.collect()}
    padding, _ = check(packing.pack(frame).collect(), texts)
    assert padding < 0.01


def test_cut_texts_of_one_id_and_checksum(spark):
    """Two rows of one id whose ids have the same number and checksum are cut each for itself."""
    def text(*odd):
        words = ["word"] * 999
        words[10], words[500], words[990] = odd
        return " ".join(words)

    both = [text("thing", "research", "level"), text("company", "face", "friend")]
    crc = lambda t, low, high: zlib.crc32(np.array(ids(t)[low:high], "<u4").tobytes())
    assert crc(both[0], 0, 1000) == crc(both[1], 0, 1000) and len(ids(both[0])) == 1000
    frame = spark.createDataFrame([(1, t) for t in both] + [(i, text("a", "b", "c")) for i in range(2, 9)], "doc_id long, text string")
    pieces = sorted((r.start, r.length, r.ids_crc32) for r in packing.pack(frame).collect() if r.doc_id == 1)
    assert len(pieces) == 4 and len({size for start, size, _ in pieces if start == 0}) == 2
    places = [(start, start + length) for start, length, _ in pieces]
    low, high = sorted({b for a, b in places if a == 0})
    assert pieces in [sorted((a, b - a, crc(t, a, b)) for t, cut in zip(texts, (low, high), strict=True) for a, b in ((0, cut), (cut, 1000)))
                      for texts in (both, both[::-1])]


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_ids_of_tails_move_once(spark, threshold):
    """No size of a join's sides makes the tails' ids, the only binary column, move a second time."""
    def moved(node):
        here = node.nodeName() == "Exchange" and any(f.dataType().simpleString() == "binary" for f in node.schema().fields())
        return here + sum(moved(node.children().apply(i)) for i in range(node.children().size()))

    conf = {"spark.sql.autoBroadcastJoinThreshold": threshold, "spark.sql.adaptive.enabled": "false"}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        assert moved(packing.pack(spark.read.parquet(f"{SF_DIR}/documents.parquet"))._jdf.queryExecution().executedPlan()) == 1
    finally:
        for name in conf:
            spark.conf.unset(name)


def test_empty(spark):
    assert packing.pack(helpers.documents(spark, [])).count() == 0


def test_patterns_fill_the_window():
    combos = packing.patterns(set(range(1, 1024)))
    assert all(sum(c) == 1024 and len(c) <= 3 for c in combos) and len(set(combos)) == len(combos) > 1300


def test_solution_covers_a_histogram_made_of_patterns():
    rng = np.random.default_rng(0)
    combos = packing.patterns(set(range(1, 1024)))
    histogram = np.zeros(1025)
    for i in rng.choice(len(combos), 60):
        for length in combos[i]:
            histogram[length] += 100
    x = packing.solve(histogram, combos, 2000)
    assert (x >= 0).all()
    covered = np.zeros(1025)
    for c, n in zip(combos, x, strict=True):
        for length in c:
            covered[length] += n
    assert np.abs(covered - histogram).sum() < 0.1 * histogram.sum()


def test_plan_uses_no_more_than_there_is():
    histogram = {int(k): int(n) for k, n in zip(range(1, 1024), np.random.default_rng(1).integers(1, 90, 1023), strict=True)}
    ranges, used, sequences = packing.plan(histogram)
    assert all(used[k] <= n for k, n in histogram.items()) and sequences > 0
    spots = defaultdict(set)
    for length, first, count, _, _ in ranges:
        new = set(range(first, first + count))
        assert not spots[length] & new
        spots[length] |= new
    assert sum(used[k] * k for k in used) == 1024 * sequences > 0.5 * sum(k * n for k, n in histogram.items())
