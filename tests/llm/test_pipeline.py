"""The pipeline stage by stage, on a small corpus and at the edges."""

import re

import pytest
from llm import helpers
from llm.test_packing import check
from llm.test_simhash import plain_components, plain_fingerprint

import corpus_pipeline as cp
from nextpick.llm import mixing

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after every stage."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs.collect()]
    for name, function in cp.STAGES:
        docs = cp.stage(function(spark, docs, SF_DIR), f"test-{name}")
        out.append(docs.collect())
        if name != "packing":
            assert docs.columns == cp.COLUMNS
    return out


def test_language_keeps_all_with_letters(stages):
    spoken = {r.doc_id for r in stages[0] if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in stages[1]} == spoken
    truth = {r.doc_id: r.lang for r in stages[0]}
    assert sum(r.lang == truth[r.doc_id] for r in stages[1]) > 0.95 * len(stages[1])


def test_one_of_every_group(stages):
    given = [(r.doc_id, plain_fingerprint(r.text)) for r in stages[1]]
    assert sorted(r.doc_id for r in stages[2]) == sorted(set(plain_components(given)))


def test_secrets_are_gone(stages):
    before = {r.doc_id: r for r in stages[2]}
    assert {r.doc_id for r in stages[3]} == set(before)
    for r in stages[3]:
        assert not helpers.base_spans(r.text, helpers.SECRETS) or "[SECRET]" in r.text
        if "[SECRET]" not in r.text:
            assert r == before[r.doc_id]
        else:
            assert r.n_chars == len(r.text)
            assert any(helpers.base_spans(before[r.doc_id].text, helpers.SECRETS))


def test_mix_takes_whole_rows(stages):
    before = {r.doc_id: r for r in stages[3]}
    assert all(r == before[r.doc_id] for r in stages[4])
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)
    assert abs(words(stages[4]) - words(stages[3])) < 0.02 * words(stages[3])
    copies = [sum(r.doc_id == i for r in stages[4]) for i in before]
    assert max(copies) <= mixing.MOST and min(copies) == 0


def test_packing_is_a_round_trip(stages):
    once = {r.doc_id: r.text for r in stages[4]}
    starts = {}
    for r in stages[5]:
        starts.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert {k[0] for k in starts} == set(once)
    assert sum(r.length for r in stages[5]) == sum(starts[k][0].doc_tokens * sum(r.doc_id == k[0] for r in stages[4]) for k in starts)
    places = [(r.sequence_id, r.offset + k) for r in stages[5] for k in range(r.length)]
    assert len(set(places)) == len(places)


def test_edges(spark, tmp_path):
    helpers.documents(spark, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() > 0


def test_empty(spark, tmp_path):
    helpers.documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_round_trip_check_is_strict():
    with pytest.raises(AssertionError):
        check([], {1: "a"})
