"""Base spans against Python's matcher; what the labelers add; defined results at the edges."""

from collections import Counter

import pytest
from llm import helpers

from nextpick.llm import pii

SF_DIR = "/root/testdata/sf0.001"


def check(rows, texts):
    for row in rows:
        spans = helpers.base_spans(texts[row["doc_id"]], helpers.PII)
        joined, sha = helpers.digest(spans, helpers.PII)
        assert row["base_sha256"] == sha, texts[row["doc_id"]]
        counts = Counter(k for _, k, _ in spans)
        assert [row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]] == [counts[i] for i in range(4)]
        assert set(joined.split(",")) - {""} <= set(row["spans"].split(","))


def test_query_matches_python(spark):
    rows = pii.op1_pii(spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    check(rows, texts)


@pytest.fixture(scope="module")
def edges(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("edges")
    docs = helpers.documents(spark, extra=True)
    docs.write.parquet(f"{path}/documents.parquet")
    return pii.op1_pii(spark, str(path)).collect()


def test_edges(edges):
    texts = dict(enumerate(helpers.EDGE_TEXTS)) | {None: None}
    check([r for r in edges if r["doc_id"] is not None], texts)
    assert len(edges) == len(helpers.EDGE_TEXTS) + 3


def test_spelled_out_address_is_added(edges):
    place = helpers.EDGE_TEXTS.index("mail joe at example dot com now")
    assert "email:5:27" in next(r["spans"] for r in edges if r["doc_id"] == place)


def test_failed_checks_are_never_added(edges):
    place = next(i for i, t in enumerate(helpers.EDGE_TEXTS) if t and t.startswith("1.2.3.4 256"))
    row = next(r for r in edges if r["doc_id"] == place)
    assert "256" not in [s for s in row["spans"].split(",") if s.startswith("ip:8:")]


def test_empty_table(spark, tmp_path):
    helpers.documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert pii.op1_pii(spark, str(tmp_path)).count() == 0


def test_plan_runs_no_python(spark):
    plan = pii.op1_pii(spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_many_matches_in_a_text(spark):
    text = "é a@b.co 10.0.0.1 call +1 509 555 6973 4111 1111 1111 1111; 509-555-6973 " * 300
    frame = spark.createDataFrame([(0, text), (1, text[:-74 * 236])], "doc_id long, text string")
    for row in pii.find_personal_data(frame).collect():
        spans = helpers.base_spans(frame.filter(f"doc_id = {row.doc_id}").first().text, helpers.PII)
        assert sorted((x.s, x.k, x.e) for x in row.base) == spans
        sure = sorted((s, e) for s, _, e in spans)
        assert all(not any(a < x.e and x.s < b for a, b in sure) for x in row.added)
