"""Byte networks: scoring equals the trained network, held-out accuracy, windows, edges."""

import numpy as np
import pytest
from llm import helpers
from pyspark.sql import functions as F

from nextpick.llm import bytecnn, language, quality

SF_DIR = "/root/testdata/sf0.01"


def slow_logits(net, window):
    """One window by the definition."""
    pooled = []
    for width, weights in zip(bytecnn.WIDTHS, net.filters, strict=True):
        answers = [sum(net.embedding[window[i + k]] @ weights[k] for k in range(width)) for i in range(len(window) - width + 1)]
        pooled.append(np.max(answers, axis=0))
    return bytecnn._head(net, np.concatenate(pooled)[None])[2][0]


@pytest.mark.parametrize("length", [0, 1, 2, 3, 5, 30, 31, 32])
def test_tables_give_the_networks_answer(length):
    rng = np.random.default_rng(length)
    windows = rng.integers(0, 256, (40, 32)).astype(np.uint8)
    net = bytecnn.train(windows, rng.integers(0, 3, 40), 3, n_filters=4, dim=4, n_hidden=6, epochs=1)
    raw = rng.integers(1, 256, 64).astype(np.uint8)
    got = bytecnn.Scorer(net).logits(raw, np.array([3]), np.array([3 + length]))[0]
    window = np.zeros(32, np.uint8)
    window[:length] = raw[3:3 + length]
    assert np.allclose(got, slow_logits(net, window), atol=1e-4)


def test_gradients_point_downhill():
    rng = np.random.default_rng(0)
    windows = rng.integers(97, 100, (400, 24)).astype(np.uint8)
    labels = (windows[:, 5] == 97).astype(int)
    windows[labels == 1, 10:14] = np.frombuffer(b"zxzx", np.uint8)
    net = bytecnn.train(windows, labels, 2, n_filters=4, epochs=6)
    n = len(windows)
    logits = bytecnn.Scorer(net).logits(windows.ravel(), np.arange(n) * 24, np.arange(1, n + 1) * 24)
    assert (logits.argmax(axis=1) == labels).mean() > 0.97


@pytest.mark.parametrize(("window", "stride"), [(8, 8), (8, 6)])
def test_windows_cover_every_byte(window, stride):
    starts = np.array([0, 0, 1, 9, 40])
    ends = np.array([0, 1, 9, 40, 57])
    row, first, last = bytecnn.cut(starts, ends, window, stride)
    for i in range(len(starts)):
        seen = set()
        for a, b in zip(first[row == i], last[row == i], strict=True):
            assert b - a <= window
            seen |= set(range(a, b))
        assert seen == set(range(starts[i], ends[i]))
        assert (row == i).any()


def test_language_held_out_accuracy(spark):
    got = {r.doc_id: r for r in language.op2_language(spark, SF_DIR).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    held = [i for i in truth if got[i].held_out]
    assert len(got) == len(truth) and 0.15 < len(held) / len(truth) < 0.35
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_quality_held_out_auc(spark):
    rows = quality.op3_quality(spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").filter("held_out").collect()
    good, bad = [[r.score for r in rows if r.quality == q] for q in (1, 0)]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_runs_agree(spark):
    one, two = ({r.doc_id: (r.lang_pred, r.score) for r in language.op2_language(spark, "/root/testdata/sf0.001").collect()} for _ in range(2))
    assert one == two


def test_language_edges(spark, tmp_path):
    texts = [*helpers.EDGE_TEXTS, "12345 !!", "x" * 200_000]
    helpers.documents(spark, texts, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    rows = language.op2_language(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        if r.doc_id is not None:
            spoken = any(c.isalpha() for c in texts[r.doc_id] or "")
            assert (r.lang_pred == "und") == (not spoken)
            assert r.lang_pred in ("und", "en", "de")


@pytest.mark.parametrize("texts", [[], ["no language at all"]])
def test_nothing_to_learn_from(spark, tmp_path, texts):
    frame = helpers.documents(spark, texts).selectExpr("doc_id", "text", "cast(null as string) lang", "source", "n_chars")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.lang_pred for r in language.op2_language(spark, str(tmp_path)).collect()} <= {"und"}
    assert {r.score for r in quality.op3_quality(spark, str(tmp_path)).collect()} <= {0.5}


def test_quality_edges(spark, tmp_path):
    helpers.documents(spark, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, None) for i in range(len(helpers.EDGE_TEXTS))] + [(None, 1, 1), (3, None, 0)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = quality.op3_quality(spark, str(tmp_path)).collect()
    assert len(rows) == len(helpers.EDGE_TEXTS) + 3
    assert all(0 <= r.score <= 1 for r in rows)


def test_every_language_is_learned(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(80):
        own = ["".join(chr(0x4E00 + 40 * i + c) for c in rng.integers(0, 40, 6)) for _ in range(12)]
        rows += [(" ".join(rng.choice(own, 8)), f"l{i:02}") for _ in range(20 if i < 64 else 6)]
    rows += [("one text only", "zz")] * 300
    frame = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(language, "MOST_ROWS", 400)
    learned = language.sample(frame, "lang", 600, 400, 1024)
    assert {lang for lang, _ in learned} == {lang for _, lang in rows} and len(learned) <= 400
    net, langs = language.fit(frame)
    assert langs == sorted({lang for _, lang in rows})
    # A share that no row of a label falls into.
    one = spark.createDataFrame([("copy", "x")] * 100_000 + [("other words", "y")], "text string, lang string")
    assert {lang for lang, _ in language.sample(one, "lang", 1, 2, 64)} == {"x", "y"}


def test_quality_learns_from_texts_without_letters(spark):
    rows = [(f"good words number {i} of many", 1) for i in range(20)] + [(None, 0), ("", 0), ("1234 567", 0), ("$$ -- !!", 0)]
    frame = spark.createDataFrame(rows, "text string, quality int")
    learned = language.sample(frame, "quality", 100, 200, 64)
    assert {t for q, t in learned if q == "0"} == {"", "1234 567", "$$ -- !!"}
    assert {q for q, _ in language.sample(frame, "quality", 100, 200, 64, spoken=True)} == {"1"}
    got = {r.text: r.score for r in quality.score(frame, quality.fit(frame), ("text",)).collect()}
    assert got["1234 567"] < 0.5 and got[None] < 0.5 < got["good words number 3 of many"]


@pytest.mark.parametrize("module", [language, quality])
def test_windows_of_a_snippet_are_a_parameter(spark, monkeypatch, module):
    seen = []
    monkeypatch.setattr(module, "train", lambda windows, *rest, **more: seen.append(len(windows)))
    monkeypatch.setattr(module, "SNIPPET_WINDOWS", 6)
    rows = [("many words of one text " * 100, "a", 0), ("viele Worte eines Textes " * 100, "b", 1)]
    module.fit(spark.createDataFrame(rows, "text string, lang string, quality int"))
    assert seen == [12]


def test_copies_do_not_starve_a_language(spark):
    """A language whose rows are copies of a few texts gives as many snippets as it has texts, or as are wanted."""
    many = spark.range(80_000).select(F.concat(F.lit("text number "), (F.col("id") % 2_000).cast("string")).alias("text"), F.lit("xx").alias("lang"))
    few = spark.range(2_000).select(F.concat(F.lit("other words "), F.col("id").cast("string")).alias("text"), F.lit("yy").alias("lang"))
    found = language.sample(many.unionByName(few), "lang", 600, 10_000, 64)
    counts = {name: sum(label == name for label, _ in found) for name in ("xx", "yy")}
    assert counts == {"xx": 600, "yy": 600}
    assert len(set(found)) == len(found)
