"""Saved models: versions, a fresh session, scores row by row, the jobs that train and evaluate."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_jobs import extracts  # noqa: F401

from nextpick.operators import candidates as cand
from nextpick.plans import artefact, jobs
from nextpick.plans.dataset import Encoders
from nextpick.sources import files

SETTINGS = artefact.Settings("202305", ["segment"], ["balance"], last_products=1, second_after=1, chain_codes=[2, 3])


@pytest.fixture(scope="module")
def train(spark):
    """Customers of segment s buy code s + 1."""
    frame = spark.range(0, 120).select(
        F.col("id").alias("customer_id"), F.lit("202305").alias("ref_month"), (F.col("id") % 3).cast("int").alias("segment"),
        ((F.col("id") % 10) / 10).alias("balance"), F.lit(0.5).alias("pre_contract_count"),
        F.lit(0.1).alias("pre_contract_month_min"), F.lit(0.9).alias("pre_contract_month_max"), F.lit(1).alias("product_1"))
    pairs = cand.candidates(frame, [1, 2, 3])
    return pairs.withColumn("target", (F.col("target_category") == F.col("segment") + 1).cast("int"))


@pytest.fixture(scope="module")
def made(spark, train):
    label_table = spark.createDataFrame([("a", 1, True), ("b", 2, True), ("c", 3, True)], "category string, code int, in_target boolean")
    categories = spark.createDataFrame([("segment", v, i) for i, v in enumerate(["x", "y", "z", "unknown"])],
                                       "feature string, value string, code int")
    ranges = spark.createDataFrame([(c, 0.0, 10.0) for c in SETTINGS.dense], "feature string, low double, high double")
    return artefact.fit(train, SETTINGS, label_table, Encoders(categories, ranges), forest=True, chain=True, iterations=10)


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def test_reloaded_model_gives_equal_rows(spark, train, made, tmp_path):
    path = str(tmp_path)
    assert artefact.save(spark, made, path, 360) == 1
    again = artefact.load(spark, path)
    assert again.settings == made.settings and again.codes == [1, 2, 3]
    pairs = train.drop("target")
    assert rows(again(pairs)) == rows(made(pairs))
    entities = cand.entity_rows(train)
    for chain in (False, True):
        assert rows(again.second_picks(entities, chain)) == rows(made.second_picks(entities, chain))
    assert rows(artefact.versions(spark, path)) == [(1, "202305", 360)]


def test_versions(spark, made, tmp_path):
    path = str(tmp_path)
    with pytest.raises(ValueError, match="no version"):
        artefact.load(spark, path)
    small = artefact.Artefact(made.settings, made.labels, made.encoders, made.first)
    assert [artefact.save(spark, small, path) for _ in range(2)] == [1, 2]
    with pytest.raises(ValueError, match="no version 7"):
        artefact.load(spark, path, 7)
    loaded = artefact.load(spark, path, 1)
    assert loaded.forest is None and list(loaded.chain) == []


def test_a_broken_save_is_not_found(spark, made, tmp_path, monkeypatch):
    path = str(tmp_path)
    small = artefact.Artefact(made.settings, made.labels, made.encoders, made.first)
    artefact.save(spark, small, path)
    with monkeypatch.context() as patch:
        patch.setattr(artefact.json, "dumps", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            artefact.save(spark, small, path)
    assert Path(path, "2").exists() and rows(artefact.versions(spark, path))[-1][0] == 1
    assert artefact.save(spark, small, path) == 2 and artefact.load(spark, path).settings == made.settings


def test_later_month_without_learning(spark, made):
    """Unseen values get the code of unknown; a customer without history has no product."""
    customers = spark.createDataFrame([(1, "202308", "x", 5.0), (2, "202308", "new", None), (3, "202308", None, 20.0)],
                                      "customer_id long, ref_month string, segment string, balance double")
    contracts = spark.sql("""SELECT * FROM VALUES (1L, 'b', DATE'2023-08-31'), (1L, 'nowhere', DATE'2023-01-05'),
        (2L, 'c', DATE'2023-09-01') AS t(customer_id, category, contract_date)""")
    found = {r.customer_id: r for r in made.encode(customers, contracts, "202308").collect()}
    assert [(found[i].segment, found[i].product_1, found[i].balance) for i in (1, 2, 3)] == [(0, 2, 0.5), (3, 0, None), (3, 0, 2.0)]
    assert found[1].pre_contract_count == 0.2 and found[2].pre_contract_count is None
    ranked = made.recommend(customers, contracts, "202308").collect()
    assert sorted((r.customer_id, r.result_rank) for r in ranked) == [(i, k) for i in (1, 2, 3) for k in (1, 2, 3)]
    assert all(0 <= r.score <= 1 for r in ranked)


FRESH = """
import json, sys
from pyspark.sql import SparkSession
from nextpick.plans import artefact, jobs
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.legacy.javaCharsets", "true")
         .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", sys.argv[3]).getOrCreate())
found = jobs.recommend(spark, sys.argv[1], sys.argv[2], "202308")
print("ROWS" + json.dumps(sorted([list(r) for r in found.collect()])))
"""


def test_jobs_train_evaluate_and_recommend_in_a_fresh_session(spark, extracts):  # noqa: F811
    output = str(extracts / "out")
    jobs.make_input(spark, str(extracts), output, periods=4)
    numeric = ["계약자연령", "추정소득"]
    assert jobs.train(spark, output, categorical=["계약자성별"], numeric=numeric, second_after=1, iterations=5) == 1
    for side in ("test", "later"):
        reports = jobs.evaluate(spark, output, side)
        bought = cand.positives(files.read_split(spark, f"{output}/splits", side)).select("customer_id").distinct().count()
        assert reports["accuracy"].first().customers == bought
    expected = sorted([list(r) for r in jobs.recommend(spark, str(extracts), output, "202308").collect()])
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    ran = subprocess.run([sys.executable, "-c", FRESH, str(extracts), output, str(extracts / "shared")], cwd=repo,
                         env={**os.environ, "PYTHONPATH": repo, "PYSPARK_PYTHON": sys.executable}, capture_output=True, text=True, timeout=300)
    line = [x for x in ran.stdout.splitlines() if x.startswith("ROWS")]
    assert line, ran.stderr[-2000:]
    assert json.loads(line[0][4:]) == expected and len(expected) == 60 * 3
