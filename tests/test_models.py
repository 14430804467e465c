"""Models on a small separable frame."""

import pytest
from pyspark.sql import functions as F

from nextpick.operators import candidates as cand
from nextpick.operators import evaluate, models


@pytest.fixture(scope="module")
def train(spark):
    """Customers of segment s buy code s + 1."""
    frame = spark.range(0, 240).select(
        F.col("id").alias("customer_id"), (F.col("id") % 3).cast("int").alias("segment"),
        ((F.col("id") % 10) / 10).alias("balance"))
    pairs = cand.candidates(frame, [1, 2, 3])
    return pairs.withColumn("target", (F.col("target_category") == F.col("segment") + 1).cast("int"))


def test_first_stage(train):
    model = models.fit_first_stage(train, ["segment", "target_category"], ["balance"], iterations=60)
    scored = models.score(train.drop("target"), model, ["segment", "target_category", "balance"])
    best = cand.best_candidate(scored).join(train.select("customer_id", "segment").distinct(), "customer_id")
    assert best.filter(F.col("target_category") == F.col("segment") + 1).count() > 200


def test_foreign_model(train):
    scored = models.score_with(train, lambda batch: batch["balance"] * 0.5 + batch["segment"], ["balance", "segment"])
    wrong = scored.filter(F.abs(F.col("score") - F.col("balance") * 0.5 - F.col("segment")) > 1e-9)
    assert scored.count() == 720 and wrong.count() == 0


def test_multi_class(train):
    data = evaluate.multi_class_input(cand.positives(train), 0)
    model = models.fit_multi_class(data, ["segment", "balance"], trees=5)
    found = models.predict_class(data, model, ["segment", "balance"]).join(data, "customer_id")
    assert found.filter("pred_class = label").count() == 240


def test_chain(train):
    codes = [1, 2, 3]
    wide = evaluate.multi_label_input(cand.entity_rows(train), train, codes)
    chain = models.fit_chain(wide, ["segment", "balance"], codes, iterations=2)
    scores = models.predict_chain(wide, chain, ["segment", "balance"], codes, links_per_stage=2)
    picked = evaluate.highest_label(scores, codes).join(wide, "customer_id")
    assert picked.filter(F.col("pred_code") == F.col("segment") + 1).count() == 240


def test_chain_is_the_same_however_many_links_are_fitted_at_a_time(train):
    codes = [1, 2, 3]
    wide = evaluate.multi_label_input(cand.entity_rows(train), train, codes).repartition(1).sortWithinPartitions("customer_id")
    chains = [models.fit_chain(wide, ["segment", "balance"], codes, iterations=2, parallel=n) for n in (1, 3)]
    trees = [[link.stages[-1].toDebugString.split("\n", 1)[1] for link in chain] for chain in chains]
    assert trees[0] == trees[1]
    assert [link.stages[0].getInputCols()[2:] for link in chains[1]] == [[], ["label_1"], ["label_1", "label_2"]]
