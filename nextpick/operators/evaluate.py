"""Hits, accuracy, per-category and per-label reports, ranking metrics, two-stage picks.

An *evaluated* table has one row per customer: ``pred_item``, ``true_item`` (list), ``hit``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nextpick.defaults import NO_PICK
from nextpick.functions.values import item_hit, percent
from nextpick.operators.numbering import running_total
from nextpick.sources.stage import stage


def mark_hits(picks: DataFrame, truth: DataFrame) -> DataFrame:
    """Picks joined to the true items; ``hit`` is 1 if the pick is among them."""
    return (picks.join(truth, "customer_id", "left")
            .withColumn("hit", item_hit(F.col("true_item"), F.col("pred_item"))))


def evaluate_baseline(truth: DataFrame, picks: DataFrame) -> DataFrame:
    """True items with the older recommender's pick; a customer without a pick is a miss."""
    return (truth.join(picks.select("customer_id", F.col("old_item").alias("pred_item")), "customer_id", "left")
            .withColumn("hit", item_hit(F.col("true_item"), F.col("pred_item"))))


def accuracy(evaluated: DataFrame) -> DataFrame:
    """One row: evaluated customers, hits, percent of customers whose pick was bought."""
    totals = evaluated.agg(F.count(F.lit(1)).alias("customers"),
                           F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"))
    return totals.withColumn("accuracy", percent(F.col("hits"), F.col("customers")))


def true_mix(evaluated: DataFrame) -> DataFrame:
    """Count and percent of each bought category."""
    counts = (evaluated.select(F.explode("true_item").alias("category"))
              .groupBy("category").agg(F.count(F.lit(1)).alias("true_cnt")))
    total = F.sum("true_cnt").over(Window.partitionBy())
    return counts.withColumn("true_pct", percent(F.col("true_cnt"), total))


def accuracy_by_category(evaluated: DataFrame) -> DataFrame:
    """Per bought category: true and predicted counts, hits, precision and recall.

    ``pred_pct`` is out of all picks; categories picked but never bought have no row.
    """
    picked = (evaluated.filter("pred_item IS NOT NULL").groupBy(F.col("pred_item").alias("category"))
              .agg(F.count(F.lit(1)).alias("pred_cnt"), F.sum("hit").alias("pred_true")))
    total = F.sum("pred_cnt").over(Window.partitionBy())
    picked = picked.withColumn("pred_pct", percent(F.col("pred_cnt"), total))
    joined = (true_mix(evaluated).join(picked, "category", "left")
              .na.fill(0, ["pred_cnt", "pred_true"]).na.fill(0.0, ["pred_pct"]))
    return joined.select(
        "category", "true_cnt", "true_pct", "pred_cnt", "pred_pct", "pred_true",
        percent(F.col("pred_true"), F.col("pred_cnt")).alias("accuracy_pred"),
        percent(F.col("pred_true"), F.col("true_cnt")).alias("accuracy_true"))


def train_test_mix(train_items: DataFrame, evaluated: DataFrame) -> DataFrame:
    """Category mix of the train positives (column ``category``) next to the test one."""
    counts = train_items.groupBy("category").agg(F.count(F.lit(1)).alias("train_count"))
    total = F.sum("train_count").over(Window.partitionBy())
    test = true_mix(evaluated).toDF("category", "test_count", "test_pct")
    return (counts.withColumn("train_pct", percent(F.col("train_count"), total))
            .join(test, "category", "left")
            .select("category", "train_count", "train_pct", "test_count", "test_pct"))


def multi_label_matrix(pairs: DataFrame, codes: Sequence[int]) -> DataFrame:
    """Customer x code table of targets (label_<code>), 0 where there is no pair."""
    matrix = (pairs.groupBy("customer_id").pivot("target_category", list(codes))
              .agg(F.max("target")).na.fill(0))
    return matrix.toDF("customer_id", *[f"label_{code}" for code in codes])


def multi_label_input(entities: DataFrame, pairs: DataFrame, codes: Sequence[int]) -> DataFrame:
    """Entity features with the label matrix."""
    return entities.join(multi_label_matrix(pairs, codes), "customer_id")


def multi_class_input(pairs: DataFrame, first_stage_codes: int) -> DataFrame:
    """Features with ``label``: the code moved to 0.. for codes after the first-stage ones."""
    return (pairs.filter(F.col("target_category") > first_stage_codes)
            .withColumn("label", F.col("target_category") - F.lit(first_stage_codes + 1))
            .drop("target", "target_category"))


def highest_label(scores: DataFrame, codes: Sequence[int], prefix: str = "prob_") -> DataFrame:
    """Add ``pred_code``: code of the highest of the score columns; the first one wins a tie."""
    values = F.array(*[F.col(f"{prefix}{code}") for code in codes])
    position = F.array_position(values, F.array_max(values)).cast("int")
    return scores.withColumn("pred_code", F.element_at(F.array(*[F.lit(code) for code in codes]), position))


def multi_label_report(matrix: DataFrame, codes: Sequence[int]) -> DataFrame:
    """Per label: true, predicted and hit counts, precision and recall.

    `matrix` has label_<code> columns and ``pred_code``. All counts come from one
    aggregation of the wide rows; unpivoting happens on its single result row.
    """
    sums, rows = [], []
    for code in codes:
        true, predicted = F.col(f"label_{code}") == 1, F.col("pred_code") == code
        sums += [F.count_if(true).alias(f"t{code}"), F.count_if(predicted).alias(f"p{code}"),
                 F.count_if(true & predicted).alias(f"h{code}")]
        rows.append(F.struct(F.lit(code).alias("label"), F.col(f"t{code}").alias("true_count"),
                             F.col(f"p{code}").alias("pred_count"), F.col(f"h{code}").alias("pred_true")))
    counts = matrix.agg(*sums).select(F.inline(F.array(*rows)))
    return (counts.withColumn("accuracy_pred", percent(F.col("pred_true"), F.col("pred_count")))
            .withColumn("accuracy_true", percent(F.col("pred_true"), F.col("true_count"))))


def exact_match_accuracy(matrix: DataFrame, codes: Sequence[int]) -> DataFrame:
    """Share of rows whose label vector is exactly the predicted one-hot vector."""
    wrong = [F.col(f"label_{code}") != (F.col("pred_code") == code).cast("int") for code in codes]
    match = F.lit(True)
    for different in wrong:
        match = match & ~different
    return matrix.agg(F.count(F.lit(1)).alias("customers"), F.count_if(match).alias("exact")).withColumn(
        "accuracy", F.round(F.try_divide("exact", "customers"), 4))


def multi_class_report(predictions: DataFrame, offset: int = 0) -> DataFrame:
    """Per true class: true, predicted and hit counts, precision and recall.

    `predictions` has ``true_class`` and ``pred_class``; `offset` turns classes into codes.
    """
    true = (F.col("true_class") + offset).alias("class")
    predicted = (F.col("pred_class") + offset).alias("class")
    hit = (F.col("true_class") == F.col("pred_class")).cast("int")
    truth = predictions.groupBy(true).agg(F.count(F.lit(1)).alias("true_count"))
    guess = predictions.groupBy(predicted).agg(F.count(F.lit(1)).alias("pred_count"),
                                               F.sum(hit).alias("pred_true"))
    return (truth.join(guess, "class", "left").na.fill(0, ["pred_count", "pred_true"])
            .withColumn("accuracy_pred", percent(F.col("pred_true"), F.col("pred_count")))
            .withColumn("accuracy_true", percent(F.col("pred_true"), F.col("true_count"))))


def hybrid_recommend(evaluated: DataFrame, second_picks: DataFrame, first_stage_items: Sequence[str]) -> DataFrame:
    """Keep first-stage picks in `first_stage_items`; take the second-stage pick otherwise.

    `second_picks` holds (customer_id, second_item). A customer without a second-stage pick
    gets 'z', which is a miss and has no category of its own.
    """
    first = F.col("pred_item").isin(list(first_stage_items))
    joined = evaluated.drop("hit").join(second_picks, "customer_id", "left")
    return (joined.withColumn("source", F.when(first, "first").otherwise("second"))
            .withColumn("pred_item", F.when(first, F.col("pred_item"))
                        .otherwise(F.coalesce("second_item", F.lit(NO_PICK))))
            .withColumn("hit", item_hit(F.col("true_item"), F.col("pred_item")))
            .drop("second_item"))


def log_loss(scored: DataFrame, label: str = "target", score: str = "score", epsilon: float = 1e-15) -> DataFrame:
    """Mean negative log-likelihood, scores clipped away from 0 and 1."""
    p = F.greatest(F.least(F.col(score), F.lit(1.0 - epsilon)), F.lit(epsilon))
    loss = -F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p))
    return scored.agg(F.round(F.avg(loss), 6).alias("log_loss"), F.count(F.lit(1)).alias("pairs"))


def auc(scored: DataFrame, label: str = "target", score: str = "score") -> DataFrame:
    """Area under the ROC curve; pairs with equal scores count half.

    Labels are counted per distinct score first; each score then needs only the number of
    negatives below it, a running total over the distinct scores.
    """
    counts = scored.groupBy(F.col(score).alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    ranked = running_total(stage(counts, "scores"), ["_score"], F.col("_neg"), "_through")
    wins = F.sum(F.col("_pos") * (F.col("_through") - F.col("_neg") / 2))
    totals = ranked.agg(wins.alias("_wins"), F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"))
    return totals.select(
        F.round(F.try_divide(F.col("_wins"), F.col("positives").cast("double") * F.col("negatives")), 6).alias("auc"),
        "positives", "negatives")
