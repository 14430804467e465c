"""Scoring and evaluation of the held-out customers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextpick.operators import candidates as cand
from nextpick.operators import evaluate, labels, split
from nextpick.sources.stage import stage


def scored_candidates(customers: DataFrame, history: DataFrame, train_positives: DataFrame,
                      codes: Sequence[int]) -> DataFrame:
    """Every customer x target code with ``has_item`` and the count-based score.

    Holdings are one row per customer, so after one shuffle by customer everything up to
    the best pick runs without another.
    """
    with_holdings = customers.join(cand.holdings(history), "customer_id", "left")
    pairs = cand.has_item(cand.candidates(with_holdings, codes))
    scored = cand.affinity_score(pairs, cand.category_shares(train_positives))
    return scored.drop("held", "held_total")


def recommend(customers: DataFrame, history: DataFrame, train_positives: DataFrame, codes: Sequence[int],
              label_table: DataFrame) -> DataFrame:
    """Ranked list of all target categories by name for each of the customers."""
    ranked = cand.rank_candidates(scored_candidates(customers, history, train_positives, codes))
    named = labels.decode_category(ranked, label_table, "target_category", "prdct")
    return named.select("customer_id", "result_rank", "prdct", "score")


def items_of(items: DataFrame, customer_id) -> DataFrame:
    """Items of one customer. The ID is a value in the plan, so of bucketed items only the pages are read
    that can hold it."""
    return items.filter(F.col("customer_id") == F.lit(customer_id))


def recommend_one(customer_id, items: DataFrame, ref_month: str, train_positives: DataFrame, codes: Sequence[int],
                  label_table: DataFrame) -> DataFrame:
    """`recommend` for one customer, from a point look-up of its items; no other customer's are read."""
    spark = items.sparkSession
    history, _ = split.item_split(items_of(items, customer_id), ref_month)
    history = labels.encode_category(history.select(*split.ITEM_COLUMNS), label_table)
    customer = spark.range(1).select(F.lit(customer_id).alias("customer_id"))
    return recommend(customer, history, train_positives, codes, label_table)


def evaluate_picks(scored: DataFrame, bought: DataFrame, label_table: DataFrame) -> DataFrame:
    """Best pick per customer by name, with the true items and the hit."""
    best = labels.decode_category(cand.best_candidate(scored), label_table, "target_category", "pred_item")
    return evaluate.mark_hits(best.select("customer_id", "pred_item", "score"), cand.true_items(bought))


def evaluate_split(test: DataFrame, train: DataFrame, label_table: DataFrame,
                   score: Callable[[DataFrame], DataFrame], baseline: DataFrame | None = None,
                   allowed: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Reports of a model on modelling-table rows of held-out customers.

    `score` adds a ``score`` column to candidates: a function, or a saved model
    (`artefact.load`). Only customers that bought something are
    evaluated. `baseline` holds the older recommender's picks; `allowed` limits its truth.
    """
    positives = cand.positives(test)
    codes = labels.code_list(label_table, target_only=True)
    bought = labels.decode_category(positives.select("customer_id", "target_category"), label_table,
                                    "target_category", "category")
    scored = score(cand.candidates(cand.entity_rows(positives), codes))
    evaluated = stage(evaluate_picks(scored, bought, label_table), "evaluated")
    trained = labels.decode_category(cand.positives(train).select("target_category"), label_table,
                                     "target_category", "category")
    reports = {"evaluated": evaluated, "accuracy": evaluate.accuracy(evaluated),
               "by_category": evaluate.accuracy_by_category(evaluated),
               "train_test_mix": evaluate.train_test_mix(trained, evaluated)}
    if baseline is not None:
        old = evaluate.evaluate_baseline(cand.true_items(bought, allowed=allowed), baseline)
        reports["baseline_accuracy"] = evaluate.accuracy(old)
        reports["baseline_by_category"] = evaluate.accuracy_by_category(old)
    return reports


def most_frequent_category(history: DataFrame) -> DataFrame:
    """Stand-in for the older recommender: the category held most often, ties by name."""
    counts = history.groupBy("customer_id", "category").agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy("customer_id").agg(
        F.min(F.struct((-F.col("_n")).alias("_n"), "category")).alias("_best")).select(
        "customer_id", F.col("_best.category").alias("old_item"))
