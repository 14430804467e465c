"""Candidate generation, scoring with a count-based score, ranking, and truth lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nextpick.defaults import SEED
from nextpick.functions.values import sample_hash

PAIR_COLUMNS = ["target_category", "target", "has_item"]


def positives(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("target") == 1)


def entity_rows(pairs: DataFrame) -> DataFrame:
    """Back from one row per customer and code to one row per customer."""
    return pairs.drop(*PAIR_COLUMNS).distinct()


def candidates(customers: DataFrame, codes: Sequence[int]) -> DataFrame:
    """Every customer with every target code, other columns carried along.

    The codes are an array literal, so each task multiplies its own rows: no join and no
    shuffle, and the partitioning by customer is kept.
    """
    return customers.withColumn("target_category", F.explode(F.array(*[F.lit(code) for code in codes])))


def holdings(history: DataFrame) -> DataFrame:
    """Per customer: map of category code to number of contracts, and their total."""
    counts = history.groupBy("customer_id", "category_code").agg(F.count(F.lit(1)).alias("_held"))
    known = F.when(F.col("category_code").isNotNull(), F.struct("category_code", "_held"))
    return counts.groupBy("customer_id").agg(
        F.map_from_entries(F.collect_list(known)).alias("held"), F.sum("_held").alias("held_total"))


def category_shares(frame: DataFrame, code: str = "target_category") -> DataFrame:
    """(code, share) of positive pairs."""
    counts = frame.groupBy(code).agg(F.count(F.lit(1)).alias("_n"))
    return counts.select(code, (F.col("_n") / F.sum("_n").over(Window.partitionBy())).alias("share"))


def has_item(pairs: DataFrame) -> DataFrame:
    """Add 1 if the candidate is already held, else 0; needs the ``held`` map."""
    return pairs.withColumn("has_item", F.coalesce(
        F.map_contains_key("held", F.col("target_category")).cast("int"), F.lit(0)))


def affinity_score(pairs: DataFrame, shares: DataFrame) -> DataFrame:
    """Add ``score = (contracts of the code + share of the code) / (contracts + 1)``.

    `shares` has one row per code of the dictionary and is broadcast.
    """
    joined = pairs.join(F.broadcast(shares), "target_category", "left")
    own = F.coalesce(F.element_at("held", F.col("target_category")), F.lit(0))
    total = F.coalesce(F.col("held_total"), F.lit(0))
    return joined.withColumn("score", (own + F.coalesce("share", F.lit(0.0))) / (total + 1)).drop("share")


def rank_candidates(scored: DataFrame) -> DataFrame:
    """Add ``result_rank`` 1..k per customer by falling score, equal scores by code."""
    order = Window.partitionBy("customer_id").orderBy(F.desc("score"), "target_category")
    return scored.withColumn("result_rank", F.row_number().over(order))


def one_customer(customers: DataFrame, customer_id=None, seed: int = SEED) -> DataFrame:
    """Rows of one customer; without an ID, of the one with the lowest seeded hash."""
    if customer_id is None:
        order = F.struct(sample_hash(seed, "customer_id"), "customer_id")
        customer_id = customers.agg(F.min_by("customer_id", order)).scalar()
    return customers.filter(F.col("customer_id") == customer_id)


def best_candidate(scored: DataFrame) -> DataFrame:
    """Highest score per customer, equal scores by lowest code."""
    best = F.max(F.struct("score", (-F.col("target_category")).alias("_code")))
    return scored.groupBy("customer_id").agg(best.alias("_best")).select(
        "customer_id", (-F.col("_best._code")).alias("target_category"), F.col("_best.score").alias("score"))


def true_items(bought: DataFrame, item: str = "category", allowed: Sequence[str] | None = None) -> DataFrame:
    """Sorted list of the distinct items each customer bought (no longer than the dictionary).

    With `allowed`, other items do not count and a customer without an allowed one has no row.
    """
    if allowed is not None:
        bought = bought.filter(F.col(item).isin(list(allowed)))
    return bought.groupBy("customer_id").agg(F.sort_array(F.collect_set(item)).alias("true_item"))
