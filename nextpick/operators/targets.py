"""Target pairs, sampled negatives and the modelling table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nextpick.defaults import NEGATIVE_RATIO, SEED
from nextpick.functions.values import percent, sample_hash
from nextpick.operators.numbering import mark_lowest


def positive_pairs(target: DataFrame) -> DataFrame:
    """Distinct (customer_id, category_code) bought in the target window.

    A category without a code cannot be a target; `unseen_categories` reports them.
    """
    return target.select("customer_id", "category_code").filter("category_code IS NOT NULL").distinct()


def sample_negatives(positives: DataFrame, codes: Sequence[int], ratio: int = NEGATIVE_RATIO,
                     seed: int = SEED, digits: int = 4) -> DataFrame:
    """Per code, ``min(non-holders, ratio x holders)`` customers that did not buy it.

    The population is the customers that bought something. Codes not held come from one
    array per customer (no longer than the dictionary), so neither an anti join nor a
    shuffle of all customer-code pairs is needed.
    """
    held = positives.groupBy("customer_id").agg(F.collect_set("category_code").alias("_held"))
    missing = F.array_except(F.array(*[F.lit(code) for code in codes]), F.col("_held"))
    absent = (held.select("customer_id", F.explode(missing).alias("category_code"))
              .withColumn("_hash", sample_hash(seed, "customer_id", "category_code")))
    quotas = positives.groupBy("category_code").agg((F.count(F.lit(1)) * ratio).alias("quota"))
    marked = mark_lowest(absent, quotas, "category_code", "_hash", "customer_id", "_sampled", digits)
    return marked.filter("_sampled").select("customer_id", "category_code")


def target_pairs(positives: DataFrame, negatives: DataFrame | None = None) -> DataFrame:
    """(customer_id, target_category, target): positives 1, negatives 0 where given."""
    pairs = positives.withColumn("target", F.lit(1))
    if negatives is not None:
        pairs = pairs.unionByName(negatives.withColumn("target", F.lit(0)))
    return pairs.withColumnRenamed("category_code", "target_category")


def category_mix(frame: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Count and percent of total per value of `column`, most frequent first."""
    counts = frame.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("percent", percent(F.col("count"), total, digits)).orderBy(F.desc("count"), column)


def target_summary(customers: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: pairs, positives, customers with a target, their percentages, target mix."""
    totals = pairs.agg(F.count(F.lit(1)).alias("num_of_rows"),
                       F.count_if(F.col("target") == 1).alias("num_of_target"),
                       F.count_distinct(F.when(F.col("target") == 1, F.col("customer_id")))
                       .alias("num_of_target_ids"))
    mix = category_mix(pairs.filter("target = 1"), "target_category")
    by_code = F.sort_array(F.collect_list(F.struct("target_category", "count", "percent")))
    ids = customers.agg(F.count_distinct("customer_id")).scalar()
    return totals.select(
        "num_of_rows", "num_of_target",
        percent(F.col("num_of_target"), F.col("num_of_rows")).alias("percent_of_target"),
        "num_of_target_ids",
        percent(F.col("num_of_target_ids"), ids).alias("percent_of_target_ids"),
        mix.agg(by_code).scalar().alias("target_mix"))


def modelling_table(features: DataFrame, pairs: DataFrame) -> DataFrame:
    """Encoded features left-joined to their target pairs: one row per customer and code."""
    return features.join(pairs, "customer_id", "left")
