"""Null report, category codes and min-max scaling of customer attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextpick.defaults import UNKNOWN
from nextpick.operators.joins import fits_broadcast, lookup_join
from nextpick.operators.numbering import number_rows
from nextpick.sources.stage import stage


def null_columns(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count of each column, in one pass."""
    columns = list(columns or frame.columns)
    counts = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns]
    return counts.select(F.inline(F.array(*rows)))


def select_inputs(frame: DataFrame, features: Sequence[str], dropped: Sequence[str] = (),
                  label: str = "target", key: str = "customer_id") -> DataFrame:
    """Key, model inputs without the dropped ones, and the label where the table has it."""
    names = [c for c in features if c not in set(dropped)]
    return frame.select(key, *names, *([label] if label in frame.columns else []))


def fit_category_codes(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, code): the values seen plus 'unknown', in text order from 0."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    seen = frame.select(F.inline(pairs)).filter("value IS NOT NULL")
    added = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(UNKNOWN).alias("value")) for c in columns])
    unknown = frame.sparkSession.range(1).select(F.inline(added))
    values = stage(seen.unionByName(unknown).distinct(), "values")
    numbered = number_rows(values, ["value"], "_position", group=["feature"])
    return numbered.select("feature", "value", (F.col("_position") - 1).cast("int").alias("code"))


def apply_category_codes(frame: DataFrame, encoder: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each column by its code; null and unseen values get the code of 'unknown'."""
    fallback = {row.feature: row.code for row in
                encoder.filter((F.col("value") == UNKNOWN) & F.col("feature").isin(list(columns))).collect()}
    small = encoder.isLocal() or fits_broadcast(encoder)
    kept = frame.columns
    for c in columns:
        codes = encoder.filter(F.col("feature") == c).select(F.col("value").alias("_value"),
                                                             F.col("code").alias("_code"))
        valued = frame.withColumn("_value", F.col(c).cast("string"))
        coded = (valued.join(F.broadcast(codes), "_value", "left") if small
                 else lookup_join(valued, codes, "_value", "left"))
        frame = coded.withColumn(c, F.coalesce("_code", F.lit(fallback[c]))).drop("_value", "_code")
    return frame.select(*kept)


def fit_min_max(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, low, high) of each numeric column, nulls ignored, in one pass."""
    limits = frame.agg(*[f(F.col(c).cast("double")).alias(f"{c}_{n}")
                         for c in columns for n, f in (("low", F.min), ("high", F.max))])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"{c}_low").alias("low"), F.col(f"{c}_high").alias("high"))
            for c in columns]
    return limits.select(F.inline(F.array(*rows)))


def apply_min_max(frame: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale to the learned range without clipping; a constant column becomes x - low."""
    limits = {row.feature: row for row in scaler.filter(F.col("feature").isin(list(columns))).collect()}
    scaled = {}
    for c in columns:
        low, high = limits[c].low, limits[c].high
        span = None if low is None else (high - low or 1.0)
        scaled[c] = (F.col(c).cast("double") - F.lit(low)) / F.lit(span)
    return frame.withColumns(scaled)


def vocabulary_sizes(encoded: DataFrame, categorical: Sequence[str], product_columns: Sequence[str],
                     labels: DataFrame) -> DataFrame:
    """Size of each embedding input: highest code + 1, or label count + 1 for product codes."""
    highest = encoded.agg(*[F.max(c).alias(c) for c in categorical])
    rows = [F.struct(F.lit(c).alias("feature"), (F.col(c) + 1).cast("bigint").alias("size")) for c in categorical]
    sizes = highest.select(F.inline(F.array(*rows)))
    names = F.explode(F.array(*[F.lit(c) for c in product_columns])).alias("feature")
    counts = labels.agg((F.count(F.lit(1)) + 1).alias("size"), (F.count_if("in_target") + 1).alias("_target"))
    products = counts.select(names, "size")
    target = counts.select(F.lit("target_category").alias("feature"), F.col("_target").alias("size"))
    return sizes.unionByName(products).unionByName(target)
