"""Items in buckets by customer: the same tables as from contracts, fewer shuffles, point look-ups."""

import re

import pytest
from pyspark.sql import functions as F

from nextpick.operators import candidates as cand
from nextpick.operators import features, labels, split
from nextpick.plans import dataset, evaluation, registry
from nextpick.sources import tables
from nextpick.sources.stage import stage, stage_bucketed

SF_DIR = "/root/testdata/sf0.001"
MONTH = tables.DEVELOPMENT
EXCLUDED = (tables.EXCLUDED_CLASSES, tables.ALL_EXCLUDED)


@pytest.fixture(scope="module")
def contracts(spark):
    return dataset.stage_contracts(tables.contracts(spark, SF_DIR, registry.LAST[MONTH]))


@pytest.fixture(scope="module")
def items(contracts):
    return dataset.stage_items(contracts, *EXCLUDED)


def rows(frame):
    return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=str)


def exchanges(frame):
    """Shuffles of the plan that runs, and those by customer."""
    frame.write.format("noop").mode("overwrite").save()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((?:\w+\.)?(\w+)#", plan)


def test_snapshot_is_that_of_the_contracts(spark, contracts, items):
    customers = tables.customers(spark, SF_DIR, MONTH)
    label_table = dataset.learn_labels(contracts, MONTH, *EXCLUDED)
    assert rows(dataset.learn_item_labels(items, MONTH)) == rows(label_table)
    one = dataset.build_snapshot(customers, contracts, MONTH, label_table, *EXCLUDED)
    two = dataset.item_snapshot(customers, items, MONTH, label_table)
    for part in ("ids", "customers", "history", "target"):
        assert rows(getattr(one, part)) == rows(getattr(two, part))


def test_items_of_repeated_contracts(spark):
    day = F.lit("2023-01-01").cast("date")
    frame = spark.createDataFrame([(1, "p", "PROMO", "a"), (1, "p", "x", "a"), (1, "p", "x", "a"), (1, "q", "x", "a"), (2, "p", "x", "Brand#1")],
                                  "customer_id long, product_code string, product_class string, category string").withColumn("contract_date", day)
    found = split.items(frame, *EXCLUDED)
    assert sorted((r.customer_id, r.contracts, r.bought) for r in found.collect()) == [(1, 4, 2), (2, 1, 0)]


def test_features_need_no_shuffle_by_customer(spark, items):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        label_table = dataset.learn_item_labels(items, MONTH)
        snapshot = dataset.item_snapshot(tables.customers(spark, SF_DIR, MONTH), items, MONTH, label_table)
        assert exchanges(features.last_n_products(snapshot.history)) == []
        assert exchanges(features.history_summary(snapshot.history, MONTH)) == []
        assert exchanges(cand.holdings(snapshot.history)) == []
        # Only the customer table, which comes from outside, is dealt by customer; history and features lie there already.
        assert exchanges(dataset.raw_features(snapshot)) == ["customer_id"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_point_look_up_reads_little(spark):
    """Of a table of 200,000 rows, a customer's items are read from a few pages of one bucket."""
    frame = spark.range(200_000).select((F.col("id") % 20_000).alias("customer_id"), F.lit("a").alias("category"), F.col("id").alias("n"))
    table = stage_bucketed(frame, "points", "customer_id")
    one = evaluation.items_of(table, 1234)
    assert sorted(r.n for r in one.collect()) == list(range(1234, 200_000, 20_000))
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() < 0.02 * 200_000


def test_recommend_one_is_a_part_of_recommend(spark, items):
    label_table = dataset.learn_item_labels(items, MONTH)
    snapshot = dataset.item_snapshot(tables.customers(spark, SF_DIR, MONTH), items, MONTH, label_table)
    codes = labels.code_list(label_table, target_only=True)
    train = stage(snapshot.target.select("customer_id", F.col("category_code").alias("target_category")).filter("target_category IS NOT NULL"), "train")
    every = evaluation.recommend(snapshot.ids, snapshot.history, train, codes, label_table)
    some = snapshot.ids.limit(2).collect()
    for row in some:
        one = evaluation.recommend_one(row.customer_id, items, MONTH, train, codes, label_table)
        assert rows(one) == rows(every.filter(F.col("customer_id") == row.customer_id))
    none = evaluation.recommend_one(-5, items, MONTH, train, codes, label_table)
    assert none.count() == len(codes)
