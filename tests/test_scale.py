"""The ways taken beyond the checked sizes give the rows of the plain ones."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as contract
import compare
from nextpick.operators import candidates as cand
from nextpick.operators import encode, evaluate, extract, joins, numbering, split, targets
from nextpick.operators.joins import hot_keys, lookup_join, salted_join
from nextpick.operators.numbering import mark_lowest, number_rows, running_total
from nextpick.sources import stage


@pytest.fixture
def beyond(spark, monkeypatch):
    """Every table counts as too large for one task, one node or the driver."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(joins, "HOT_SHARE", 0.01)
    monkeypatch.setattr(numbering, "ONE_TASK_ROWS", -1)
    monkeypatch.setattr(stage, "LOCAL_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def rows(frame):
    columns = sorted(frame.columns)
    return sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has key 7, some have none, many are exact copies."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 400)
    return spark.range(0, 6000, 1, 6).select(key.cast("int").alias("key"), (F.col("id") % 5).alias("value")).cache()


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 300).select(F.col("id").cast("int").alias("key"), F.concat(F.lit("k"), "id").alias("name"))


def test_hot_keys_are_exact(skewed):
    assert hot_keys(skewed, "key", 0.05) == [7]
    assert hot_keys(skewed.filter("key IS NULL"), "key", 0.05) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, lookup, how, beyond):
    expected = rows(skewed.join(lookup, "key", how))
    assert rows(lookup_join(skewed, lookup, "key", how)) == expected
    assert rows(lookup_join(skewed, lookup, "key", how, probe=skewed.select("key"))) == expected


def test_salted_join_on_two_keys(skewed, lookup, beyond):
    left = skewed.withColumn("other", F.col("key") + 1)
    right = lookup.withColumn("other", F.col("key") + 1)
    expected = rows(left.join(right, ["key", "other"]))
    assert rows(lookup_join(left, right, ["key", "other"])) == expected


def test_lookup_is_measured(lookup, monkeypatch):
    assert joins.fits_broadcast(lookup)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 100)
    assert not joins.fits_broadcast(lookup)
    assert joins.fits_broadcast(lookup.select("key"))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 299)
    assert not joins.fits_broadcast(lookup.select("key"))


@pytest.mark.parametrize("value", ["array_repeat(key, 50)", "map(key, repeat('x', 200))", "named_struct('a', named_struct('b', repeat('x', 200)))",
                                   "array(named_struct('a', repeat('x', 200)))", "array(encode(repeat('x', 200), 'utf-8'))"])
def test_nested_lookup_is_measured(spark, lookup, monkeypatch, value):
    nested = lookup.selectExpr("key", f"{value} AS value")
    assert joins.fits_broadcast(nested)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10_000)
    assert not joins.fits_broadcast(nested)
    assert joins.fits_broadcast(nested.select("key"))
    assert joins.fits_broadcast(nested.selectExpr("key", "if(key < 0, value, null) AS value"))


def test_salts_spread_a_hot_key_and_its_copies(spark, skewed, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = salted_join(skewed, lookup, "key", [7], salts=32).filter("key = 7")
        sizes = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # All of them are copies of five rows.
    assert sum(sizes) == skewed.filter("key = 7").count()
    assert len(sizes) >= 6 and max(sizes) < sum(sizes) / 2


def test_running_total_over_ranges(spark, monkeypatch):
    frame = spark.range(0, 500).select((F.col("id") % 3).cast("string").alias("group"),
                                       F.md5(F.col("id").cast("string")).alias("place"), (F.col("id") % 7).alias("n"))
    expected = rows(running_total(frame, ["place"], F.col("n"), "total", ["group"]))
    monkeypatch.setattr(numbering, "ONE_TASK_ROWS", -1)
    assert rows(running_total(frame, ["place"], F.col("n"), "total", ["group"])) == expected
    numbered = number_rows(frame, ["place"], "number")
    assert [row.number for row in numbered.orderBy("place").collect()] == list(range(1, 501))


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_mark_lowest_equals_ranking(spark, digits):
    frame = spark.range(0, 900).select("id", (F.col("id") % 3).alias("group"), F.md5(F.col("id").cast("string")).alias("h"))
    quotas = spark.createDataFrame([(0, 37), (1, 0), (2, 1000)], "group long, quota long")
    rank = F.row_number().over(Window.partitionBy("group").orderBy("h", "id"))
    expected = rows(frame.withColumn("rank", rank).join(quotas, "group")
                    .select("group", "id", "h", (F.col("rank") <= F.col("quota")).alias("low")))
    assert rows(mark_lowest(frame, quotas, "group", "h", "id", "low", digits)) == expected


def test_sample_does_not_depend_on_prefix_or_partitioning(spark):
    positives = spark.range(0, 400).select(F.col("id").alias("customer_id"), (F.col("id") % 5 + 1).cast("int")
                                           .alias("category_code")).filter("customer_id % 7 > 0")
    expected = rows(targets.sample_negatives(positives, [1, 2, 3, 4, 5]))
    assert rows(targets.sample_negatives(positives.repartition(13), [1, 2, 3, 4, 5], digits=1)) == expected
    sides = rows(split.group_split(positives))
    assert rows(split.group_split(positives.repartition(5), digits=1)) == sides


def test_category_codes_beyond_one_task(spark, request):
    frame = spark.createDataFrame([("b", "x"), ("a", None), ("가", "Z"), ("b", "x")], "one string, two string")
    codes = encode.fit_category_codes(frame, ["one", "two"])
    expected = rows(codes), rows(encode.apply_category_codes(frame, codes, ["one", "two"]))
    request.getfixturevalue("beyond")
    codes = encode.fit_category_codes(frame, ["one", "two"])
    assert (rows(codes), rows(encode.apply_category_codes(frame, codes, ["one", "two"]))) == expected


def test_training_extract_beyond_broadcast(spark, request):
    population = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 30, "c")],
                                       "id long, customer_id long, identity_code string")
    contracts = spark.range(0, 300).select(
        F.when(F.col("id") % 3 == 0, 20).when(F.col("id") % 10 == 1, 10).otherwise(99).cast("long").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("identity_code"),
        F.col("id").alias("product_code"), F.to_date(F.lit("2000-01-05")).alias("contract_date"))
    expected = rows(extract.training_extract(population, contracts, "199912", ["product_code"]))
    assert (3, None) in expected
    request.getfixturevalue("beyond")
    assert rows(extract.training_extract(population, contracts, "199912", ["product_code"])) == expected


SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["category_codes", "encoded_features", "modelling_table", "group_split", "hit_accuracy",
                                  "auc", "eligible_contracts", "product_reference", "training_extract", "serving_input",
                                  "baseline_picks", "monthly_product_names"])
def test_queries_beyond_broadcast(spark, beyond, name):
    found = compare.spark_rows(contract.queries()[name](spark, SF_DIR))
    assert found == compare.duckdb_rows(compare.connect(SF_DIR), contract.oracle_sql()[name])


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_candidates_and_best_pick_need_one_shuffle(spark):
    history = spark.range(0, 100).select((F.col("id") % 9).alias("customer_id"), (F.col("id") % 4 + 1).cast("int")
                                         .alias("category_code"))
    shares = cand.category_shares(history.withColumnRenamed("category_code", "target_category"))
    customers = cand.holdings(history)
    best = cand.best_candidate(cand.affinity_score(cand.candidates(customers, [1, 2, 3, 4]), shares))
    text = plan(best)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert text.count("Exchange hashpartitioning(customer_id") == 2  # by customer and code, then by customer


def test_rank_limit_runs_before_the_shuffle(spark):
    history = spark.createDataFrame([(1, "2000-01-01", 1)], "customer_id long, contract_date string, category_code int")
    from nextpick.operators import features
    assert plan(features.last_n_products(history)).count("WindowGroupLimit") == 2
