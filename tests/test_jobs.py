"""A whole run from extract files."""

import pytest
from pyspark.sql import functions as F

from nextpick import defaults
from nextpick.operators import models
from nextpick.plans import evaluation, jobs
from nextpick.sources import files


def write_csv(frame, path):
    rows = frame.collect()
    lines = [",".join(frame.columns)] + [",".join("" if v is None else str(v) for v in row) for row in rows]
    path.write_bytes("\n".join(lines).encode("euc-kr"))


@pytest.fixture
def extracts(spark, tmp_path):
    """Extract files of two months; categories and classes by name, one attribute sometimes missing."""
    categories = F.array(*[F.lit(c) for c in ["38.건강", "11.일반종신", "31.어린이", "34.실손", "42.변액연금"]])
    for month, first in (("202305", "2023-06-01"), ("202308", "2023-09-01")):
        ids = spark.range(1, 61).withColumn("ID", F.lpad("id", 4, "0"))
        text = [F.when(F.col("id") % 7 > 0, (F.col("id") % 3).cast("string")).alias(c)
                for c in defaults.CUSTOMER_CATEGORICAL]
        numbers = [(F.col("id") * 1.5).alias(c) for c in defaults.CUSTOMER_NUMERIC]
        write_csv(ids.select("ID", F.lit(month).alias("마감년월"), *text, *numbers).orderBy("ID"),
                  tmp_path / f"CUST_BASE_{month}.csv")
        days = F.when(F.col("n") < 4, -F.col("n") * 97 - F.col("id") % 40 - 1).otherwise((F.col("n") - 4) * 40 + F.col("id") % 20)
        new = F.lit(month == "202308") & (F.col("id") == 60) & (F.col("n") > 3)
        contracts = ids.select("*", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("n")).select(
            "ID", F.concat(F.lit("P"), "n").alias("상품코드"), F.lit("10.종신").alias("상품분류"),
            F.when(new, "99.신규").otherwise(F.element_at(categories, ((F.col("id") + F.col("n")) % 5 + 1).cast("int")))
            .alias("상품중분류2"),
            F.lit("S").alias("판매상품코드"),
            F.date_format(F.date_add(F.lit(first).cast("date"), days.cast("int")), "yyyyMMdd").alias("계약일자"))
        write_csv(contracts, tmp_path / f"PROD_BASE_{month}.csv")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    yield tmp_path
    spark.conf.unset("spark.sql.legacy.javaCharsets")


def test_make_input(spark, extracts):
    output = str(extracts / "out")
    jobs.make_input(spark, str(extracts), output, periods=4)
    labels = {row.category: row.in_target for row in jobs.read_labels(spark, output).collect()}
    assert labels == {"38.건강": True, "11.일반종신": True, "31.어린이": True, "34.실손": False, "42.변액연금": False}
    development = files.read_dataset(spark, output + "/dataset", "202305")
    later = files.read_dataset(spark, output + "/dataset", "202308")
    assert {row.target for row in development.select("target").distinct().collect()} == {0, 1}
    assert {row.target for row in later.select("target").distinct().collect()} == {1, None}
    # The customer that bought only a new category stays without a pair.
    assert [row.customer_id for row in later.filter("target IS NULL AND target_category IS NULL").collect()] == ["0060"]
    assert [tuple(row) for row in spark.read.parquet(output + "/unseen/202308").collect()] == [("99.신규", 4)]
    assert spark.read.parquet(output + "/unseen/202305").count() == 0
    assert development.agg(F.max("계약자연령"), F.min("계약자연령")).first() == (1.0, 0.0)
    assert set(jobs.target_codes(spark, output)) == {1, 2, 3}
    train, test = files.read_split(spark, output + "/splits", "train"), files.read_split(spark, output + "/splits", "test")
    assert train.join(test, "customer_id").count() == 0
    assert train.count() + test.count() == development.count()
    assert files.read_split(spark, output + "/splits", "later").count() == later.count()
    summary = spark.read.parquet(output + "/summary/202305").first()
    assert summary.num_of_target_ids == 60 and summary.percent_of_target_ids == 100.0
    assert spark.read.parquet(output + "/audit/202305").filter("step = 'loaded'").agg(F.sum("row_count")).first()[0] == 480


def test_sample_input_from_saved_profiles(spark, extracts):
    """A data set of synthetic customers, built without the extract files, that the models can be trained on."""
    source, output = str(extracts / "out"), str(extracts / "sample")
    jobs.make_input(spark, str(extracts), source, periods=4)
    audit = {(r.split, r.step): r.row_count for r in spark.read.parquet(source + "/audit/202305").collect()}
    assert audit["customers", "population_before"] == audit["customers", "population_after"] == 60
    jobs.make_sample_input(spark, source, output, 150, numeric=["계약자연령", "추정소득"])
    development = files.read_dataset(spark, output + "/dataset", "202305")
    assert development.select("customer_id").distinct().count() == 150
    assert {row.target for row in development.select("target").distinct().collect()} == {0, 1}
    assert set(jobs.target_codes(spark, output)) == {1, 2, 3}
    assert files.read_dataset(spark, output + "/dataset", "202308").select("customer_id").distinct().count() == 150
    summary = spark.read.parquet(output + "/summary/202305").first()
    assert summary.num_of_target_ids == 150
    assert jobs.train(spark, output, categorical=["계약자성별"], numeric=["계약자연령"], iterations=3) == 1
    assert jobs.evaluate(spark, output)["accuracy"].first().customers == 30


def test_violated_check_stops_the_run(spark, extracts):
    with pytest.raises(ValueError, match="expected periods"):
        jobs.make_input(spark, str(extracts), str(extracts / "out"), periods=9)


def test_evaluate_saved_splits(spark, extracts):
    output = str(extracts / "out")
    jobs.make_input(spark, str(extracts), output, periods=4)
    train, test = files.read_split(spark, output + "/splits", "train"), files.read_split(spark, output + "/splits", "test")
    sparse = ["계약자성별", "product_1", "product_2", "target_category"]
    model = models.fit_first_stage(train, sparse, ["계약자연령"], iterations=30)
    picks = test.select("customer_id").distinct().withColumn("old_item", F.lit("38.건강"))
    reports = evaluation.evaluate_split(test, train, jobs.read_labels(spark, output),
                                        lambda pairs: models.score(pairs, model, [*sparse, "계약자연령"]),
                                        picks, ["38.건강"])
    customers = test.select("customer_id").distinct().count()
    assert reports["accuracy"].first().customers == customers == reports["evaluated"].count()
    assert reports["baseline_accuracy"].first().accuracy == 100.0
    assert reports["by_category"].agg(F.sum("pred_cnt")).first()[0] == customers
    assert reports["train_test_mix"].count() == 3
    assert reports["baseline_by_category"].first().accuracy_pred == 100.0
