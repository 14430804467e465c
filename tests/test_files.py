"""Readers and round trips."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from nextpick.operators import encode, profile
from nextpick.sources import files, stage


@pytest.fixture
def korean(spark):
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    yield
    spark.conf.unset("spark.sql.legacy.javaCharsets")


CONTRACTS = ("ID,상품코드,상품분류,상품중분류2,판매상품코드,계약일자\n"
             "0012,A1,10.종신,11.일반종신,P1,20230601\n0012,A1,10.종신,,P1,20230601\n7,A2,10.종신,38.건강,NaN,20230602\n")


def test_contracts_in_korean_charset(spark, korean, tmp_path):
    path = tmp_path / "contracts.csv"
    path.write_bytes(CONTRACTS.encode("euc-kr"))
    found = files.read_contracts(spark, str(path)).collect()
    assert [(r.customer_id, r.category, r.contract_date) for r in found] == [("0012", "11.일반종신", date(2023, 6, 1))]


def test_charset_needs_the_setting(spark, tmp_path):
    path = tmp_path / "contracts.csv"
    path.write_bytes(CONTRACTS.encode("euc-kr"))
    with pytest.raises(ValueError, match="javaCharsets"):
        files.read_contracts(spark, str(path))
    path.write_text(CONTRACTS, encoding="utf-8")
    assert files.read_contracts(spark, str(path), encoding="UTF-8").count() == 1


def test_customers_and_baseline(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text("계약자연령,ID,마감년월,계약자성별\n40,0012,202305,1\n,0013,202305,null\n", encoding="utf-8")
    found = files.read_customers(spark, str(path), ["계약자연령"], encoding="UTF-8").orderBy("customer_id").collect()
    assert [(r.customer_id, r.ref_month, r.계약자연령, r.계약자성별) for r in found] == [
        ("0012", "202305", 40.0, "1"), ("0013", "202305", None, None)]
    path.write_text("ID,OLD\n0012,38.건강\n", encoding="utf-8")
    assert [tuple(r) for r in files.read_baseline(spark, str(path), encoding="UTF-8").collect()] == [("0012", "38.건강")]
    with pytest.raises(ValueError, match="customer"):
        path.write_text("key\n1\n", encoding="utf-8")
        files.read_customers(spark, str(path), encoding="UTF-8")


def test_dataset_and_splits(spark, tmp_path):
    frame = spark.createDataFrame([(1, "199912", "train"), (2, "200012", "test")], "id int, ref_month string, split string")
    path = str(tmp_path / "dataset")
    files.write_dataset(frame.filter("id = 1"), path)
    files.write_dataset(frame.filter("id = 2"), path)
    assert files.read_dataset(spark, path, "199912").count() == 1
    assert files.read_dataset(spark, path, "200012").first().id == 2
    scan = files.read_dataset(spark, path, "200012")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ref_month" in scan
    files.write_splits(frame, str(tmp_path / "splits"))
    assert [r.id for r in files.read_split(spark, str(tmp_path / "splits"), "test").collect()] == [2]


def test_fitted_tables_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([("b", 1.5), (None, None), ("a", 3.0)], "kind string, n double")
    codes, ranges = encode.fit_category_codes(frame, ["kind"]), encode.fit_min_max(frame, ["n"])
    files.write_table(codes, str(tmp_path / "codes"))
    files.write_table(ranges, str(tmp_path / "ranges"))
    codes, ranges = files.read_table(spark, str(tmp_path / "codes")), files.read_table(spark, str(tmp_path / "ranges"))
    applied = encode.apply_min_max(encode.apply_category_codes(frame, codes, ["kind"]), ranges, ["n"])
    assert sorted((tuple(r) for r in applied.collect()), key=repr) == [(0, 1.0), (1, 0.0), (2, None)]


def test_profile_round_trip(spark, tmp_path):
    found = profile.column_profile(spark.createDataFrame([("가",), ("b",)], "name string"), ())
    files.write_profile(found, str(tmp_path / "profile"))
    again = files.read_profile(spark, str(tmp_path / "profile"), profile.PROFILE_SCHEMA)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect()))


def test_shuffled_export_keeps_rows(spark, tmp_path):
    frame = spark.range(100)
    files.export_shuffled(frame, str(tmp_path / "a"), 42, ["id"])
    files.export_shuffled(frame.repartition(3), str(tmp_path / "b"), 42, ["id"])
    first = [r.id for r in spark.read.parquet(str(tmp_path / "a")).collect()]
    assert sorted(first) == list(range(100)) and first != sorted(first)


def test_stage_uses_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    staged = stage.stage(spark.range(5), "numbers")
    assert root.split(":")[-1].rstrip("/") in staged.inputFiles()[0]
    assert stage.stage(spark.range(5).filter("id > 9"), "none").count() == 0


def test_keep_stages_larger_tables(spark, monkeypatch):
    kept = stage.keep(spark.range(10).withColumn("name", F.lit("x")), "small")
    assert kept.inputFiles() == [] and kept.count() == 10
    monkeypatch.setattr(stage, "LOCAL_ROWS", 3)
    staged = stage.keep(spark.range(10), "large")
    assert staged.inputFiles() and staged.count() == 10
