"""Nulls, ties, empty inputs and boundaries on hand-made frames."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from nextpick import defaults
from nextpick.functions import dates, values
from nextpick.operators import candidates as cand
from nextpick.operators import checks, encode, evaluate, extract, features, labels, profile, split, targets, trend
from nextpick.plans import dataset

CONTRACT = "customer_id string, product_code string, product_class string, category string, contract_date date"
ITEMS = "customer_id string, category string, category_code int, contract_date date"


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def contracts(spark, *data):
    return spark.createDataFrame([(i, p, cl, c, date.fromisoformat(d) if d else None) for i, p, cl, c, d in data],
                                 CONTRACT)


def test_month_arithmetic():
    assert dates.month_start("202305", 7) == date(2023, 12, 1)
    assert dates.month_start("202312", 1) == date(2024, 1, 1)
    assert dates.month_start("202301", -1) == date(2022, 12, 1)
    assert dates.month_list("202211", 3) == ["202211", "202212", "202301"]


def test_elapsed_months(spark):
    cases = [("2023-05-01 00:00", 0), ("2023-05-31 00:00", 0), ("2023-04-30 00:00", 0), ("2023-04-01 00:00", 1),
             ("2023-04-01 05:00", 0), ("2022-05-02 00:00", 11), ("2022-05-01 00:00", 12), ("2023-06-15 00:00", -1)]
    frame = spark.createDataFrame([(datetime.fromisoformat(day), months) for day, months in cases], "day timestamp, n int")
    shown = [(row.m, row.n) for row in frame.select("n", dates.elapsed_months(F.col("day"), "202305").alias("m")).collect()]
    assert all(m == n for m, n in shown), shown


def test_split_boundaries(spark):
    frame = contracts(spark, ("a", "p", "k", "x", "2023-05-31"), ("a", "p", "k", "x", "2023-06-01"),
                      ("a", "p", "k", "x", "2023-11-30"), ("a", "p", "k", "x", "2023-12-01"))
    until = split.contracts_until(frame, "202305")
    history, target = split.temporal_split(until, "202305")
    assert (history.count(), target.count()) == (1, 2)
    assert split.contracts_after(frame, "202305").count() == 2


def test_exclusions_keep_missing_values(spark):
    frame = contracts(spark, ("a", "p", "34.실손", "x", "2023-06-01"), ("a", "p", None, "기타", "2023-06-01"),
                      ("a", "p", None, None, "2023-06-01"), ("a", "p", "k", "20.CI", "2023-06-01"))
    kept = split.exclude(frame, defaults.EXCLUDED_CLASSES, defaults.EXCLUDED_CATEGORIES)
    assert {row.category for row in kept.collect()} == {None, "20.CI"}
    assert defaults.variant_categories("x_del_variable_1") == ["42.변액연금", "12.변액종신", "52.변액저축"]
    assert len(defaults.variant_categories("small_category del_variable")) == 6
    assert defaults.variant_categories("base") == []


def test_audit_of_empty_target(spark):
    frame = contracts(spark, ("a", "p", "k", "x", "2023-05-01"), ("a", "p", "k", "x", "2023-05-01"))
    audit = {(row.split, row.step): row for row in split.split_audit(frame, "202305", [], [], []).collect()}
    assert audit["history", "loaded"].row_count == 2
    assert audit["history", "projected_distinct"].row_count == 1
    assert audit["target", "rows_distinct"].row_count == 0
    assert audit["target", "loaded"].first_date is None


def test_codes_by_frequency_then_name(spark):
    history = contracts(spark, ("a", "p", "k", "old", "2023-01-01"), ("a", "p", "k", "old", "2023-01-01"),
                        ("a", "p", "k", "older", "2023-01-01"), ("a", "p", "k", "b", "2023-01-01"))
    target = contracts(spark, ("a", "p", "k", "b", "2023-06-01"), ("a", "p", "k", "b", "2023-06-01"),
                       ("a", "p", "k", "a", "2023-06-01"), ("b", "q", "k", "c", "2023-06-01"),
                       ("c", "q", "k", "c", "2023-06-01"))
    table = labels.assign_codes(history, target)
    # The copy of b counts once, so a and b tie and go by name; history counts copies.
    assert rows(table) == [("a", 2, True), ("b", 3, True), ("c", 1, True), ("old", 4, False), ("older", 5, False)]
    assert labels.code_list(table) == [1, 2, 3, 4, 5]
    assert labels.code_list(table, target_only=True) == [1, 2, 3]
    again = labels.decode_category(labels.encode_category(target, table), table, "category_code", "name")
    assert again.filter("name IS DISTINCT FROM category").count() == 0


def test_unseen_category_is_reported(spark):
    table = spark.createDataFrame([("x", 1, True)], "category string, code int, in_target boolean")
    later = contracts(spark, ("a", "p", "k", "x", "2023-06-01"), ("a", "p", "k", "new", "2023-06-01"))
    assert labels.encode_category(later, table).filter("category_code IS NULL").count() == 1
    assert rows(dataset.unseen_categories(later, table)) == [("new", 1)]


def test_too_many_codes_fail(spark, monkeypatch):
    monkeypatch.setattr(labels, "MAX_CODES", 1)
    table = spark.createDataFrame([("x", 1, True), ("y", 2, True)], "category string, code int, in_target boolean")
    with pytest.raises(ValueError):
        labels.code_list(table)


def history_frame(spark):
    day = date.fromisoformat
    return spark.createDataFrame([("a", "x", 3, day("2023-05-10")), ("a", "y", 1, day("2023-05-10")),
                                  ("a", "x", 3, day("2022-05-01")), ("b", "y", 1, day("2021-04-30"))], ITEMS)


def test_newest_products(spark):
    assert rows(features.last_n_products(history_frame(spark), 3)) == [("a", 1, 3, 3), ("b", 1, 0, 0)]


def test_history_features(spark):
    assert rows(features.history_summary(history_frame(spark), "202305")) == [("a", 3, 0, 12), ("b", 1, 24, 24)]
    assert rows(features.held_flags(history_frame(spark), [1, 2, 3])) == [("a", 1, 0, 1), ("b", 1, 0, 0)]
    since = features.months_since_by_category(history_frame(spark), [1, 2, 3], "202305")
    assert since.columns == ["customer_id", "pre_m_1", "pre_m_2", "pre_m_3"]
    assert rows(since) == [("a", 0, -1, 0), ("b", 24, -1, -1)]


def test_customer_without_history_has_no_products(spark):
    customers = spark.createDataFrame([("a",), ("c",)], "customer_id string")
    wide = features.attach_features(customers, features.last_n_products(history_frame(spark), 2),
                                    features.history_summary(history_frame(spark), "202305"))
    assert rows(wide) == [("a", 1, 3, 3, 0, 12), ("c", 0, 0, None, None, None)]


def test_encoders(spark):
    schema = "customer_id int, kind string, constant double, empty double, n int"
    frame = spark.createDataFrame([(1, "z", 5.0, None, 10), (2, None, 5.0, None, 20), (3, "v", 5.0, None, None)], schema)
    codes = encode.fit_category_codes(frame, ["kind"])
    assert rows(codes) == [("kind", "unknown", 0), ("kind", "v", 1), ("kind", "z", 2)]
    later = spark.createDataFrame([(1, "new", 7.0, 1.0, 40), (2, None, 5.0, None, 5), (3, "z", None, None, 10)], schema)
    assert [row[1] for row in rows(encode.apply_category_codes(later, codes, ["kind"]))] == [0, 0, 2]
    ranges = encode.fit_min_max(frame, ["constant", "empty", "n"])
    assert rows(encode.apply_min_max(later, ranges, ["constant", "empty", "n"]).drop("kind")) == [
        (1, 2.0, None, 3.0), (2, 0.0, None, -0.5), (3, None, None, 0.0)]
    assert rows(encode.null_columns(frame)) == [("constant", 0), ("customer_id", 0), ("empty", 3), ("kind", 1), ("n", 1)]


def test_model_inputs(spark):
    frame = spark.createDataFrame([(1, 2, 3, 1)], "customer_id int, a int, b int, target int")
    assert encode.select_inputs(frame, ["a", "b"], ["b"]).columns == ["customer_id", "a", "target"]
    assert encode.select_inputs(frame.drop("target"), ["a", "b"]).columns == ["customer_id", "a", "b"]


def test_negatives(spark):
    # Code 1 is held by all, code 2 by most (the cap holds), code 3 by one.
    pairs = [(i, 1) for i in range(10)] + [(i, 2) for i in range(6)] + [(9, 3)]
    positives = spark.createDataFrame(pairs, "customer_id int, category_code int")
    negatives = targets.sample_negatives(positives, [1, 2, 3, 4])
    found = {row.category_code: row["count"] for row in negatives.groupBy("category_code").count().collect()}
    assert found == {2: 4, 3: 2}
    assert negatives.join(positives, ["customer_id", "category_code"]).count() == 0
    pairs = targets.target_pairs(positives, negatives)
    summary = targets.target_summary(spark.range(20).withColumnRenamed("id", "customer_id"), pairs).first()
    assert (summary.num_of_rows, summary.num_of_target, summary.num_of_target_ids) == (23, 17, 10)
    assert summary.percent_of_target_ids == 50.0
    assert summary.target_mix[0] == (1, 10, 58.82)
    assert targets.target_pairs(positives).filter("target = 0").count() == 0


def test_group_split_is_disjoint_and_complete(spark):
    ids = spark.range(0, 101).withColumnRenamed("id", "customer_id")
    sides = split.group_split(ids)
    assert sides.filter("split = 'test'").count() == 21
    assert sides.count() == sides.select("customer_id").distinct().count() == 101


def test_equal_scores_go_to_the_lower_code(spark):
    scored = spark.createDataFrame([(1, 2, 0.5), (1, 1, 0.5), (1, 3, 0.1), (2, 3, 0.2)],
                                   "customer_id int, target_category int, score double")
    assert rows(cand.best_candidate(scored)) == [(1, 1, 0.5), (2, 3, 0.2)]
    ranked = cand.rank_candidates(cand.one_customer(scored, 1)).orderBy("result_rank").collect()
    assert [(r.target_category, r.result_rank) for r in ranked] == [(1, 1), (2, 2), (3, 3)]
    assert cand.one_customer(scored).select("customer_id").distinct().count() == 1


def test_entity_rows(spark):
    table = spark.createDataFrame([(1, 0.5, 1, 1), (1, 0.5, 2, 0), (2, 0.1, 1, 1)],
                                  "customer_id int, balance double, target_category int, target int")
    assert rows(cand.entity_rows(table)) == [(1, 0.5), (2, 0.1)]
    assert cand.positives(table).count() == 2


def test_customer_without_history_gets_shares(spark):
    customers = spark.createDataFrame([(1, {2: 3}, 3), (2, None, None)], "customer_id int, held map<int,bigint>, held_total bigint")
    shares = spark.createDataFrame([(1, 0.75), (2, 0.25)], "target_category int, share double")
    scored = cand.affinity_score(cand.has_item(cand.candidates(customers, [1, 2, 3])), shares)
    assert rows(scored.select("customer_id", "target_category", "has_item", "score")) == [
        (1, 1, 0, 0.1875), (1, 2, 1, 0.8125), (1, 3, 0, 0.0), (2, 1, 0, 0.75), (2, 2, 0, 0.25), (2, 3, 0, 0.0)]


def evaluated_frame(spark):
    return spark.createDataFrame([(1, "a", ["a", "b"], 1), (2, "a", ["b"], 0), (3, "c", ["b"], 0), (4, "d", ["d"], 1)],
                                 "customer_id int, pred_item string, true_item array<string>, hit int")


def test_report_without_predictions_and_without_truth(spark):
    report = {row.category: row for row in evaluate.accuracy_by_category(evaluated_frame(spark)).collect()}
    assert set(report) == {"a", "b", "d"}  # c was picked but never bought
    assert report["b"].accuracy_pred is None and report["b"].accuracy_true == 0.0
    assert report["a"].pred_pct == 50.0 and report["a"].accuracy_pred == 50.0


def test_hybrid_picks(spark):
    second = spark.createDataFrame([(2, "b"), (1, "x")], "customer_id int, second_item string")
    picks = evaluate.hybrid_recommend(evaluated_frame(spark), second, ["d"])
    assert rows(picks.select("customer_id", "pred_item", "source", "hit")) == [
        (1, "x", "second", 0), (2, "b", "second", 1), (3, "z", "second", 0), (4, "d", "first", 1)]
    # The missing pick counts in the accuracy and has no row in the report.
    assert evaluate.accuracy(picks).first().accuracy == 50.0
    assert {row.category for row in evaluate.accuracy_by_category(picks).collect()} == {"a", "b", "d"}


def test_baseline_without_a_pick_is_a_miss(spark):
    truth = spark.createDataFrame([(1, ["a"]), (2, ["b"])], "customer_id int, true_item array<string>")
    picks = spark.createDataFrame([(1, "a")], "customer_id int, old_item string")
    assert rows(evaluate.evaluate_baseline(truth, picks).select("customer_id", "hit")) == [(1, 1), (2, 0)]


def test_empty_evaluation(spark):
    empty = evaluated_frame(spark).filter("false")
    assert tuple(evaluate.accuracy(empty).first()) == (0, 0, None)
    assert evaluate.accuracy_by_category(empty).count() == 0


def test_label_reports(spark):
    matrix = spark.createDataFrame([(1, 1, 0, 1), (2, 1, 1, 1), (3, 0, 1, 1)],
                                   "customer_id int, label_1 int, label_2 int, pred_code int")
    assert rows(evaluate.multi_label_report(matrix, [1, 2])) == [(1, 2, 3, 2, 66.7, 100.0), (2, 2, 0, 0, None, 0.0)]
    assert evaluate.exact_match_accuracy(matrix, [1, 2]).first().exact == 1
    scores = spark.createDataFrame([(1, 0.2, 0.2), (2, 0.1, 0.3)], "customer_id int, prob_4 double, prob_6 double")
    assert rows(evaluate.highest_label(scores, [4, 6]).select("customer_id", "pred_code")) == [(1, 4), (2, 6)]
    classes = spark.createDataFrame([(0, 0), (0, 1), (2, 1)], "true_class int, pred_class int")
    assert rows(evaluate.multi_class_report(classes, 4)) == [(4, 2, 1, 1, 100.0, 50.0), (6, 1, 0, 0, None, 0.0)]


def test_auc_and_loss(spark):
    scored = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "target int, score double")
    assert evaluate.auc(scored).first().auc == 0.625
    assert evaluate.auc(scored.filter("target = 1")).first().auc is None
    certain = spark.createDataFrame([(1, 1.0), (0, 0.0)], "target int, score double")
    assert evaluate.log_loss(certain).first().log_loss == 0.0


def test_trend(spark):
    purchases = spark.createDataFrame(
        [("202301", "1", "k", "x"), ("202301", "2", "k", "x"), ("202301", "2", "m", "x"), ("202301", "3", "k", "y"),
         ("202302", "1", "k", "y"), ("202302", "1", "80.미니보험", "z")],
        "month string, customer_id string, product_class string, category string")
    report = trend.monthly_trend(purchases, ["202301", "202302"], "202301", defaults.TREND_EXCLUDED_CLASSES)
    assert [tuple(row) for row in report.collect()] == [("x", 66.6, None), ("y", 33.4, 100.0)]
    cohort = spark.createDataFrame([("3",), ("3",)], "customer_id string")
    report = trend.monthly_trend(purchases, ["202301", "202302"], "202301", [], cohort)
    assert [tuple(row) for row in report.collect()] == [("y", 100.0, None)]


def test_rules(spark):
    frame = spark.createDataFrame([("A", "AD", "P1"), ("A", "AE", "P2"), ("A", "AE", "P9"), ("B", None, None)],
                                  "large string, middle string, sales string")
    rules = [labels.Rule("child", {"large": ["A"], "middle": ["AD"]}),
             labels.Rule("health", {"large": ["A"], "middle": ["AE", "AF"]}, {"sales": ["P9"]})]
    found = labels.classify_products(frame, rules, "group", "other").select("group")
    assert [row.group for row in found.collect()] == ["child", "health", "other", "other"]


def test_extracts(spark):
    pairs = spark.createDataFrame([("a", "b"), ("a", "b"), ("", "b"), ("a", None)], "product string, coverage string")
    assert rows(extract.distinct_pairs(pairs, "product", "coverage")) == [("a", "b")]
    customers = spark.createDataFrame([("0012", "x", 1), ("0003", "y", 2), ("0003", "other", 3)],
                                      "customer_id string, identity_code string, age int")
    bought = contracts(spark, ("0003", "p", "k", "c", "2023-06-01"), ("0012", "p", "k", "c", "2023-12-01"))
    bought = bought.withColumn("identity_code", F.when(F.col("customer_id") == "0003", "y").otherwise("x"))
    population = extract.base_population(customers, bought, "202305")
    assert rows(extract.identity_map(population)) == [(1, "0003", "y")]
    assert extract.customer_table(population).columns == ["age", "id"]
    served = extract.serving_input(customers, bought, "202305", ["product_code", "contract_date"])
    assert rows(served.select("id", "order_column")) == [(2, 1)]


def test_profile(spark):
    frame = spark.createDataFrame(
        [(i, "a" if i % 4 else None, i % 19, float(i), date(1970, 1, 1 + i % 28)) for i in range(100)],
        "customer_id int, text string, few int, many double, day date")
    found = profile.column_profile(frame)
    kinds = {(row.column_name, row.kind) for row in found.collect()}
    assert kinds == {("text", "share"), ("few", "share"), ("many", "normal"), ("day", "normal")}
    assert found.filter("column_name = 'text'").first().share == 1.0
    assert found.filter("column_name = 'many'").first().mean == 49.5
    nulls = frame.withColumn("few", F.when(F.col("few") < 19, F.col("few")))
    assert profile.column_profile(nulls.unionByName(nulls.withColumn("few", F.lit(None).cast("int")))).filter(
        "column_name = 'few' AND kind = 'normal'").count() == 1  # 19 values and null make 20


def test_synthetic_rows(spark):
    source = spark.createDataFrame([("a",)] * 60 + [("b",)] * 30 + [("c",)] * 10, "category string")
    source = source.withColumn("contract_date", F.date_add(F.lit(date(2023, 6, 1)), (F.rand(1) * 100).cast("int")))
    drawn = profile.synthesize(spark, profile.column_profile(source, ()), {"category": "string", "contract_date": "date"},
                               4000, 2)
    assert drawn.count() == 8000
    shares = {row.category: row["count"] / 8000 for row in drawn.groupBy("category").count().collect()}
    assert abs(shares["a"] - 0.6) < 0.03 and abs(shares["c"] - 0.1) < 0.02
    assert rows(drawn.repartition(3)) == rows(drawn)
    target = profile.clamp_dates(drawn, "202306", history=False)
    assert target.filter("contract_date < '2023-06-01'").count() == 0
    history = profile.clamp_dates(drawn, "202306", history=True)
    assert history.filter("contract_date > '2023-06-01'").count() == 0
    unique = profile.one_row_per_pair(target)
    assert unique.count() == unique.select("customer_id", "category").distinct().count()


def test_checks(spark):
    frame = spark.createDataFrame([(1, 0), (1, 0), (2, 2)], "customer_id int, label int")
    found = checks.combine([
        checks.expect_unique(frame, ["customer_id"], "unique"), checks.expect_no_duplicates(frame, "copies"),
        checks.expect_single_value(frame, "label", "single"), checks.expect_contiguous(frame, "label", "contiguous"),
        checks.expect_row_count(frame, checks.row_count(frame.distinct()), "rows"),
        checks.expect_disjoint(frame, frame.filter("label = 2"), "customer_id", "disjoint"),
        checks.expect_same_ids(frame, frame.filter("label = 2"), "customer_id", "same"),
        checks.expect_no_match(frame, F.col("label").isNull(), "nulls")])
    assert {row.check_name: row.violations for row in found.collect()} == {
        "unique": 1, "copies": 1, "single": 1, "contiguous": 1, "rows": 1, "disjoint": 1, "same": 1, "nulls": 0}
    with pytest.raises(ValueError, match="copies: 1"):
        checks.raise_on_violation(found)
    with pytest.raises(ValueError, match="missing"):
        checks.require_columns(frame, ["missing"], "customer")


def test_dates_round_trip(spark):
    frame = spark.createDataFrame([(date(1999, 12, 31),)], "day date")
    seconds = frame.select(dates.epoch_seconds(F.col("day")).alias("s")).first().s
    assert seconds == 946598400
    back = frame.select(dates.from_epoch_seconds(dates.epoch_seconds(F.col("day"))).alias("d")).first().d
    assert back == date(1999, 12, 31)
    periods = frame.select(dates.whole_periods(F.lit(date(1999, 7, 1)), F.col("day")).alias("p")).first().p
    assert periods == 6


def test_uniform_numbers(spark):
    numbers = spark.range(5000).select(values.uniform(1, "a", "id").alias("u"), values.normal(1, "a", "id").alias("n"))
    row = numbers.agg(F.min("u"), F.max("u"), F.avg("u"), F.avg("n"), F.stddev("n")).first()
    assert 0 < row[0] < row[1] < 1 and abs(row[2] - 0.5) < 0.02 and abs(row[3]) < 0.05 and abs(row[4] - 1) < 0.05
