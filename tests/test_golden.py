"""Report arithmetic against published counts."""

import pytest
from pyspark.sql import functions as F

from nextpick.functions.values import percent, round_to_fifth
from nextpick.operators import evaluate

# Category, true, predicted, hits of a published report.
FIRST_STAGE = [("38", 5119, 5771, 4020), ("11", 2384, 188, 95), ("31", 668, 891, 237), ("37", 437, 139, 27),
               ("41", 269, 233, 21), ("32", 203, 21, 2), ("43", 164, 438, 64), ("51", 107, 190, 10),
               ("39", 61, 24, 0), ("35", 52, 43, 0), ("20", 48, 3, 0), ("33", 15, 45, 0)]
SECOND_STAGE = [("38", 5119, 5771, 4020), ("11", 2384, 188, 95), ("31", 668, 694, 254), ("37", 437, 135, 42),
                ("41", 269, 151, 20), ("32", 203, 12, 4), ("43", 164, 258, 59), ("51", 107, 61, 13),
                ("39", 61, 1, 0), ("35", 52, 18, 8), ("20", 48, 2, 0), ("33", 15, 0, 0)]
# True %, predicted %, precision, recall printed for the same rows.
FIRST_SHOWN = {"38": (53.7, 72.3, 69.7, 78.5), "11": (25.0, 2.4, 50.5, 4.0), "31": (7.0, 11.2, 26.6, 35.5),
               "43": (1.7, 5.5, 14.6, 39.0), "33": (0.2, 0.6, 0.0, 0.0)}
SECOND_SHOWN = {"38": (53.7, 72.3, 69.7, 78.5), "31": (7.0, 8.7, 36.6, 38.0), "43": (1.7, 3.2, 22.9, 36.0),
                "33": (0.2, 0.0, None, 0.0)}
CUSTOMERS = 7986


def expand(spark, report):
    """An evaluated table with the counts of a report.

    Hits and misses are spread over customers; what a customer bought besides does not matter for the
    report, so each true item goes to some customer that did not pick it, or that did if it is a hit.
    """
    picks, spare = [], []
    for category, true, predicted, hits in report:
        picks += [(category, 1)] * hits + [(category, 0)] * (predicted - hits)
        spare += [category] * (true - hits)
    picks += [("z", 0)] * (CUSTOMERS - len(picks))
    items = [[category] if hit else [] for category, hit in picks]
    place = 0
    for category in sorted(spare):
        while picks[place % CUSTOMERS][0] == category or category in items[place % CUSTOMERS]:
            place += 1
        items[place % CUSTOMERS].append(category)
        place += 1
    data = [(i, picks[i][0], items[i]) for i in range(CUSTOMERS)]
    frame = spark.createDataFrame(data, "customer_id int, pred_item string, true_item array<string>")
    return frame.withColumn("hit", F.array_contains("true_item", F.col("pred_item")).cast("int"))


@pytest.mark.parametrize("report, shown, accuracy", [(FIRST_STAGE, FIRST_SHOWN, 56.0), (SECOND_STAGE, SECOND_SHOWN, 56.5)])
def test_report(spark, report, shown, accuracy):
    evaluated = expand(spark, report)
    assert evaluate.accuracy(evaluated).first().accuracy == accuracy
    found = {row.category: row for row in evaluate.accuracy_by_category(evaluated).collect()}
    assert {(c, found[c].true_cnt, found[c].pred_cnt, found[c].pred_true) for c in found} == set(report)
    for category, values in shown.items():
        row = found[category]
        assert (row.true_pct, row.pred_pct, row.accuracy_pred, row.accuracy_true) == values


def test_headline_percentages(spark):
    published = [(4476, 7986, 56.0), (4515, 7986, 56.5), (7236, 11725, 61.7), (7236, 9940, 72.8), (95, 2384, 4.0)]
    frame = spark.createDataFrame(published, "part int, whole int, shown double")
    wrong = frame.filter(percent(F.col("part"), F.col("whole")) != F.col("shown"))
    assert wrong.count() == 0


def test_rounding_to_a_unit(spark):
    frame = spark.createDataFrame([(13.29, 13.2), (25.31, 25.4), (0.09, 0.0), (0.11, 0.2)], "x double, shown double")
    assert frame.filter(F.abs(round_to_fifth(F.col("x")) - F.col("shown")) > 1e-9).count() == 0
