"""Many checks in one pass, counts of the common population, draws without a join, sample months."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from nextpick.operators import checks, profile, split


@pytest.fixture
def parts(spark):
    customers = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (None, "a")], "k long, month string")
    contracts = spark.createDataFrame([(1, 5), (1, 7), (3, None)], "k long, n int")
    return [(customers, [checks.rows_of("customers"), checks.Measure("months", "set", F.col("month"))]),
            (contracts, [checks.rows_of("contracts"), checks.Measure("low", "min", F.col("n")), checks.Measure("high", "max", F.col("n")),
                         checks.Measure("codes", "set", F.col("n"))])]


def test_ledger_has_a_row_per_key(parts):
    rows = {r.k: (r.customers, sorted(r.months or []), r.contracts, r.low, r.high, sorted(r.codes or [])) for r in checks.ledger("k", parts).collect()}
    assert rows == {1: (1, ["a"], 2, 5, 7, [5, 7]), 2: (2, ["a", "b"], 0, None, None, []), 3: (0, [], 1, None, None, []),
                    None: (1, ["a"], 0, None, None, [])}


def test_verdicts(parts):
    found = checks.verdicts(checks.ledger("k", parts), {
        "unique": F.count_if(F.col("customers") > 1), "months": F.abs(F.size(checks.values_of("months")) - 1), "rows": F.abs(F.sum("contracts") - 3),
        "codes": F.size(F.array_except(F.array(F.lit(5), F.lit(6)), checks.values_of("codes"))), "order": checks.unless(F.max("high") < F.min("low")),
        "nothing": F.sum(F.lit(None).cast("int"))})
    assert {r.check_name: r.violations for r in found.collect()} == {"unique": 1, "months": 1, "rows": 0, "codes": 1, "order": 1, "nothing": 0}
    with pytest.raises(ValueError, match="unique: 1; months: 1"):
        checks.raise_on_violation(found)


def test_each_table_is_scanned_once(spark, parts, tmp_path):
    for place, (frame, _) in enumerate(parts):
        frame.write.parquet(f"{tmp_path}/{place}")
    read = [(spark.read.parquet(f"{tmp_path}/{place}"), measures) for place, (_, measures) in enumerate(parts)]
    plan = checks.verdicts(checks.ledger("k", read), {str(i): F.sum("customers") + F.max("low") for i in range(9)})
    assert plan._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2


def test_empty_tables_count_as_nothing(parts):
    empty = [(frame.limit(0), measures) for frame, measures in parts]
    found = checks.verdicts(checks.ledger("k", empty), {"rows": F.sum("customers"), "order": checks.unless(F.max("high") < F.min("low"))})
    assert [tuple(r) for r in found.collect()] == [("rows", 0), ("order", 1)]


def test_population_audit(spark):
    customers = spark.createDataFrame([(1,), (2,), (4,)], "customer_id long")
    items = spark.createDataFrame([(1, date(2023, 5, 31), 1), (1, date(2023, 6, 1), 1), (1, date(2023, 6, 2), 0), (2, date(2023, 5, 1), 0),
                                   (2, date(2023, 12, 1), 1), (3, date(2023, 5, 1), 1), (3, date(2023, 7, 1), 2), (1, date(2022, 1, 1), 0)],
                                  "customer_id long, contract_date date, bought long").withColumn("category", F.lit("a"))
    found = {(r.split, r.step): r.row_count for r in split.population_audit(customers, items, "202305").collect()}
    assert found == {("customers", "population_before"): 3, ("customers", "population_after"): 1, ("history", "population_before"): 4,
                     ("history", "population_after"): 2, ("target", "population_before"): 2, ("target", "population_after"): 1}
    none = split.population_audit(customers.limit(0), items.limit(0), "202305").collect()
    assert len(none) == 6 and all(r.row_count == 0 for r in none)


@pytest.mark.parametrize("shares", [{"a": 1.0}, {"a": 0.5, "b": 0.25, "c": 0.25}, {f"v{i:04d}": 1 / 700 for i in range(700)},
                                    {"rare": 1e-9, "often": 1 - 1e-9}])
def test_guided_draws_equal_those_by_join(spark, monkeypatch, shares):
    frame = spark.createDataFrame([("c", "share", v, s, None, None) for v, s in shares.items()], profile.PROFILE_SCHEMA)
    draw = lambda: sorted(map(tuple, profile.synthesize(spark, frame, {"c": "string"}, 400).collect()))
    guided = draw()
    assert len(guided) == 400 and all(v in shares for *_, v in guided)
    plan = profile.synthesize(spark, frame, {"c": "string"}, 400)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    monkeypatch.setattr(profile, "GUIDED_VALUES", 0)
    assert draw() == guided


def test_sample_month(spark):
    number = lambda c, mean, std: (c, "normal", None, None, mean, std)
    share = lambda c, values: [(c, "share", v, s, None, None) for v, s in values.items()]
    rows = {"customers": [*share("ref_month", {"202305": 1.0}), *share("sex", {"1": 0.4, "2": 0.6}), number("age", 40.0, 10.0)],
            "history": [*share("category", {"a": 0.7, "b": 0.3}), number("contract_date", 1.68e9, 1e8)],
            "target": [*share("category", {"a": 0.5, "c": 0.5}), number("contract_date", 1.69e9, 5e6)]}
    profiles = {k: spark.createDataFrame(v, profile.PROFILE_SCHEMA) for k, v in rows.items()}
    dated = {"category": "string", "contract_date": "date"}
    sample = profile.sample_month(spark, profiles, {"customers": {"ref_month": "string", "sex": "string", "age": "double"},
                                                    "history": dated, "target": dated}, 200, "202305")
    ids = [{r.customer_id for r in frame.collect()} for frame in (sample.customers, sample.history, sample.target)]
    assert ids[0] == ids[1] == ids[2] == set(range(1, 201)) and sample.customers.count() == 200 and sample.history.count() == 2000
    assert sample.history.agg(F.max("contract_date")).first()[0] <= date(2023, 5, 1)
    first, last = sample.target.agg(F.min("contract_date"), F.max("contract_date")).first()
    assert date(2023, 5, 1) <= first
    assert sample.target.count() == sample.target.select("customer_id", "category").distinct().count()
    mean, std = sample.customers.agg(F.avg("age"), F.stddev("age")).first()
    assert abs(mean - 40) < 3 and abs(std - 10) < 2


def _profile_rows(frame):
    rounded = [F.round(c, 6).alias(c) for c in ("share", "mean", "std")]
    return sorted(map(tuple, frame.select("column_name", "kind", "value", *rounded).collect()), key=str)


def _months(spark):
    schema = "customer_id long, name string, few int, many double, grows int, day date"
    make = lambda low, high: [(i, None if i % 5 == 0 else f"n{i % 4}", None if i % 9 == 0 else i % 6, i * 1.5, i % 15 + low % 7,
                               date(2023, 1 + i % 12, 1 + i % 28)) for i in range(low, high)]
    return [spark.createDataFrame(make(low, high), schema) for low, high in ((0, 40), (40, 41), (41, 141), (141, 160))]


def test_merged_states_equal_the_profile_of_all_rows(spark):
    months = _months(spark)
    whole = months[0]
    for month in months[1:]:
        whole = whole.unionByName(month)
    states = [profile.profile_state(month) for month in months]
    merged = profile.merge_states(profile.merge_states(states[3], states[1]), profile.merge_states(states[0], states[2]))
    expected = _profile_rows(profile.column_profile(whole))
    assert _profile_rows(profile.profile_of_state(merged)) == expected
    assert {r[0] for r in expected if r[1] == "normal"} == {"many", "grows", "day"}  # `grows` is few in each month alone


def test_a_state_gives_the_profile_of_its_month(spark):
    for month in _months(spark)[::2]:
        assert _profile_rows(profile.profile_of_state(profile.merge_states(profile.profile_state(month)))) == _profile_rows(profile.column_profile(month))
    assert profile.profile_of_state(profile.merge_states(profile.profile_state(_months(spark)[0].limit(0)))).filter("share IS NOT NULL").count() == 0


def test_contract_months(spark, tmp_path):
    """Only the folders of the wanted months are read, by bounds or by a table of months; a month can be replaced."""
    from nextpick.sources import files
    days = [date(2023, m, d) for m in range(1, 13) for d in (1, 15, 28)]
    frame = spark.createDataFrame([(i, "p", "c", "a", day) for i, day in enumerate(days)],
                                  "customer_id long, product_code string, product_class string, category string, contract_date date")
    path = str(tmp_path / "store")
    files.write_contract_months(frame, path)

    def read(**bounds):
        found = files.read_contract_months(spark, path, **bounds)
        return sorted(r.contract_date for r in found.collect()), found

    dates, found = read(since="202306", until="202307")
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert dates == [d for d in days if d.month in (6, 7)] and scan.metrics().apply("numFiles").value() == 2 and "month" not in found.columns
    assert len(read()[0]) == 36
    months = spark.createDataFrame([("202302",), ("202302",), ("209901",)], "month string").filter("month > '2'")
    dates, found = read(months=months)
    assert dates == [d for d in days if d.month == 2] and "dynamicpruning" in found._jdf.queryExecution().optimizedPlan().toString()
    files.write_contract_months(frame.filter("customer_id = 0"), path)
    assert read(until="202302")[0] == [days[0], *[d for d in days if d.month == 2]]
