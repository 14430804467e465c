"""Database tables through a DB-API driver: pushed filters, columns, key ranges, against the database's own SQL."""

import sqlite3

import pytest
from pyspark.sql import functions as F
from pyspark.sql import datasource as ds

from nextpick.operators import extract
from nextpick.sources import remote

COLUMNS = "contract bigint, customer_id bigint, status string, price double, month bigint, note string"


@pytest.fixture(scope="module")
def database(tmp_path_factory):
    """Contracts and customer masters in a database file, which the tasks open themselves."""
    path = str(tmp_path_factory.mktemp("remote") / "source.db")
    with sqlite3.connect(path) as db:
        db.execute('CREATE TABLE contracts (contract INTEGER, customer_id INTEGER, status TEXT, price REAL, month INTEGER, note TEXT, wide TEXT)')
        db.executemany("INSERT INTO contracts VALUES (?, ?, ?, ?, ?, ?, ?)", [
            (None if i % 97 == 0 else i, i % 211, ["01", "02", None][i % 3], i / 7, 202300 + i % 12, "Ab" if i % 2 else "ab", "x" * 50)
            for i in range(5000)])
        db.execute("CREATE TABLE masters (customer_id INTEGER, grp TEXT)")
        db.executemany("INSERT INTO masters VALUES (?, ?)", [(i, "0101" if i % 4 else "0202") for i in range(211)])
    return path


def contracts(spark, database, schema=COLUMNS, slices=4):
    return remote.read_table(spark, "sqlite3", {"database": database}, "contracts", schema, "contract", 0, 4000, slices)


def handed_out(frame):
    """(rows of the result, rows that the reader handed to Spark)."""
    rows = frame.collect()
    leaf = frame._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return rows, leaf.metrics().apply("numOutputRows").value()


def own(database, sql):
    with sqlite3.connect(database) as db:
        return sorted(db.execute(sql).fetchall(), key=str)


@pytest.mark.parametrize("condition, sql, pushed", [
    ("month = 202305", "month = 202305", True),
    ("price >= 10.5 AND price < 20", "price >= 10.5 AND price < 20", True),
    ("month IN (202301, 202302) AND status IS NULL", "month IN (202301, 202302) AND status IS NULL", True),
    ("month != 202305", "month != 202305", True),
    ("status = '01'", "status = '01'", True),
    ("contract <= 100 OR month = 202305", "contract <= 100 OR month = 202305", False),
    ("note LIKE 'A%'", "note GLOB 'A*'", False),
    ("contract > 4900", "contract > 4900", True),
    ("contract IS NULL", "contract IS NULL", True),
])
def test_filters(spark, database, condition, sql, pushed):
    rows, out = handed_out(contracts(spark, database).filter(condition))
    expected = own(database, f"SELECT contract, customer_id, status, price, month, note FROM contracts WHERE {sql}")
    assert sorted(map(tuple, rows), key=str) == expected
    assert out == (len(expected) if pushed else 5000)


def test_every_row_once_whatever_the_slices(spark, database):
    expected = own(database, "SELECT contract, month FROM contracts")
    for slices in (1, 3, 16):
        frame = contracts(spark, database, "contract bigint, month bigint", slices)
        assert sorted(map(tuple, frame.collect()), key=str) == expected
        assert frame.rdd.getNumPartitions() == slices


def test_only_wanted_columns_are_asked_for(database):
    reader = remote.RemoteReader({"module": "sqlite3", "table": "contracts", "key": "contract", "lower": "0", "upper": "9", "slices": "2"},
                                 remote.StructType().add("price", "double"))
    left = list(reader.pushFilters([ds.GreaterThan(("month",), 202303), ds.EqualTo(("note",), "Ab"), ds.StringContains(("note",), "b"),
                                    ds.Not(ds.EqualTo(("note",), "x")), ds.Not(ds.In(("month",), (1, 2)))]))
    assert [type(f) for f in left] == [ds.EqualTo, ds.StringContains, ds.Not]
    first, last = map(reader.query, reader.partitions())
    assert first.text == ('SELECT "price" FROM "contracts" WHERE "month" > ? AND "note" = ? AND NOT ("month" IN (?, ?)) '
                          'AND ("contract" < ? OR "contract" IS NULL)')
    assert first.values == [202303, "Ab", 1, 2, 5] and last.text.endswith('"contract" >= ?')


def test_plan_shows_pushed_filters(spark, database):
    plan = contracts(spark, database).filter("month = 202305")._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan nextpick_remote" in plan and "202305" not in plan.split("BatchScan")[0]


def test_extraction_of_eligible_contracts(spark, database):
    """Contracts filtered at the source and joined to the members among the masters, as in the database."""
    masters = remote.read_table(spark, "sqlite3", {"database": database}, "masters", "customer_id bigint, grp string", "customer_id", 0, 210, 2)
    good = (F.col("month") == 202310) & (F.col("status") == "02")
    found = extract.eligible_contracts(contracts(spark, database), masters, good, F.col("grp") == "0101")
    expected = own(database, """SELECT c.contract, c.price FROM contracts c JOIN masters m USING (customer_id)
        WHERE c.month = 202310 AND c.status = '02' AND m.grp = '0101'""")
    assert expected and sorted(map(tuple, found.select("contract", "price").collect()), key=str) == expected


def test_needs_a_schema_and_plain_names(spark, database):
    with pytest.raises(ValueError, match="question mark"):
        contracts(spark, database, "`a?` string")
    remote.read_table(spark, "sqlite3", {"database": database}, "masters", "customer_id bigint", "customer_id", 0, 1, 1)
    with pytest.raises(Exception, match="schema"):
        spark.read.format(remote.FORMAT).option("module", "sqlite3").load()
