"""Tables of a database, read by Spark through any Python DB-API driver.

For databases with a JDBC driver on the cluster there is `files.read_remote`. This source needs a
Python driver on the nodes only. A read is cut into ranges of a numeric key, one query each; the column
list is that of the schema, and filters that Spark hands over become part of every query's condition, so
rows and columns that are not wanted never leave the database.

Conditions on numbers are left to the database alone. Conditions on text, whose collation is the
database's own, only narrow what it sends, and Spark tests them again. Others stay with Spark.
"""

from __future__ import annotations

import importlib
import json
import sys
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # nodes need the driver, not this repository

FORMAT = "nextpick_remote"
FETCH_ROWS = 10_000
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
_COMPARISONS = {ds.EqualTo: "=", ds.GreaterThan: ">", ds.GreaterThanOrEqual: ">=", ds.LessThan: "<", ds.LessThanOrEqual: "<="}
#: How drivers spell the n-th parameter of a query.
_MARKS = {"qmark": "?", "format": "%s", "pyformat": "%s", "numeric": ":{}"}


@dataclass
class KeyRange(ds.InputPartition):
    """Keys from `low` on, below `high`; an end that is None is open, and the first range has the null keys."""

    low: int | None
    high: int | None

    def __repr__(self) -> str:
        return f"KeyRange({self.low}, {self.high})"


def key_ranges(lower: int, upper: int, slices: int) -> list[KeyRange]:
    """At most `slices` ranges of about equal width over lower..upper, open at both ends."""
    slices = max(1, min(slices, upper - lower + 1))
    cuts = [lower + (upper - lower + 1) * i // slices for i in range(1, slices)]
    return [KeyRange(low, high) for low, high in zip([None, *cuts], [*cuts, None], strict=True)]


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class Condition:
    """Part of a query's condition: text with ``?`` for its values."""

    def __init__(self, text: str, values: Sequence = (), exact: bool = True):
        self.text, self.values, self.exact = text, list(values), exact

    @classmethod
    def of(cls, found: ds.Filter) -> Condition | None:
        """Condition that no row that satisfies the filter fails; None if there is none."""
        if isinstance(found, ds.Not):
            inner = cls.of(found.child)
            return cls(f"NOT ({inner.text})", inner.values) if inner is not None and inner.exact else None
        if len(found.attribute) != 1:
            return None
        column = quoted(found.attribute[0])
        if isinstance(found, ds.IsNull):
            return cls(f"{column} IS NULL")
        if isinstance(found, ds.IsNotNull):
            return cls(f"{column} IS NOT NULL")
        if isinstance(found, ds.In):
            kinds = {type(v) for v in found.value}
            if kinds and (kinds <= {int, float} or kinds == {str}):
                marks = ", ".join("?" * len(found.value))
                return cls(f"{column} IN ({marks})", found.value, kinds != {str})
            return None
        sign = _COMPARISONS.get(type(found))
        if sign is None or type(found.value) not in (int, float, str) or (isinstance(found.value, str) and sign != "="):
            return None
        return cls(f"{column} {sign} ?", [found.value], not isinstance(found.value, str))


class RemoteReader(ds.DataSourceReader):
    def __init__(self, options: Mapping[str, str], schema: StructType):
        self.schema = schema
        self.module, self.table, self.key = options["module"], options["table"], options["key"]
        self.connection = json.loads(options.get("connection", "{}"))
        self.ranges = key_ranges(int(options["lower"]), int(options["upper"]), int(options.get("slices", "1")))
        self.conditions: list[Condition] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for one in filters:
            condition = Condition.of(one)
            if condition is not None:
                self.conditions.append(condition)
            if condition is None or not condition.exact:
                yield one

    def partitions(self) -> Sequence[KeyRange]:
        return self.ranges

    def query(self, part: KeyRange) -> Condition:
        """The query of one range."""
        key, where = quoted(self.key), list(self.conditions)
        if part.low is not None:
            where.append(Condition(f"{key} >= ?", [part.low]))
        if part.high is not None:
            below = f"{key} < ?" if part.low is not None else f"({key} < ? OR {key} IS NULL)"
            where.append(Condition(below, [part.high]))
        columns = ", ".join(map(quoted, self.schema.names)) or "1"
        text = f"SELECT {columns} FROM {'.'.join(map(quoted, self.table.split('.')))}"
        if where:
            text += " WHERE " + " AND ".join(c.text for c in where)
        return Condition(text, [v for c in where for v in c.values])

    def read(self, part: KeyRange) -> Iterator[pa.RecordBatch]:
        driver = importlib.import_module(self.module)
        query, mark = self.query(part), _MARKS[driver.paramstyle]
        pieces = query.text.split("?")
        text = pieces[0] + "".join(mark.format(i) + piece for i, piece in enumerate(pieces[1:], 1))
        arrow = to_arrow_schema(self.schema)
        connection = driver.connect(**self.connection)
        try:
            cursor = connection.cursor()
            cursor.execute(text, query.values)
            while rows := cursor.fetchmany(FETCH_ROWS):
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
        finally:
            connection.close()


class RemoteTable(ds.DataSource):
    """Options: `module`, the driver; `connection`, its arguments as JSON; `table`; `key`, `lower`, `upper`, `slices`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("pass the columns to read and their types as a schema")

    def reader(self, schema: StructType) -> RemoteReader:
        return RemoteReader(self.options, schema)


def read_table(spark: SparkSession, module: str, connection: Mapping, table: str, schema: str, key: str, lower: int,
               upper: int, slices: int) -> DataFrame:
    """Columns of a database's table, in `slices` ranges of the numeric column `key`.

    Rows beyond `lower` and `upper`, and null keys, are in the first and last range: the bounds only
    shape the slices. Column names with a question mark are not possible. Filters on the result go to the database.
    """
    if "?" in table + key + schema:
        raise ValueError("a question mark in a name")
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(RemoteTable)
    return (spark.read.format(FORMAT).schema(schema).option("module", module).option("connection", json.dumps(dict(connection)))
            .option("table", table).option("key", key).option("lower", str(lower)).option("upper", str(upper))
            .option("slices", str(slices)).load())
