"""Column profiles and synthetic rows drawn from them."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nextpick.defaults import SEED
from nextpick.functions.dates import epoch_seconds, from_epoch_seconds, month_start
from nextpick.functions.values import normal, uniform
from nextpick.operators.numbering import running_total

MAX_DISTINCT = 20
PROFILE_SCHEMA = "column_name string, kind string, value string, share double, mean double, std double"
GUIDED_VALUES = 1_000
NULL_VALUE = "\0"  # stands for a null among the counted values of a numeric column
_BUCKETS = 1024
_UNITS = 10 ** 15


def _as_numbers(frame: DataFrame) -> DataFrame:
    """Dates as epoch seconds."""
    for f in frame.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            frame = frame.withColumn(f.name, epoch_seconds(F.col(f.name).cast("date")))
    return frame


def _few_valued(frame: DataFrame, numeric: Sequence[str]) -> list[str]:
    """Numeric columns with fewer than MAX_DISTINCT distinct values; a null counts as one more."""
    if not numeric:
        return []
    sizes = frame.agg(*[F.approx_count_distinct(c).alias(c) for c in numeric]).first()
    near = [c for c in numeric if sizes[c] <= 5 * MAX_DISTINCT]
    if not near:
        return []
    exact = frame.agg(*[(F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in near]).first()
    return [c for c in near if (exact[c] or 0) < MAX_DISTINCT]


def column_profile(frame: DataFrame, drop: Sequence[str] = ("customer_id",)) -> DataFrame:
    """Share per value for text and for columns with few distinct values, else mean and std.

    Dates are profiled as epoch seconds (times of day do not count). One pass finds which numeric columns can have fewer
    than 20 distinct values (a sketch rules out the others), one counts values, one averages.
    """
    frame = _as_numbers(frame.drop(*drop))
    text = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
    numeric = [c for c in frame.columns if c not in text]
    few = _few_valued(frame, numeric)
    listed = [c for c in frame.columns if c in text or c in few]
    averaged = [c for c in numeric if c not in few]

    none = F.lit(None)
    parts = []
    if listed:
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                          for c in listed])
        counts = (frame.select(F.inline(cells)).filter("value IS NOT NULL")
                  .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_n")))
        totals = frame.agg(*[F.count(c).alias(c) for c in listed])
        rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("_total")) for c in listed]
        totals = totals.select(F.inline(F.array(*rows)))
        parts.append(counts.join(F.broadcast(totals), "column_name").select(
            "column_name", F.lit("share").alias("kind"), "value", (F.col("_n") / F.col("_total")).alias("share"),
            none.cast("double").alias("mean"), none.cast("double").alias("std")))
    if averaged:
        moments = frame.agg(*[f(c).alias(f"{n}_{c}") for c in averaged
                              for n, f in (("m", F.avg), ("s", F.stddev_samp))])
        rows = [F.struct(F.lit(c).alias("column_name"), F.lit("normal").alias("kind"),
                         none.cast("string").alias("value"), none.cast("double").alias("share"),
                         F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std")) for c in averaged]
        parts.append(moments.select(F.inline(F.array(*rows))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# A profile that grows month by month: states are small tables that are merged without the months' rows.

STATE_SCHEMA = "column_name string, value string, rows bigint, mean double, m2 double, many boolean"


def profile_state(frame: DataFrame, drop: Sequence[str] = ("customer_id",)) -> DataFrame:
    """State of a month: rows per value, and number, mean and squared deviations of each numeric column.

    Values of a numeric column are listed while there are fewer than MAX_DISTINCT (a null is one more); with ``many`` set
    they are not. ``value`` is null in the row of the column itself, which counts its non-null values.
    """
    frame = _as_numbers(frame.drop(*drop))
    text = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
    numeric = [c for c in frame.columns if c not in text]
    few = _few_valued(frame, numeric)
    listed = [c for c in frame.columns if c in text or c in few]
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in listed]) if listed else None
    whole = [F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("string").alias("value"), F.count(c).alias("rows"),
                      *[(F.lit(None) if c in text else found).cast("double").alias(name) for name, found in
                        (("mean", F.avg(c)), ("m2", F.var_pop(c) * F.count(c)))],
                      F.lit(c in numeric and c not in few).alias("many")) for c in frame.columns]
    state = frame.agg(F.array(*whole).alias("_rows")).select(F.inline("_rows"))
    if few:  # a null counts as a value
        nulls = frame.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("rows")) for c in few]).alias("_rows"))
        state = state.unionByName(nulls.select(F.inline("_rows")).filter("rows > 0").withColumn("value", F.lit(NULL_VALUE)), allowMissingColumns=True)
    if listed:
        counts = frame.select(F.inline(cells)).filter("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
        state = state.unionByName(counts, allowMissingColumns=True)
    return state.withColumn("many", F.coalesce("many", F.lit(False)))


def merge_states(*states: DataFrame) -> DataFrame:
    """State of all months together; merging does not depend on their order."""
    rows = states[0]
    for state in states[1:]:
        rows = rows.unionByName(state)
    parts = F.collect_list(F.when(F.col("mean").isNotNull(), F.struct("rows", "mean", "m2")))
    merged = rows.groupBy("column_name", "value").agg(F.sum("rows").alias("rows"), F.max("many").alias("many"), parts.alias("_parts"))
    total = lambda value: F.aggregate("_parts", F.lit(0.0), lambda sum_, part: sum_ + value(part))
    merged = merged.withColumn("mean", F.try_divide(total(lambda p: p["rows"] * p["mean"]), F.col("rows")))
    merged = merged.withColumn("m2", total(lambda p: p["m2"] + p["rows"] * F.pow(p["mean"] - F.col("mean"), 2)))
    there = F.size("_parts") > 0
    # One row per column decides whether its values are still listed: no month has many, and together they are few.
    columns = merged.groupBy("column_name").agg(
        F.max("many").alias("_any"), F.count("value").alias("_values"), F.max(F.col("value").isNull() & there).alias("_numeric"))
    many = F.col("_any") | (F.col("_numeric") & (F.col("_values") >= MAX_DISTINCT))
    judged = merged.join(F.broadcast(columns), "column_name").withColumn("many", many)
    return judged.filter(F.col("value").isNull() | ~F.col("many")).select(
        "column_name", "value", "rows", *[F.when(there, F.col(c)).alias(c) for c in ("mean", "m2")],
        (F.col("many") & F.col("value").isNull()).alias("many"))


def profile_of_state(state: DataFrame) -> DataFrame:
    """What `column_profile` finds over all rows of the months in a state."""
    whole = state.filter("value IS NULL").select("column_name", F.col("rows").alias("_total"), "mean", "m2", "many")
    none = F.lit(None)
    shares = (state.filter(F.col("value").isNotNull() & (F.col("value") != NULL_VALUE)).select("column_name", "value", "rows")
              .join(F.broadcast(whole), "column_name").filter("NOT many")
              .select("column_name", F.lit("share").alias("kind"), "value", (F.col("rows") / F.col("_total")).alias("share"),
                      none.cast("double").alias("mean"), none.cast("double").alias("std")))
    moments = whole.filter("many").select(
        "column_name", F.lit("normal").alias("kind"), none.cast("string").alias("value"), none.cast("double").alias("share"),
        "mean", F.sqrt(F.try_divide(F.col("m2"), F.when(F.col("_total") > 1, F.col("_total") - 1))).alias("std"))
    return shares.unionByName(moments)


def _draw_value(rows: DataFrame, shares: DataFrame, column: str, key: str, seed: int) -> DataFrame:
    """Add `column`, drawn by share.

    Shares are whole units, so the intervals leave no gap and do not overlap. Up to GUIDED_VALUES values go
    into the expression itself with a guide: the first interval of each of _BUCKETS equal parts of the units. A draw
    goes to its part's interval and on through those that end in the same part, about one step: no join, no shuffle.
    """
    total = shares.agg(F.max("high")).first()[0]
    width = -(-total // _BUCKETS)
    unit = F.floor(uniform(seed, column, key) * F.lit(float(total))).cast("bigint")
    listed = shares.select("value", "high").limit(GUIDED_VALUES + 1).collect()
    if len(listed) > GUIDED_VALUES:
        return _draw_by_join(rows, shares, column, unit, width)
    listed.sort(key=lambda row: row.high)
    highs = [row.high for row in listed]
    guide = [bisect_right(highs, part * width) for part in range(_BUCKETS + 1)]
    texts, ends, starts = (F.lit(x) for x in ([row.value for row in listed], highs, guide))
    part = F.floor(F.col("_unit") / width).cast("int")
    first, last = F.get(starts, part), F.get(starts, part + 1)
    passed = F.size(F.filter(F.slice(ends, first + 1, last - first), lambda end: end <= F.col("_unit")))
    return rows.withColumn("_unit", unit).withColumn(column, F.get(texts, first + passed)).drop("_unit")


def _draw_by_join(rows: DataFrame, shares: DataFrame, column: str, unit: Column, width: int) -> DataFrame:
    """`_draw_value` for many values: an equi-join on buckets of units, then an interval test.

    A value is listed once per bucket its interval touches: the lookup has no more than values + buckets
    rows, and a value with a large share is spread over many buckets.
    """
    draws = rows.withColumn("_unit", unit).withColumn("_bucket", F.floor(F.col("_unit") / width))
    slots = F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))
    intervals = shares.select(F.col("value").alias(column), "low", "high", F.explode(slots).alias("_bucket"))
    return (draws.join(intervals, "_bucket")
            .filter((F.col("_unit") >= F.col("low")) & (F.col("_unit") < F.col("high")))
            .drop("_unit", "_bucket", "low", "high"))


def _intervals(profile: DataFrame, column: str) -> DataFrame:
    """Values of a column, each with the interval of units that stands for it."""
    units = F.round(F.col("share") * _UNITS).cast("bigint").alias("units")
    shares = (profile.filter((F.col("column_name") == column) & (F.col("kind") == "share"))
              .select("value", units).filter("units > 0"))
    through = running_total(shares, ["value"], F.col("units"), "high")
    return through.select("value", (F.col("high") - F.col("units")).alias("low"), "high")


def synthesize(spark: SparkSession, profile: DataFrame, columns: Mapping[str, str], rows: int,
               per_customer: int = 1, seed: int = SEED) -> DataFrame:
    """Rows drawn column by column from a profile; `per_customer` rows for each customer.

    `columns` names the columns and their types. Draws depend on the row number only, so
    the result does not change with partitioning or when a task runs again.
    """
    result = spark.range(rows * per_customer).select(
        F.col("id").alias("_row"), (F.col("id") % rows + 1).alias("customer_id"))
    moments = {row.column_name: row for row in profile.filter("kind = 'normal'").collect()}
    for column, kind in columns.items():
        if column in moments:
            value = F.lit(moments[column]["mean"]) + F.lit(moments[column]["std"]) * normal(seed, column, "_row")
            result = result.withColumn(column, from_epoch_seconds(value) if kind == "date" else value.cast(kind))
        else:
            drawn = _draw_value(result, _intervals(profile, column), column, "_row", seed)
            value = F.col(column)
            if kind == "date":
                value = from_epoch_seconds(value.cast("double"))
            result = drawn.withColumn(column, value.cast(kind))
    return result


def clamp_dates(rows: DataFrame, ref_month: str, history: bool, months: int = 6, seed: int = SEED) -> DataFrame:
    """Redraw dates on the wrong side of the reference date.

    History dates after it are drawn from as many days up to it as there are such rows (a
    century at most); target dates before it from the following `months` months.
    """
    start = month_start(ref_month)
    if history:
        misplaced = F.col("contract_date") > F.lit(start)
        span = rows.agg(F.greatest(F.count_if(misplaced), F.lit(1)).cast("double")).scalar()
        days = -F.floor(uniform(seed, "redraw", "_row") * F.least(span, F.lit(36525.0))).cast("int")
    else:
        misplaced = F.col("contract_date") < F.lit(start)
        span = (month_start(ref_month, months) + timedelta(days=1) - start).days
        days = F.floor(uniform(seed, "redraw", "_row") * F.lit(float(span))).cast("int")
    redrawn = F.date_add(F.lit(start), days)
    return rows.withColumn("contract_date", F.when(misplaced, redrawn).otherwise(F.col("contract_date")))


def one_row_per_pair(rows: DataFrame, keys: Sequence[str] = ("customer_id", "category")) -> DataFrame:
    """Keep the row with the lowest number for each key, with map-side reduction."""
    kept = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min(F.struct(*kept)).alias("_first")).select(
        *keys, *[F.col(f"_first.{c}").alias(c) for c in kept])


@dataclass(frozen=True)
class Sample:
    """Synthetic customers, history and target of one month, with the same IDs 1..n in all three."""

    customers: DataFrame
    history: DataFrame
    target: DataFrame


def sample_month(spark: SparkSession, profiles: Mapping[str, DataFrame], columns: Mapping[str, Mapping[str, str]],
                 rows: int, ref_month: str, history_rows: int = 10, target_rows: int = 5, seed: int = SEED) -> Sample:
    """Three tables drawn from the profiles of ``customers``, ``history`` and ``target``.

    `columns` names the columns of each and their types. A customer has `history_rows` contracts up to the first day of
    the reference month and `target_rows` after it, of which one per category stays. The tables use seeds
    of their own, so a customer's history and target are drawn independently.
    """
    drawn = {name: synthesize(spark, profiles[name], columns[name], rows, count, seed + place)
             for place, (name, count) in enumerate((("target", target_rows), ("history", history_rows), ("customers", 1)))}
    return Sample(drawn["customers"].drop("_row"), clamp_dates(drawn["history"], ref_month, history=True, seed=seed + 1).drop("_row"),
                  one_row_per_pair(clamp_dates(drawn["target"], ref_month, history=False, seed=seed)).drop("_row"))
