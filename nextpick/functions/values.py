"""Small value expressions: rounding, percentages, membership, repeatable randomness."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_HASH_DIGITS = 12


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part / whole`` in percent; null where `whole` is zero."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def round_to_fifth(value: Column) -> Column:
    """Round to the unit 0.2 (a unit, not a number of decimals)."""
    return F.round(value * 5) / 5


def not_in(column: Column, values: Iterable) -> Column:
    """Negated membership that keeps nulls."""
    values = list(values)
    if not values:
        return F.lit(True)
    return column.isNull() | ~column.isin(values)


def not_blank(column: Column) -> Column:
    """True for non-empty text; false for null, as in a SQL filter."""
    return F.coalesce(column != "", F.lit(False))


def item_hit(items: Column, item: Column) -> Column:
    """1 if `item` is in the list `items`, else 0; a missing item or list is a miss."""
    return F.coalesce(F.array_contains(items, item).cast("int"), F.lit(0))


def sample_hash(seed: int, *columns: str) -> Column:
    """Text hash that orders rows repeatably under a seed, on any partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def uniform(seed: int, salt: str, *columns: str) -> Column:
    """Repeatable number in (0, 1) per row key."""
    text = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(salt), *[F.col(c).cast("string") for c in columns]))
    number = F.conv(F.substring(text, 1, _HASH_DIGITS), 16, 10).cast("double")
    return (number + 0.5) / float(16 ** _HASH_DIGITS)


def normal(seed: int, salt: str, *columns: str) -> Column:
    """Repeatable standard normal number per row key (Box-Muller)."""
    radius = F.sqrt(-2.0 * F.log(uniform(seed, salt + "/r", *columns)))
    return radius * F.cos(2.0 * F.pi() * uniform(seed, salt + "/a", *columns))
