"""Leftmost non-overlapping regex matches with code-point offsets, in DataFrame functions only.

Patterns are written so that Java's matcher stays linear: possessive loops (no recursion over
long runs) and a look-behind, or the end of the match before, that keeps a failed run from
being tried again at each of its characters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = 64  # lengths are summed in runs of so many, so that many matches in a text stay cheap


def find(frame: DataFrame, text: str, patterns: dict[str, str], context: int = 0, rare: bool = False) -> DataFrame:
    """Add a column per pattern: an array of matches (s, e, v, left, right).

    s and e are code points, e exclusive; left and right hold up to `context` characters
    between this match and the neighbouring ones. Text must not be null. If most texts hold no
    match, `rare` matches them once instead of twice.
    """
    hits, gaps, lengths, runs = ({name: f"_{part}_{name}" for name in patterns} for part in ("hits", "gaps", "lengths", "runs"))
    there = {name: f"_there_{name}" for name in patterns if rare}
    frame = frame.withColumns({there[name]: F.col(text).rlike(patterns[name]) for name in there})

    def found(name: str, some: Column, none: Column) -> Column:
        return F.when(F.col(there[name]), some).otherwise(none) if rare else some

    frame = frame.withColumns({gaps[name]: found(name, F.split(text, pattern, -1), F.array(text)) for name, pattern in patterns.items()} | {
        hits[name]: found(name, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))
        for name, pattern in patterns.items()}).drop(*there.values())
    frame = frame.withColumns({lengths[name]: F.zip_with(hits[name], gaps[name], lambda v, g: (
        F.coalesce(F.char_length(v), F.lit(0)) + F.char_length(g)).cast("bigint")) for name in patterns})
    frame = frame.withColumns({runs[name]: _run_starts(F.col(lengths[name])) for name in patterns})
    return frame.withColumns({
        name: _placed(*[F.col(part[name]) for part in (hits, gaps, lengths, runs)], context)
        for name in patterns}).drop(*[part[name] for part in (hits, gaps, lengths, runs) for name in patterns])


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _run_starts(lengths: Column) -> Column:
    """Sum of all lengths before each run of STEP."""
    nothing = F.array(F.lit(0).cast("bigint"))
    later = F.sequence(F.lit(1), F.floor(F.size(lengths) / STEP).cast("int"))
    return F.when(F.size(lengths) < STEP, nothing).otherwise(F.aggregate(later, nothing, lambda done, i: F.concat(
        done, F.array(F.element_at(done, -1) + _total(F.slice(lengths, (i - 1) * STEP + 1, F.lit(STEP)))))))


def _placed(hits: Column, gaps: Column, lengths: Column, runs: Column, context: int) -> Column:
    """Matches with offsets: a match starts where the gaps and matches before it end."""
    def match(v: Column, i: Column) -> Column:
        run, gap = F.floor(i / STEP).cast("int"), F.get(gaps, i)
        start = F.get(runs, run) + _total(F.slice(lengths, run * STEP + 1, i % STEP)) + F.char_length(gap)
        left = F.substring(gap, -context, context) if context else F.lit("")
        right = F.substring(F.get(gaps, i + 1), 1, context) if context else F.lit("")
        return F.struct(start.alias("s"), (start + F.char_length(v)).alias("e"), v.alias("v"), left.alias("left"), right.alias("right"))

    return F.transform(hits, match)


def touches(spans: Column, s: Column, e: Column) -> Column:
    """Whether one of `spans` (sorted, not overlapping each other) overlaps s:e, by binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(26))])
    before = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(spans, at + step - 1)["s"] < e, at + step).otherwise(at))
    return F.coalesce(F.get(spans, before - 1)["e"] > s, F.lit(False))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn check of a non-empty string of digits."""
    figures = F.transform(F.sequence(F.lit(1), F.length(number)), lambda i: F.substring(F.reverse(number), i, F.lit(1)).cast("int"))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def joined(spans: Column, kinds: Sequence[str]) -> Column:
    """kind:start:end, comma-joined, of structs (s, k, e)."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")
