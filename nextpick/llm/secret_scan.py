"""Secrets by password guess cost.

Base patterns (assignments, access keys, hex runs) are found in DataFrame functions. Values in a
credential context that no base pattern takes (``pwd is ...``, ``Bearer ...``,
``scheme://user:value@``) are scored by dynamic programming: the cheapest way to cut the value into dictionary words,
dates, repeats, keyboard walks and brute-force spans, in log10 guesses. Values that cost at
least MIN_GUESSES are secrets too and are reported as kind ``assign``; in a URL the span is the value
alone, up to the last @ before the host. Where a base span takes part of such a value, what it leaves
(``&3xyz`` of ``password=Tr0ub4dor&3xyz``) is a span of its own, unless it is punctuation that ends a phrase. Assigned values get the
same score, which never removes a base span.

Pieces of a value, besides single characters: words of the dictionary (letters, or figures and signs in their
place), three or more equal characters, a block of up to BLOCK characters two to COPIES times, three or more
neighbouring keys, dates with or without separators. The cost is the least over all cuts into such pieces.

The dictionary is WORDS, the words of public vocabularies, and those that the documents themselves hold
outside of such contexts (words.counted, a bounded list). So that prose in any language isn't taken for a secret,
what follows a key word after a mere space is a candidate only if it isn't made of words alone (PROSE;
``secret garden``), except after ``Bearer``; and one word, or two with - or / between, that read like words
(words.Speech; ``pin: Hauptbahnhof``) are none after any key word. A passphrase of such words alone is therefore
found only by the base patterns.

Only offsets and candidate values reach Python, one Arrow batch at a time. Null text is empty text. Repeated
rows and null ids give one result row each, an empty table none; columns beyond text and `keep` are not looked at,
whatever their names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache, reduce
from operator import or_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nextpick.llm import words
from nextpick.llm.common import table
from nextpick.llm.spans import find, joined, touches

KINDS = ["assign", "access", "hex"]
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?+ *+[:=] *+["']?+[A-Za-z0-9+/_.=-]++""",
    "access": r"AKIA[A-Z0-9]++",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
}
#: Contexts that the base patterns miss; the value is what follows.
_WORD = r"(?:(?:\p{Lu}[\p{Ll}\p{M}]++){1,3}+|[\p{Ll}\p{M}]++(?:\p{Lu}[\p{Ll}\p{M}]++)?+|\p{Lu}++s?+|[\p{Lo}\p{Lm}\p{M}]++|[0-9]{1,4}+(?:st|nd|rd|th)?+)"
#: A value made of words (or ordinals) in the usual case, joined and surrounded by punctuation.
PROSE = rf"""["']?+(?=[^\s"'<>,;]*\p{{L}})[(“‘\[*_]*+{_WORD}(?:[-–—/’.:&+_…|·()、，。]++{_WORD})*+[\p{{P}}*|&&[^"',;]]*+(?=[\s"'<>,;]|$)"""
CONTEXT = r"""(?i:(?<![A-Za-z0-9])(?:pwd|pass|passphrase|passcode|password|passwd|secret|token|credentials?|api[ _-]?key|private[ _-]?key|access[ _-]?key|bearer|pin)\b["']?)(?:(?i: *[:=] *| is )| (?!""" + PROSE + r""")|(?<=(?i:bearer)) )["']?[^\s"'<>,;]{6,}+"""
PREFIX = r"""^(?i:(?:pwd|pass|passphrase|passcode|password|passwd|secret|token|credentials?|api[ _-]?key|private[ _-]?key|access[ _-]?key|bearer|pin)\b["']?(?: *[:=] *| is | )["']?)"""
#: The user and password of a URL; a number at the value's start that ends the authority is a port.
URL = r"""://[^\s:/@\["<>]*+:(?![0-9]{1,5}[/?#'])(?:[^\s/@"<>]|/(?!/)|@(?=[^\s/@"<>]*+@))++(?=@)"""
MIN_GUESSES = 8.0  # log10
CLOSING = ".,:;!?)]}([{*`|\\…_"
#: Fixed value: common words and passwords, most common first.
WORDS = """password the and you that for are with this have not from they will what about which when make can like time
just him know take people into year your good some could them see other than then now look only come over think also back
after use two how our work first well way even new want because any these give day most us is to of in it on at by as be or
an my one all would there their admin login welcome letmein dragon monkey master shadow sunshine princess football baseball
superman batman trustno secret token test guest user root hello love freedom whatever access pass key example sample
changeme default none null true false value string name number email server data file reset required expired protected
strong weak hint policy field manager""".split()
#: Fixed value: keyboard rows and digit order.
ROWS = ["qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "qwertzuiop", "azertyuiop"]
LEET = str.maketrans("4@310$5!7", "aaeiossit")
BLOCK, COPIES = 16, 4

RESULT = "assign array<struct<s:bigint,e:bigint>>, access array<struct<s:bigint,e:bigint>>, " \
         "hex array<struct<s:bigint,e:bigint>>, added array<struct<s:bigint,e:bigint>>, max_guesses double"


def _neighbours() -> set[str]:
    pairs = {row[i:i + 2] for row in ROWS for i in range(len(row) - 1)}
    return pairs | {p[::-1] for p in pairs}


_NEXT = _neighbours()
_DAY, _MONTH, _YEAR = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|1[0-2])", "(?:19[0-9]{2}|20[0-4][0-9])"
_DATES = [(re.compile(pattern), math.log10(guesses)) for pattern, guesses in (
    (_YEAR, 150),
    (f"{_DAY}{_MONTH}{_YEAR}|{_MONTH}{_DAY}{_YEAR}|{_YEAR}{_MONTH}{_DAY}", 365 * 150),
    (f"{_DAY}{_MONTH}[0-9][0-9]|{_MONTH}{_DAY}[0-9][0-9]|[0-9][0-9]{_MONTH}{_DAY}", 365 * 100),
    (rf"{_DAY}([-/.]){_MONTH}\1{_YEAR}|{_MONTH}([-/.]){_DAY}\2{_YEAR}|{_YEAR}([-/.]){_MONTH}\3{_DAY}", 365 * 150 * 4),
    (rf"{_DAY}([-/.]){_MONTH}\1[0-9][0-9]|{_MONTH}([-/.]){_DAY}\2[0-9][0-9]", 365 * 100 * 4))]


@lru_cache(maxsize=1)
def default_ranks() -> dict[str, int]:
    """Places of WORDS and the public vocabularies' words in a list of guesses."""
    return words.ranks([*WORDS, *words.listed()])


@lru_cache(maxsize=2)
def _dictionary(counted: tuple[str, ...]) -> tuple[dict[str, int], words.Speech]:
    """With the words of a corpus; a worker keeps it for its later tasks."""
    return words.ranks([*WORDS, *words.listed()], counted), words.Speech(counted)


def _symbols(value: str) -> int:
    """Size of the alphabet that a brute-force attack on `value` needs."""
    return max(10, 10 * any(c.isdigit() for c in value) + 26 * any(c.islower() for c in value)
               + 26 * any(c.isupper() for c in value) + 33 * any(not c.isalnum() for c in value))


@lru_cache(maxsize=4096)
def _date(part: str) -> float:
    """Cost of `part` as a date; infinite if it is none."""
    return min((cost for pattern, cost in _DATES if pattern.fullmatch(part)), default=math.inf)


def _word(part: str, low: str, plain: str, ranks: dict[str, int]) -> float:
    """Cost of `part` as a word of the dictionary; `low` is in lower case, `plain` without figures for letters."""
    rank = min(ranks.get(low, math.inf), 2 * ranks.get(plain, math.inf) if plain != low else math.inf)
    if rank == math.inf:
        return rank
    upper = sum(c.isupper() for c in part)
    cased = 1 if not upper else 2 if upper in (1, len(part)) else 2 ** min(upper, len(part) - upper)
    return math.log10(rank * cased) + 0.3


class _Run:
    """Least of best[start] + log10(end - start) over the starts of a run, for ends in ascending order.

    Once an earlier start is no dearer than a later one it stays so, since the logarithms come closer.
    """

    def __init__(self) -> None:
        self.starts: list[tuple[int, float]] = []

    def least(self, start: int, cost: float, end: int) -> float:
        """With `start` as one more, whose best is `cost`."""
        kept, least = [], math.inf
        for s, c in [*self.starts, (start, cost)]:
            total = c + math.log10(end - s)
            if total < least:  # a start that an earlier one beats is beaten for good
                kept.append((s, c))
                least = total
        while len(kept) > 1 and kept[-2][1] >= kept[-1][1]:  # dearer even without its longer way
            del kept[-2]
        self.starts = kept
        return least


def guess_cost(value: str, ranks: dict[str, int] | None = None) -> float:
    """log10 of the guesses that the cheapest segmentation of `value` needs; the dictionary gives words their places."""
    return _cheapest(value, default_ranks() if ranks is None else ranks, math.log10(_symbols(value)), {}) if value else 0.0


def _cheapest(value: str, ranks: dict[str, int], per_symbol: float, known: dict[str, float]) -> float:
    """Cost of `value`, a block of it included, with `per_symbol` for a character; `known` keeps the blocks' costs."""
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = low.translate(LEET)
    best = [0.0]
    same, walk, letters = _Run(), _Run(), 0
    same_from = walk_from = 0
    for end in range(1, len(value) + 1):
        cost = best[end - 1] + per_symbol
        if end > 1 and low[end - 2] != low[end - 1]:
            same, same_from = _Run(), end - 1
        if end > 1 and low[end - 2:end] not in _NEXT:
            walk, walk_from = _Run(), end - 1
        if end - same_from >= 3:
            cost = min(cost, same.least(end - 3, best[end - 3], end) + per_symbol)
        if end - walk_from >= 3:
            cost = min(cost, walk.least(end - 3, best[end - 3], end) + math.log10(94 * 2))
        if value[end - 1].isdigit():
            for size in range(4, min(10, end) + 1):
                cost = min(cost, best[end - size] + _date(value[end - size:end]))
        letters = letters + 1 if plain[end - 1].isalpha() else 0
        for size in range(2, min(words.LONGEST, letters) + 1):
            start = end - size
            if plain[start:end] in ranks or low[start:end] in ranks:
                cost = min(cost, best[start] + _word(value[start:end], low[start:end], plain[start:end], ranks))
        for size in range(2, min(BLOCK, end // 2) + 1):
            if value[end - 1] != value[end - 1 - size]:
                continue
            block, copies = value[end - size:end], 2
            while copies <= COPIES and copies * size <= end and value[end - copies * size:end - (copies - 1) * size] == block:
                if block not in known:
                    known[block] = _cheapest(block, ranks, per_symbol, known)
                cost = min(cost, best[end - copies * size] + known[block] + math.log10(copies))
                copies += 1
        best.append(cost)
    return best[-1]


def _listed(value: str, ranks: dict[str, int], speech: words.Speech) -> bool:
    """Whether `value` is a word, or two with - or / between, in a usual case; any word of up to three letters will do."""
    parts = re.split("[-/]", value.strip(".:!?*_…”’"))
    return len(parts) <= 2 and all(w.isalpha() and (w.islower() or w.istitle() or w.isupper()) and (
        w.lower() in ranks or speech.reads_well(w)) for w in parts)


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order of their starts, overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def _left(x: dict, base: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What the base spans, in order of their starts, leave of a candidate's value."""
    at, stop = x["e"] - x["after"] - len(x["v"]), x["e"] - x["after"]
    for s, e in [*base[max(0, bisect_left(base, (at, 0)) - 1):bisect_left(base, (stop, 0))], (stop, stop)]:
        if s > at and x["v"][at - stop:][:s - at].strip(CLOSING):
            yield at, s
        at = max(at, e)


def _score(batches: Iterator[pa.RecordBatch], counted: list[str]) -> Iterator[pa.RecordBatch]:
    ranks, speech = _dictionary(tuple(counted))
    pair = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
    for batch in batches:
        added, most = [], []
        for i, (open_ones, assigned) in enumerate(zip(batch.column("open").to_pylist(), batch.column("values").to_pylist(), strict=True)):
            costs = [guess_cost(v, ranks) for v in assigned or ()]
            taken, base = [], None
            for x in sorted(open_ones or (), key=lambda x: x["s"]):
                if x["hit"] and base is None:
                    base = _merged((y["s"], y["e"]) for k in KINDS for y in batch.column(k)[i].as_py() or ())
                parts = list(_left(x, base)) if x["hit"] else [(x["s"], x["e"])]
                cost = 0.0 if not parts or (x["told"] and _listed(x["v"], ranks, speech)) else guess_cost(x["v"], ranks)
                if cost >= MIN_GUESSES:
                    costs.append(cost)
                    for s, e in parts:
                        if taken and s < taken[-1]["e"]:  # a URL in an assigned value
                            taken[-1]["e"] = max(taken[-1]["e"], e)
                        else:
                            taken.append({"s": s, "e": e})
            added.append(taken)
            most.append(max(costs, default=0.0))
        names = [n for n in batch.schema.names if n not in ("open", "values")]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(added, pair), pa.array(most, pa.float64())],
                                         names=[*names, "added", "max_guesses"])


def _value(match: Column) -> Column:
    """Group 2 of an assignment."""
    return F.regexp_extract(match, r"""^(?i:[a-z_]+)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)$""", 1)


def _after_user(match: Column) -> Column:
    """The password of a URL's ``://user:password``."""
    return F.regexp_replace(match, "^://[^:]*+:", "")


def _pairs(spans: Column) -> Column:
    return F.transform(spans, lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e")))


def _candidates(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """`keep` columns, the base spans, and what Python scores: open candidates and assigned values."""
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_text"))
    found = find(rows, "_text", PATTERNS | {"context": CONTEXT, "url": URL}, rare=True).drop("_text")
    found = found.withColumns({
        "assign": F.filter("assign", lambda m: F.length(_value(m["v"])) >= 6),
        "access": F.filter("access", lambda m: F.length(m["v"]) >= 20)})

    def candidate(s: Column, e: Column, whole: Column, v: Column, told: Column) -> Column:
        hit = reduce(or_, [touches(F.col(k), s, e) for k in KINDS])
        return F.struct(s.alias("s"), e.alias("e"), (F.char_length(whole) - F.char_length(v)).alias("after"), v.alias("v"),
                        told.alias("told"), hit.alias("hit"))

    def in_context(m: Column) -> Column:
        value = F.regexp_replace(m["v"], PREFIX, "")
        return candidate(m["s"], m["e"], value, F.rtrim(value, F.lit(".)]}")), F.lit(True))

    def in_url(m: Column) -> Column:
        value = _after_user(m["v"])
        return candidate(m["e"] - F.char_length(value), m["e"], value, value, F.lit(False))

    open_ones = F.filter(F.transform("context", in_context), lambda x: F.length(x["v"]) >= 6)
    return found.select(*keep, *[_pairs(F.col(k)).alias(k) for k in KINDS],
                        F.concat(open_ones, F.transform("url", in_url)).alias("open"),
                        F.transform("assign", lambda m: _value(m["v"])).alias("values"))


def find_secrets(docs: DataFrame, keep: Sequence[str] = ("doc_id",), counted: list[str] | None = None) -> DataFrame:
    """`keep` columns, assign, access, hex, added (arrays of s, e) and the highest guess cost, per row of `docs`.

    `counted` are the words of the corpus, most frequent first; if none are given they are counted in `docs`.
    """
    counted = words.counted(docs) if counted is None else counted
    schema = T.StructType([*docs.select(*keep).schema.fields, *T.StructType.fromDDL(RESULT).fields])
    return _candidates(docs, keep).mapInArrow(lambda batches: _score(batches, counted), schema)


def _structs(name: str, kind: int) -> Column:
    return F.transform(name, lambda m: F.struct(m["s"].alias("s"), F.lit(kind).alias("k"), m["e"].alias("e")))


def redact(docs: DataFrame, keep: Sequence[str], mark: str = "[SECRET]", counted: list[str] | None = None) -> DataFrame:
    """`keep` columns (with text) and n_secrets, per row of `docs`: every secret in text is replaced by `mark`.

    The text is cut in the batch that scores it, so that a task needs one Python worker only. `counted` as in `find_secrets`.
    """
    counted = words.counted(docs) if counted is None else counted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _score(batches, counted):
            spans = [sorted((x["s"], x["e"]) for own in row for x in own)
                     for row in zip(*(batch.column(k).to_pylist() for k in (*KINDS, "added")), strict=True)]
            texts, hit = batch.column("text"), pa.array([bool(own) for own in spans], pa.bool_())
            clean = pa.array([without(t.as_py(), own, mark) for t, own in zip(texts, spans, strict=True) if own], texts.type)
            texts = pc.replace_with_mask(texts, hit, clean)
            yield pa.RecordBatch.from_arrays(
                [texts if n == "text" else batch.column(n) for n in keep] + [pa.array([len(own) for own in spans], pa.int64())],
                names=[*keep, "n_secrets"])

    return _candidates(docs, keep).mapInArrow(run, docs.select(*keep).schema.add("n_secrets", T.LongType()))


def without(text: str, spans: Iterable[tuple[int, int]], mark: str) -> str:
    """Text with every span, in order of their starts, replaced by `mark`; what overlaps the one before shares its mark."""
    parts, at = [], 0
    for start, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    """Digest of secrets per document; see `find_secrets`."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.concat(*[_structs(k, i) for i, k in enumerate(KINDS)]))
    every = F.array_sort(F.concat(*[_structs(k, i) for i, k in enumerate(KINDS)], _structs("added", 0)))
    return found.select("doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined(base, KINDS), 256).alias("base_sha256"), joined(every, KINDS).alias("spans"),
                        F.size("added").cast("bigint").alias("n_added"), "max_guesses")
