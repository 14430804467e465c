"""Benchmark decontamination: windows of benchmark words found in training documents and cut out.

Texts are lower-cased (A-Z) and cut into words. Every LENGTH consecutive words of a benchmark item
are a window; an item of fewer words is one window itself. All windows are hashed into a set, which
goes to the executors; documents are scanned window by window, in numpy, over all texts of a
piece at once. A window whose hash is in the set is compared with the items' words before it
counts, so hashes decide nothing. Words inside any found window are hit; `remove` cuts them out of
their document, or drops the document.

The set is broadcast if the benchmark's text is at most MOST_BYTES, which is measured. A larger
benchmark stays distributed: its windows fold into a bitmap of BITMAP_BITS (a fixed size), documents
emit the windows that the bitmap lets through, and these meet the benchmark's windows in joins by the
window's words, hot ones salted. Copies of a text emit their windows once.

Edges: null and empty texts have no words and no hits. Each row has its own result, whether ids
repeat or are null. An item without words has no window. Items that share an id are one item with the windows of
all its rows; a null item id counts as an item that is listed as empty text. Empty tables give no rows, or no hits. Other columns
play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nextpick.llm.common import table
from nextpick.llm.tokens import Words, pieces, window_hashes, word_hashes, words_of
from nextpick.operators.joins import hot_keys, lookup_join, salted_join
from nextpick.sources.stage import stage

LENGTH = 10
MOST_BYTES = 16 << 20
BITMAP_BITS = 1 << 26
SPANS = "array<struct<start:bigint,end:bigint>>"


def _windows(words: Words, length: int) -> dict[int, np.ndarray]:
    """First words of the windows of a benchmark's items, by number of words."""
    counts = words.per_row()
    found = {}
    whole = np.flatnonzero(counts[words.row] >= length) if len(words.row) else np.zeros(0, np.int64)
    fits = whole[whole + length <= len(words.row)]
    fits = fits[words.row[fits + length - 1] == words.row[fits]]
    if len(fits):
        found[length] = fits
    for short in range(1, length):
        rows = np.flatnonzero(counts == short)
        if len(rows):
            found[short] = np.searchsorted(words.row, rows)
    return found


class Grams:
    """Windows of a benchmark: sorted hashes by number of words, and the words to compare with."""

    def __init__(self, item_ids: list[str], texts: pa.Array, length: int = LENGTH):
        self.item_ids, self.words = item_ids, words_of(texts)
        hashes = word_hashes(self.words)
        self.sets = {}
        for size, first in _windows(self.words, length).items():
            keys = window_hashes(hashes, size)[first]
            order = np.argsort(keys, kind="stable")
            self.sets[size] = (keys[order], first[order])

    def items(self, size: int, key: np.uint64, gram: bytes) -> tuple[str, ...]:
        """Items that hold these words as a window."""
        keys, first = self.sets[size]
        low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        return tuple({self.item_ids[self.words.row[i]] for i in first[low:high] if self.words.join(i, i + size) == gram})


def _candidates(words: Words, sizes: list[int], passes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, first word, hash) of the windows within one text whose hashes `passes`."""
    hashes = word_hashes(words)
    for size in sizes:
        keys = window_hashes(hashes, size)
        at = np.flatnonzero(passes(size, keys))
        at = at[words.row[at] == words.row[at + size - 1]]
        if len(at):
            yield size, at, keys[at]


def _member(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[place] == keys


def _merged(hit: np.ndarray, words: Words) -> list[list[dict]]:
    """Runs of hit words of each text, as numbers of its words."""
    first_word = np.searchsorted(words.row, np.arange(words.rows))
    spans = [[] for _ in range(words.rows)]
    at = np.flatnonzero(hit)
    if len(at):
        breaks = np.flatnonzero((np.diff(at) > 1) | (np.diff(words.row[at]) > 0))
        for low, high in zip(at[np.r_[0, breaks + 1]].tolist(), at[np.r_[breaks, len(at) - 1]].tolist(), strict=True):
            row = words.row[low]
            spans[row].append({"start": low - int(first_word[row]), "end": high + 1 - int(first_word[row])})
    return spans


def _scan_piece(words: Words, grams: Grams) -> tuple[list[list[str]], list[list[dict]]]:
    """Items and spans found in each text."""
    cover = np.zeros(len(words.row) + 1, np.int64)
    found = defaultdict(set)
    known: dict[bytes, tuple[str, ...]] = {}
    for size, at, keys in _candidates(words, list(grams.sets), lambda s, k: _member(k, grams.sets[s][0])):
        for i, key in zip(at.tolist(), keys, strict=True):
            gram = words.join(i, i + size)
            items = known.get(gram)
            if items is None:
                items = grams.items(size, key, gram)
                if items:
                    known[gram] = items
            if items:
                cover[i] += 1
                cover[i + size] -= 1
                found[int(words.row[i])].update(items)
    return ([sorted(found[r]) if r in found else [] for r in range(words.rows)],
            _merged(np.cumsum(cover[:-1]) > 0, words))


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])


_ITEMS, _SPANS = pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _plus(frame: DataFrame, drop: str, **fields: str) -> T.StructType:
    kept = [f for f in frame.schema if f.name != drop]
    return T.StructType([*kept, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items()]])


def _small_scan(docs: DataFrame, benchmark: pa.Table, length: int) -> DataFrame:
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast((benchmark.column("item").to_pylist(), benchmark.column("text").combine_chunks()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(*shipped.value, length)
        for batch in batches:
            for part in pieces(batch, "_text"):
                words = words_of(part.column("_text"))
                items, spans = _scan_piece(words, grams)
                yield _with(part.drop_columns(["_text"]), n_words=pa.array(words.per_row()), items=pa.array(items, _ITEMS),
                            spans=pa.array(spans, _SPANS))

    return docs.mapInArrow(scan, _plus(docs, "_text", n_words="bigint", items="array<string>", spans=SPANS))


def _bit(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys % np.uint64(bits)).astype(np.int64)


def _large_scan(docs: DataFrame, benchmark: DataFrame, length: int, bits: int) -> DataFrame:
    """As `_small_scan`, for a benchmark that is not broadcast."""
    spark = docs.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                words = words_of(part.column("text"))
                hashes, items = word_hashes(words), part.column("item").to_pylist()
                for size, first in _windows(words, length).items():
                    keys = window_hashes(hashes, size)[first]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([words.join(i, i + size) for i in first.tolist()], pa.binary()),
                        pa.array([items[r] for r in words.row[first].tolist()], pa.string()),
                        pa.array(np.full(len(first), size, np.int32)), pa.array(_bit(keys, bits))], names=["gram", "item", "size", "bit"])

    grams = stage(benchmark.mapInArrow(cut, "gram binary, item string, size int, bit bigint"), "grams")
    # At most bits / 64 words and `length` sizes go through the driver, whatever the benchmark's size.
    marks = grams.groupBy("size", F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toArrow()
    maps = {}
    for size in sorted(set(marks.column("size").to_pylist())):
        chosen = np.asarray(marks.column("size")) == size
        made = np.zeros(bits // 64, np.uint64)
        made[np.asarray(marks.column("word"))[chosen]] = np.asarray(marks.column("bits"))[chosen].view(np.uint64)
        maps[size] = made
    shipped = spark.sparkContext.broadcast(maps)

    def passes(size: int, keys: np.ndarray) -> np.ndarray:
        bit = _bit(keys, bits)
        return (shipped.value[size][bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) != 0

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "_text"):
                words = words_of(part.column("_text"))
                digests = [hashlib.sha256((t or "").encode("utf-8", "surrogatepass")).digest() for t in part.column("_text").to_pylist()]
                seen = [[] for _ in digests]
                for size, at, _ in _candidates(words, list(shipped.value), passes):
                    first = np.searchsorted(words.row, words.row[at])
                    for i, f in zip(at.tolist(), first.tolist(), strict=True):
                        seen[words.row[i]].append({"gram": words.join(i, i + size), "at": i - f, "size": size})
                kind = pa.list_(pa.struct([("gram", pa.binary()), ("at", pa.int64()), ("size", pa.int32())]))
                yield _with(part.drop_columns(["_text"]), n_words=pa.array(words.per_row()), key=pa.array(digests, pa.binary()),
                            seen=pa.array(seen, kind))

    rows = stage(docs.mapInArrow(keyed, _plus(docs, "_text", n_words="bigint", key="binary",
                                              seen="array<struct<gram:binary,at:bigint,size:int>>")), "windows")
    windows = rows.select("key", F.explode("seen").alias("w")).select("key", "w.gram", "w.at", "w.size").distinct()
    known = grams.select("gram", "item").distinct()
    met = stage(salted_join(windows, known, "gram", hot_keys(windows, "gram")), "met")
    spans = met.select("key", "at", "size").distinct().groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct(F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("end")))).alias("w"))
    last = lambda runs: F.element_at(runs, -1)
    merged = F.aggregate("w", F.expr(f"cast(array() as {SPANS})"), lambda runs, w: F.when(
        (F.size(runs) > 0) & (F.try_element_at(runs, F.lit(-1))["end"] >= w["start"]),
        F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(F.struct(
            F.try_element_at(runs, F.lit(-1))["start"].alias("start"),
            F.greatest(F.try_element_at(runs, F.lit(-1))["end"], w["end"]).alias("end"))))).otherwise(F.concat(runs, F.array(w))))
    items = met.select("key", "item").distinct().groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    hits = stage(spans.select("key", merged.alias("spans")).join(items, "key"), "hits")
    found = lookup_join(rows.drop("seen"), hits, "key", "left")
    return found.withColumns({"items": F.coalesce("items", F.expr("cast(array() as array<string>)")),
                              "spans": F.coalesce("spans", F.expr(f"cast(array() as {SPANS})"))}).drop("key")


def _scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], length: int, most_bytes: int | None, bits: int) -> DataFrame:
    """As `scan`, with the kept columns by number, whatever their names are."""
    most_bytes = MOST_BYTES if most_bytes is None else most_bytes
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text"))
    rows = docs.select(F.col("text").alias("_text"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.octet_length("item") + 16)).first()[0] or 0
    return _small_scan(rows, items.toArrow(), length) if size <= most_bytes else _large_scan(rows, items, length, bits)


def _named(frame: DataFrame, keep: list[str], *more: str) -> DataFrame:
    return frame.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *more)


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], length: int = LENGTH, most_bytes: int | None = None,
         bits: int = BITMAP_BITS) -> DataFrame:
    """`keep` columns of every row of `docs`, ``n_words``, the ``items`` found and the ``spans`` of hit words.

    Spans are runs of hit words, as numbers of the text's words, end exclusive.
    """
    return _named(_scan(docs, benchmark, keep, length, most_bytes, bits), keep, "n_words", "items", "spans")


def remove(docs: DataFrame, benchmark: DataFrame, documents: bool = False, length: int = LENGTH,
           most_bytes: int | None = None, bits: int = BITMAP_BITS) -> DataFrame:
    """`docs` without the hit words of each text, or without the documents that have any.

    A run of hit words goes from its first word's first character to its last one's last.
    """
    names = docs.columns
    found = _scan(docs, benchmark, names, length, most_bytes, bits)
    if documents:
        return _named(found.filter(F.size("spans") == 0), names)
    place = names.index("text")
    rows = found.select("spans", *[f"_k{i}" for i in range(len(names))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, f"_k{place}"):
                texts = part.column(f"_k{place}")
                words, new = words_of(texts), texts.to_pylist()
                first = np.searchsorted(words.row, np.arange(words.rows))
                for row, spans in enumerate(part.column("spans").to_pylist()):
                    if spans:
                        raw, origin, at, kept = new[row].encode("utf-8", "surrogatepass"), words.origin[row], 0, []
                        for span in spans:
                            kept.append(raw[at:words.start[first[row] + span["start"]] - origin])
                            at = words.end[first[row] + span["end"] - 1] - origin
                        new[row] = b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")
                columns = [c for n, c in zip(part.schema.names, part.columns, strict=True) if n != "spans"]
                columns[place] = pa.array(new, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=[f"_k{i}" for i in range(len(names))])

    return _named(rows.mapInArrow(cut, T.StructType([f for f in rows.schema if f.name != "spans"])), names)


def op12_decontamination(spark, sf_dir: str) -> DataFrame:
    """Hits of all benchmark items in all documents; see `scan`."""
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def _oracle() -> str:
    words = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce({words}, []) AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {words} AS w FROM benchmark),
grams AS MATERIALIZED (SELECT DISTINCT item, least(len(w), {LENGTH}) AS size, array_to_string(w[i:i + least(len(w), {LENGTH}) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), {LENGTH}) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM grams),
windows AS (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
met AS MATERIALIZED (SELECT r, i, w.size, item FROM windows w JOIN grams g ON g.gram = w.gram AND g.size = w.size),
hit AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT r, i, size FROM met)) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT r, item FROM met) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""


ORACLE = _oracle()
