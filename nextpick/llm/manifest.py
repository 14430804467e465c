"""Merkle manifest of a dataset: a hash tree over all documents, and a proof for each of them.

Every document is a leaf. The leaves of a source, in order of doc_id, form a tree in which every
FAN consecutive nodes become their hash until one is left, the subroot; the subroots, in order of
source, form the tree above, which ends in the root.

The tree is a rollup of nested structs. A leaf's rank in its source is written as digits to base
FAN. Within a block of FAN ** DIGITS leaves the digit columns are grouped away one after the
other, each group nesting the structs of its children; all these groups lie in the one shuffle by
block. Block hashes are the leaves of the next round, so rounds shrink by the block size, and
no row ever holds more than one block. Going down again, a block's row meets the path from
itself to the root in one group by block, and transform and explode hand each child its siblings:
no join anywhere.

A node that is alone in its tree stays as it is; a group of one node beside others is hashed. Ranks
are contiguous, so a group with one child whose number is 0 at every level is such a lone node.

Ranks: rows are staged, sorted by range, and counted through within each range; a source that
spans ranges (one may hold a third of all rows) goes on from the count of the ranges before. One
count per range goes through the driver. Ranges may cut through rows that share source, doc_id and
leaf; such rows are alike and their order doesn't matter.

Edges: a null value is hashed as ``-``, an empty text as ``0:``; null source comes first, as do null
ids in their source; rows that repeat an id are ordered by leaf, and repeated rows are leaves of their own.
A null id is never tampered with. A table of one row has its leaf as root and an empty proof. An empty
table gives no rows. Columns besides the five that are hashed play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nextpick.llm.common import ascii_lower, crc_of_id, table
from nextpick.sources.stage import stage

FAN = 16
DIGITS = 2  # of a block: at most FAN ** DIGITS nodes
HASHED = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPER_EVERY = 5


def leaf_hash(values: list[Column]) -> Column:
    """Hash of a row's values, each with its length before it."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return F.sha2(F.concat(*map(part, values)), 256)


def _count_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of each sorted row within its tree and range, and whether the tree is the range's first."""
    held, count, first = None, 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = pc.run_end_encode(batch.column("tree").cast(pa.string()))
        places, firsts, at = [], [], 0
        for end, tree in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
            if held is not None and tree != held:
                count, first = 0, False
            held = tree
            places.append(pa.array(range(count, count + end - at), pa.int64()))
            firsts.append(pa.repeat(pa.scalar(first), end - at))
            count, at = count + end - at, end
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.concat_arrays(places), pa.concat_arrays(firsts)],
            names=[*batch.schema.names, "place", "first"])


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Staged `rows` with ``rank``, from 0 in `order` within each ``tree``; `order` may not fix ties."""
    rows = stage(rows, "manifest-rows")
    columns = rows.columns
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("_metadata.file_name", "_metadata.row_index")  # the same whenever a file is read
    keys = ["tree", *order, "_tie"]
    ranges = rows.withColumn("_tie", tie).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    ranges = ranges.withColumn("part", F.spark_partition_id()).drop("_tie")
    schema = T.StructType([*ranges.schema, T.StructField("place", T.LongType()), T.StructField("first", T.BooleanType())])
    placed = stage(ranges.mapInArrow(_count_through, schema), "manifest-places")
    counts = placed.groupBy("part").agg(
        F.min("tree").alias("low"), F.max("tree").alias("high"),
        F.max_by("place", F.struct("tree", "place")).alias("last")).orderBy("part").collect()  # one row per range
    before, held, count = {}, None, 0
    for row in counts:
        before[row["part"]] = start = count if row["low"] == held else 0
        count = row["last"] + 1 + (start if row["low"] == row["high"] else 0)
        held = row["high"]
    listed = ",".join(str(before.get(i, 0)) for i in range(max(before, default=0) + 1))
    start = F.get(F.split(F.lit(listed), ","), F.col("part")).cast("bigint")
    return placed.withColumn("rank", F.col("place") + F.when(F.col("first"), start).otherwise(0)).select(*columns, "rank")


def _joined(children: Column) -> Column:
    return F.array_join(F.transform(children, lambda c: c["hash"]), "")


def rollup(nodes: DataFrame) -> DataFrame:
    """(tree, block, hash, children) of nodes (tree, rank, hash, body): digits grouped away, lowest first."""
    bits = FAN.bit_length() - 1
    digits = [f"d{i}" for i in range(DIGITS)]
    level = nodes.select("tree", F.shiftright("rank", bits * DIGITS).alias("block"), "hash", F.col("body").alias("inner"), *[
        F.shiftright("rank", bits * i).bitwiseAND(FAN - 1).alias(d) for i, d in enumerate(digits)]).repartition("tree", "block")
    for i, digit in enumerate(digits):
        above = digits[i + 1:]
        children = F.array_sort(F.collect_list(F.struct(F.col(digit).alias("digit"), "hash", "inner")))
        level = level.groupBy("tree", "block", *above).agg(children.alias("inner"))
        alone = (F.size("inner") == 1) & (F.col("block") == 0)
        for d in above:
            alone = alone & (F.col(d) == 0)
        level = level.withColumn("hash", F.when(alone, F.col("inner")[0]["hash"]).otherwise(F.sha2(_joined(F.col("inner")), 256)))
    return level.withColumnRenamed("inner", "children")


def climb(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Staged blocks of every round, from the nodes' blocks to those of one block per tree."""
    rounds = []
    while True:
        rounds.append(stage(rollup(nodes), f"manifest-{name}"))
        if not rounds[-1].agg(F.max("block")).first()[0]:
            return rounds
        nodes = rounds[-1].select("tree", F.col("block").alias("rank"), "hash", F.lit(None).cast("string").alias("body"))


def _steps(children: Column, alone: Column) -> Column:
    """Each child with its step up: the joined hashes to its left and right; none for a lone node."""
    def one(child: Column, at: Column) -> Column:
        left = _joined(F.slice(children, F.lit(1), at))
        right = _joined(F.slice(children, at + 2, F.lit(FAN)))
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        return F.struct(child["digit"].alias("digit"), child["hash"].alias("hash"), child["inner"].alias("inner"),
                        F.when(alone, F.slice(step, 1, 0)).otherwise(step).alias("step"))
    return F.transform(children, one)


def descend(blocks: DataFrame, paths: DataFrame, carried: list[str]) -> DataFrame:
    """(tree, rank, hash, body, path, carried) of the nodes in `blocks`, given each block's path.

    `paths` holds (tree, block, path, carried) once per block of `blocks`.
    """
    names = ["children", "path", *carried]
    both = blocks.select("tree", "block", "children").unionByName(paths, allowMissingColumns=True)
    level = both.groupBy("tree", "block").agg(*[F.first(n, ignorenulls=True).alias(n) for n in names])
    level = level.select("tree", F.col("block").alias("rank"), F.col("children").alias("inner"), "path", *carried)
    for _ in range(DIGITS):
        alone = (F.size("inner") == 1) & (F.col("rank") == 0)
        level = level.select("tree", "rank", "path", *carried, F.explode(_steps(F.col("inner"), alone)).alias("child")).select(
            "tree", (F.col("rank") * FAN + F.col("child.digit")).alias("rank"), F.col("child.hash").alias("hash"),
            F.col("child.inner").alias("inner"), F.concat("child.step", "path").alias("path"), *carried)
    return level.withColumnRenamed("inner", "body")


def _down(rounds: list[DataFrame], paths: DataFrame, carried: list[str]) -> DataFrame:
    """`descend` through all rounds of a tree, top first."""
    for blocks in reversed(rounds):
        nodes = descend(blocks, paths, carried)
        paths = nodes.select("tree", F.col("rank").alias("block"), "path", *carried)
    return nodes


def proofs(leaves: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Columns of `leaves`, and each row's ``path``, ``subroot`` and ``root``.

    `leaves` has a text column ``leaf``, the hash; `group` is its source. ``path`` lists, from the leaf to
    the root, the joined hashes left and right of the node.
    """
    body = F.struct(*leaves.columns)
    tree = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("s"), F.col(group)))  # null first
    rows = leaves.select(tree.alias("tree"), F.col("leaf").alias("hash"), body.alias("body"))
    keyed = rows.select("*", *[F.col(f"body.{c}").alias(f"_{i}") for i, c in enumerate(order)])
    numbered = ranked(keyed, [*[f"_{i}" for i in range(len(order))], "hash"])
    sources = climb(numbered, "leaves")
    subroots = sources[-1].select(F.lit("").alias("tree"), "hash", F.col("tree").alias("body"))
    tops = climb(ranked(subroots, ["body"]), "sources")
    start = tops[-1].select("tree", "block", F.expr("array_remove(array(struct('' AS left, '' AS right)), struct('' AS left, '' AS right))").alias("path"),
                            F.col("hash").alias("root"))
    found = _down(tops, start, ["root"])
    paths = found.select(F.col("body").alias("tree"), F.lit(0).cast("bigint").alias("block"), "path", "root", F.col("hash").alias("subroot"))
    return _down(sources, paths, ["root", "subroot"]).select("body.*", "path", "subroot", "root")


def proof_hash(path: Column) -> Column:
    """Hash of all siblings on a path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """Root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def op11_manifest(spark, sf_dir: str) -> DataFrame:
    """Manifest of all documents; every fifth id's text is tampered with and checked against it."""
    docs = table(spark, sf_dir, "documents")
    changed = [F.col(c) for c in HASHED[:-1]] + [ascii_lower(F.col("text"))]
    tampered = F.when(F.pmod(crc_of_id(F.col("doc_id")), F.lit(TAMPER_EVERY)) == 0, leaf_hash(changed))
    leaves = docs.select("doc_id", "source", leaf_hash([F.col(c) for c in HASHED]).alias("leaf"), tampered.alias("tampered"))
    found = proofs(leaves, "source", ["doc_id"])
    folded = found.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


ROUNDS = 8  # of the SQL: trees of up to FAN ** ROUNDS nodes


def _oracle() -> str:
    part = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(part.format(c) for c in [*HASHED[:-1], text]) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = ("list_reduce(list_prepend(xor(a, b), [0::UBIGINT FOR k IN range(8)]), "
            "lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END)")
    bytes_ = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)"
    with_ = [f"""documents_hashed AS (
  SELECT doc_id, source, {leaf('text')} AS leaf, {leaf(lower)} AS changed,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, {bytes_}), lambda a, b: {bits}), 4294967295::UBIGINT) AS crc
  FROM documents)""",
             """a0 AS MATERIALIZED (SELECT source AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
  leaf AS hash, leaf, doc_id, CASE WHEN crc % 5 = 0 THEN changed ELSE leaf END AS tampered FROM documents_hashed)"""]

    def levels(name: str) -> None:
        for k in range(ROUNDS):
            with_.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT tree, rank // {FAN} AS rank, list(hash ORDER BY rank) AS hashes,
  count(*) = 1 AND rank // {FAN} = 0 AS alone,
  CASE WHEN count(*) = 1 AND rank // {FAN} = 0 THEN min(hash) ELSE sha256(string_agg(hash, '' ORDER BY rank)) END AS hash
  FROM {name}{k} GROUP BY tree, rank // {FAN})""")

    def folded(name: str, base: str, start: str) -> str:
        """Fold rows of `base` through the levels of `name`, telling their siblings; the last table's name."""
        before = f"(SELECT *, {start} AS node, '' AS told FROM {base})"
        for k in range(ROUNDS):
            place = f"(({base}.rank // {FAN ** k}) % {FAN})"
            left, right = f"array_to_string(g.hashes[1:{place}], '')", f"array_to_string(g.hashes[{place} + 2:], '')"
            with_.append(f"""{base}_{k} AS MATERIALIZED (SELECT {base}.* EXCLUDE (node, told),
  CASE WHEN g.alone THEN node ELSE sha256({left} || node || {right}) END AS node,
  CASE WHEN g.alone THEN told ELSE told || {left} || {right} END AS told
  FROM {before} {base} JOIN {name}{k + 1} g ON g.tree IS NOT DISTINCT FROM {base}.tree AND g.rank = {base}.rank // {FAN ** (k + 1)})""")
            before = f"{base}_{k}"
        return before

    levels("a")
    with_.append(f"""b0 AS MATERIALIZED (SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS rank, hash, tree AS source FROM a{ROUNDS})""")
    levels("b")
    with_.append("c0 AS MATERIALIZED (SELECT f.doc_id, leaf, b0.hash AS subroot, b0.tree, b0.rank, f.node AS under, f.told AS below "
                 f"FROM {folded('a', 'a0', 'tampered')} f JOIN b0 ON b0.source IS NOT DISTINCT FROM f.tree)")
    over = folded("b", "c0", "under")
    return ("WITH " + ",\n".join(with_) + f"\nSELECT doc_id, leaf, subroot, b{ROUNDS}.hash AS root, sha256(below || told) AS proof_sha256, "
            f"node AS folded_root, node = b{ROUNDS}.hash AS verified FROM {over}, b{ROUNDS}")


ORACLE = _oracle()
