"""A Merkle manifest of a dataset: one hash of everything, and for each document a proof that it belongs.

Leaves of a source, in order of id, are hashed in runs of three until one node, the source's sub-root, is left; the
sub-roots, in order of source, likewise give the root.

A leaf's rank within its source, written in base 3, is its place in the tree. Ranks are cut into blocks of 3^6
leaves. Within a block the digits of the rank are grouped away one after the other, the last one first: each group is
a node that holds its at most three children as nested structs, and in the end a block is one row. The nodes of all
blocks are the leaves of the next, smaller table, treated alike, until each source is one node. On the way back each
block row meets the row with its own path to the root, by grouping both on source and block, and is unnested again, a
level at a time, each child getting its siblings. No row holds more than one block and no task more than it was dealt:
a source with a third of all documents is as many blocks as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantroom.llm.shared import stored

#: Children of a node, and digits of a rank that are grouped away within a block (3^6 = 729 leaves).
ARITY, DIGITS = 3, 6

#: What a document's hash covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: The siblings of a node at one level: hashes left of it and right of it, as one text each.
PATH = "array<struct<before:string,after:string>>"

MANIFEST = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def field_text(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon, and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(text: Column) -> Column:
    """The hash of a document whose `text` may have been changed."""
    return F.sha2(F.concat(*[field_text(text if name == "text" else F.col(name)) for name in FIELDS]), 256)


def tampered(text: Column) -> Column:
    """What tampering leaves of a text: where 2 divides the checksum of the id, its line feeds are gone."""
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def _numbered(sorted_rows: DataFrame, key: str) -> DataFrame:
    """Rows with the task that read them and their number among that task's rows of one key, which lie together."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key)
            runs = keys.dictionary_encode(null_encoding="encode")
            codes, names = runs.indices.to_numpy(zero_copy_only=False), runs.dictionary.to_pylist()
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            lengths = np.diff(np.append(starts, len(codes)))
            first = np.zeros(len(starts), dtype=np.int64)
            if last is not None and names[codes[0]] == last[0]:
                first[0] = seen
            local = np.arange(len(codes)) - np.repeat(starts, lengths) + np.repeat(first, lengths)
            last, seen = (names[codes[-1]],), int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(codes), part)), pa.array(local)], names=[*batch.schema.names, "part", "local"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sorted_rows.schema.fields)
    return sorted_rows.mapInArrow(number, f"{schema}, part long, local long")


def ranked(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Adds `rank`, from 0 within `key` by `order`, without bringing a key together; equal rows in any order.

    Rows are dealt out in sorted ranges. Only the first key of a range can have rows in earlier ranges, so the driver
    gets at most one number for each range. The sorted rows are stored: ranks and numbers come from the same ranges.
    """
    dealt = rows.withColumn("__tie", F.monotonically_increasing_id())
    by = [key, *order, "__tie"]
    dealt = stored(_numbered(dealt.repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie"), key), "merkle-ranks")
    counts = dealt.groupBy("part", key).agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.withColumn("ahead", F.sum("rows").over(earlier)).where("ahead > 0").collect()
    # one row for each range at most: a table of known size
    offsets = rows.sparkSession.createDataFrame(
        [(r["part"], r[key], r["ahead"]) for r in ahead], f"part long, __key {rows.schema[key].dataType.simpleString()}, ahead long"
    )
    joined = dealt.join(F.broadcast(offsets), (dealt["part"] == offsets["part"]) & dealt[key].eqNullSafe(F.col("__key")), "left")
    return joined.select(*rows.columns, (F.col("local") + F.coalesce("ahead", F.lit(0))).alias("rank"))


def rolled_up(nodes: DataFrame, key: str) -> DataFrame:
    """One row for each block of `nodes` (key, rank, hash, more): key, rank (the block's), hash, tree (nested children).

    A node with one child that is the first of its level is all there is of that level, and passes its child on.
    """
    digit = lambda k: F.expr(f"cast(pmod(rank div {ARITY**k}, {ARITY}) as int)")
    block = F.expr(f"rank div {ARITY**DIGITS}")
    digits = [f"d{k}" for k in range(DIGITS)]
    more = [name for name in nodes.columns if name not in (key, "rank", "hash")]
    below = F.struct(*more) if more else F.struct(F.lit(True).alias("node"))
    rows = nodes.select(key, block.alias("block"), *[digit(k).alias(d) for k, d in enumerate(digits)], "hash", below.alias("below"))
    rows = rows.repartition(key, "block")
    for k, d in enumerate(digits):
        higher = digits[k + 1 :]
        children = F.sort_array(F.collect_list(F.struct(d, "hash", "below"))).alias("below")
        rows = rows.groupBy(key, "block", *higher).agg(children)
        first = reduce(lambda a, b: a & b, [F.col(x) == 0 for x in ("block", *higher)])
        joined = F.concat_ws("", F.transform("below", lambda c: c["hash"]))
        alone = first & (F.size("below") == 1)
        rows = rows.withColumn("hash", F.when(alone, F.col("below")[0]["hash"]).otherwise(F.sha2(joined, 256)))
    return rows.select(key, F.col("block").alias("rank"), "hash", F.col("below").alias("tree"))


def unrolled(blocks: DataFrame, paths: DataFrame, key: str, top: list[str]) -> DataFrame:
    """The nodes that :func:`rolled_up` had, each with its `path` to the root (nearest level first).

    `paths` has a row for each block: key, rank, path and the columns `top`. Both meet by grouping, not by a join: a
    group is one block and one path.
    """
    nothing = [F.lit(None).cast(paths.schema[name].dataType).alias(name) for name in ("path", *top)]
    both = blocks.select(key, "rank", "tree", *nothing).unionByName(
        paths.select(key, "rank", F.lit(None).cast(blocks.schema["tree"].dataType).alias("tree"), "path", *top)
    )
    kept = [F.first(name, ignorenulls=True).alias(name) for name in ("tree", "path", *top)]
    rows = both.groupBy(key, "rank").agg(*kept).where("tree is not null")
    for _ in range(DIGITS):
        rows = rows.select(key, "rank", "path", *top, "tree", F.posexplode("tree").alias("place", "child"))
        # the number of a node at its own level: digits are read back as they were grouped away
        number = (F.col("rank") * ARITY + F.col("place")).alias("rank")
        hashes = F.transform("tree", lambda c: c["hash"])
        before = F.concat_ws("", F.slice(hashes, 1, F.col("place")))
        after = F.concat_ws("", F.slice(hashes, F.col("place") + 2, F.lit(ARITY)))
        alone = (F.col("rank") == 0) & (F.size("tree") == 1)
        level = F.array(F.struct(before.alias("before"), after.alias("after"))).cast(PATH)
        path = F.when(alone, F.col("path")).otherwise(F.concat(level, "path")).alias("path")
        rows = rows.select(key, number, path, *top, F.col("child")["hash"].alias("hash"), F.col("child")["below"].alias("tree"))
    return rows.select(key, "rank", "hash", "path", *top, "tree.*")


def _to_one(nodes: DataFrame, key: str) -> list[DataFrame]:
    """Tables of blocks, each made from the nodes of the one before, until every key is one block."""
    tables = [stored(rolled_up(nodes, key), "merkle-blocks")]
    while tables[-1].agg(F.max("rank")).first()[0]:
        tables.append(stored(rolled_up(tables[-1].select(key, "rank", "hash"), key), "merkle-blocks"))
    return tables


def _back(tables: list[DataFrame], paths: DataFrame, key: str, top: list[str]) -> DataFrame:
    """From the paths of the last table's blocks to the nodes of the first."""
    for blocks in reversed(tables):
        paths = unrolled(blocks, paths, key, top)
    return paths


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, level: F.sha2(F.concat(level["before"], node, level["after"]), 256))


def proof_hash(path: Column) -> Column:
    """The hash of all siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda level: F.concat(level["before"], level["after"]))), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, hash, and `seen`, the hash after tampering; the texts stay behind."""
    fields = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(name) for name in FIELDS[1:]])
    return fields.select("doc_id", "source", leaf_hash(F.col("text")).alias("hash"), leaf_hash(tampered(F.col("text"))).alias("seen"))


def proofs(nodes: DataFrame, key: str = "source", id_column: str = "doc_id") -> DataFrame:
    """Nodes (id, key, hash, more) with subroot, root and `path`, their siblings up to the root."""
    by_key = _to_one(ranked(nodes, key, id_column, "hash"), key)
    subroots = by_key[-1].select(F.lit(0).alias("all"), key, "hash")
    # keys are numbered like the documents of one more key
    over_keys = _to_one(ranked(subroots, "all", key), "all")
    top = over_keys[-1].select("all", "rank", F.array().cast(PATH).alias("path"), F.col("hash").alias("root"))
    of_keys = _back(over_keys, top, "all", ["root"])
    start = of_keys.select(key, F.lit(0).cast("long").alias("rank"), "path", F.col("hash").alias("subroot"), "root")
    return _back(by_key, start, key, ["subroot", "root"])


def manifest(docs: DataFrame) -> DataFrame:
    """Every document with its leaf, sub-root, root, the hash of its proof, and whether the tampered one still proves.

    Returns doc_id, leaf, subroot, root, proof_sha256 (of the untampered documents), folded_root (from the leaf of the
    document as tampered with, and the siblings as they were), verified (whether that is the root).

    Null fields are `-`; a null id comes first and is never tampered with; a null source is a source of its own, before
    all others. Documents of one id are ordered by leaf; equal documents are leaves of their own, in any order. An
    empty table has no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = leaves(docs)
    if rows.isEmpty():
        return spark.createDataFrame([], MANIFEST)
    found = proofs(rows)
    root = folded(F.col("seen"), F.col("path"))
    return found.select(
        "doc_id", F.col("hash").alias("leaf"), "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
