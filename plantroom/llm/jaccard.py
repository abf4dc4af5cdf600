"""N-gram Jaccard join with signature trees.

Texts are sets of word shingles; two link when the size of the intersection, in per cent of the union's, reaches a
threshold. All links between different sets are respected, but only as many are verified as the connected components
need.

1. *Who can have a partner.* A document that links with another shares a certain number of the shingles that come first
   in a fixed order with it. Shingles meet in ranges of their hashes; a set with too few that any other set has, too, is
   alone but for its copies. What a task sees twice it passes on once, so a shingle of every document is no hot group.
2. *Signature trees.* Equal sets become one. Sets with the same least hash, for several orders, form a block, and each
   block a tree: its nodes hold the OR of the bitmaps below, with the most tokens a set has at a bit, and the range of
   sizes. Two nodes at a time are walked down; a pair is dropped where the bits allow too little overlap, the sizes lie
   too far apart, or all sets below are connected already.
3. *Completion.* Sets of different components that share a shingle among their rarest ones, as every linked pair does,
   and that places, sizes and parity signatures allow, are verified. So no link between components is lost. Rare comes first by
   counts of all shingles in a table of fixed size: any order keeps the bound, and in this one a passage of many
   documents is among the rarest of few of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantroom.functions.columns import spread
from plantroom.llm.components import components
from plantroom.llm.shared import partitions, stored
from plantroom.llm.words import WordHashes, hashed, mixed_bits, pieces, shingles, split_words, texts

#: Orders in which least hashes are taken; sets of a block in one tree; bits of a node's bitmap; children of a node.
ORDERS, BLOCK, BITS, FANOUT = 2, 1024, 256, 8
#: Longs of a set's parity signature, which travels with pairs, not with shingles.
LONG = 32
#: Cells of the table that counts shingles; two that share a cell only come later in the order.
CELLS = 1 << 19
#: First shingles beyond those of which one must be shared, in per cent of a set.
EXTRA = 10
#: Place of a shingle that several sets of a piece have, and the most documents of a piece.
ELSEWHERE = 65_535

# ------------------------------------------------------------------------------------------------ sizes and bounds


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n has in common with any set it links with."""
    return -(-percent * n // 100)


def prefix_length(n: int, percent: int) -> int:
    """So many first shingles of a set hold at least one of any partner's first ones."""
    return n - least_overlap(n, percent) + 1


def long_prefix(n: int, percent: int) -> int:
    return min(n, prefix_length(n, percent) + EXTRA * n // 100)


def least_shared(n: int, percent: int) -> int:
    """So many of a set's first shingles (`long_prefix`) are among those of any set it links with, the smallest included."""
    return 1 + EXTRA * least_overlap(n, percent) // 100


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test, on sorted arrays of different values."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    common = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return 100 * common >= percent * (len(a) + len(b) - common)


def shingle_set(text: bytes | None, size: int, table: WordHashes) -> np.ndarray:
    return np.unique(shingles(hashed(split_words(text), table), size))


def parity(tokens: np.ndarray, longs: int) -> np.ndarray:
    """A signature whose bits flip with every token: two differ in no more bits than their sets differ in tokens."""
    bits = np.bincount((tokens >> np.uint64(8)) % np.uint64(64 * longs), minlength=64 * longs) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


# ------------------------------------------------------------------------------------------------ signature trees


class _Sets:
    """Sets of a block with a forest of what is known to be connected."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.parent = list(range(len(sets)))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i


class _Node:
    __slots__ = ("bits", "small", "large", "below", "members", "one")

    def __init__(self, bits, small: int, large: int, below: list, members: list[int]):
        self.bits, self.small, self.large, self.below, self.members, self.one = bits, small, large, below, members, len(members) == 1

    def connected(self, held: _Sets) -> int:
        """The root that all members have, or -1; once they are connected they stay so."""
        root = held.root(self.members[0])
        if not self.one:
            if any(held.root(i) != root for i in self.members):
                return -1
            self.one = True
        return root


def build(sets: list[np.ndarray]) -> _Node:
    """A tree over sets in the order of size and least hashes, bottom up."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][0]))
    level = []
    for i in order:
        bits = np.bincount((sets[i] >> np.uint64(40)) % np.uint64(BITS), minlength=BITS).astype(np.int32)
        level.append(_Node(bits, len(sets[i]), len(sets[i]), [], [i]))
    while len(level) > 1:
        level = [
            _Node(np.maximum.reduce([n.bits for n in part]), part[0].small, max(n.large for n in part), part, [i for n in part for i in n.members])
            for part in (level[k : k + FANOUT] for k in range(0, len(level), FANOUT))
        ]
    return level[0]


def _possible(a: _Node, b: _Node, percent: int) -> bool:
    """Whether sizes and bits allow two sets below to link: the overlap is at most the sum of the smaller bit counts."""
    if 100 * min(a.large, b.large) < percent * max(a.small, b.small):
        return False
    overlap = min(int(np.minimum(a.bits, b.bits).sum()), a.large, b.large)
    return 100 * overlap >= percent * (a.small + b.small - overlap)


def join(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set, a root that it shares with all sets connected with it by links."""
    held = _Sets(sets, percent)
    if len(sets) > 1:
        root = build(sets)
        waiting = [(root, root)]
        while waiting:
            a, b = waiting.pop()
            if a is not b:
                one = a.connected(held)
                if one >= 0 and one == b.connected(held):
                    continue
                if not _possible(a, b, percent):
                    continue
                if not a.below and not b.below:
                    if linked(sets[a.members[0]], sets[b.members[0]], percent):
                        held.parent[held.root(b.members[0])] = held.root(a.members[0])
                    continue
                if not a.below or (b.below and len(b.members) > len(a.members)):
                    a, b = b, a
                waiting += [(x, b) for x in a.below]
            elif a.below and a.connected(held) < 0:
                waiting += [(x, y) for i, x in enumerate(a.below) for y in a.below[i:]]
    return [held.root(i) for i in range(len(sets))]


# ------------------------------------------------------------------------------------------------ step 1

_SENT = "range int, piece long, place int, doc_id long, text_key long, n long, credit long, v binary, keys binary, places binary, tags binary, more binary"
_MET = "piece long, place int, doc_id long, text_key long, n long, credit long, v binary, places binary, counts binary"


def sketch(documents: DataFrame, size: int, percent: int, ranges: int) -> DataFrame:
    """One row per document, without `places`, and for each range and piece how many first shingles others share.

    Documents and their first shingles go through one shuffle, documents under range numbers below 0.
    """
    schema = pa.schema(
        [("range", pa.int32()), ("piece", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()),
         ("credit", pa.int64()), ("v", pa.binary()), ("keys", pa.binary()), ("places", pa.binary()), ("tags", pa.binary()), ("more", pa.binary())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in pieces(batches, rows=ELSEWHERE):
            sets = [shingle_set(text, size, table) for text in texts(batch)]
            n = len(sets)
            digest = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
            # one document stands for all here that have its set
            stands: dict[bytes, int] = {}
            for i, d in enumerate(digest):
                if d is not None:
                    stands.setdefault(d, i)
            chosen = list(stands.values())
            first = [sets[i][: long_prefix(len(sets[i]), percent)] for i in chosen]
            place = np.repeat(np.array(chosen, dtype=np.uint16), [len(f) for f in first])
            # first shingles have low hashes; scrambled, they spread over all ranges
            key = mixed_bits(np.concatenate(first)) if first else np.empty(0, dtype=np.uint64)
            order = np.argsort(key, kind="stable")
            key, place = key[order], place[order]
            new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.empty(0, dtype=bool)
            often = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1 if len(key) else new
            credit = np.bincount(place[often], minlength=n)
            # a shingle that two sets here have is passed on once, for documents elsewhere
            sent = new | ~often
            key, place = key[sent], np.where(often, ELSEWHERE, place)[sent].astype(np.uint16)
            tags = np.zeros(ELSEWHERE + 1, dtype=np.uint64)
            tags[chosen] = [int.from_bytes(digest[i][:6], "little") for i in chosen]
            tag = tags[place]
            piece = batch.column("row")[0].as_py()
            none = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1 - (piece * 0x9E3779B97F4A7C15 % 2**64 >> 32) % ranges] * n, pa.int32()), pa.array([piece] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)),
                 batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()), pa.array(credit.astype(np.int64)),
                 pa.array(digest, pa.binary()), none, none, none, none],
                schema=schema,
            )
            cut = np.searchsorted(_range(key, ranges), np.arange(ranges + 1))
            spans = [(r, cut[r], cut[r + 1]) for r in range(ranges) if cut[r] < cut[r + 1]]
            if spans:
                blank = [pa.nulls(len(spans), f.type) for f in schema]
                blank[0], blank[1] = pa.array([s[0] for s in spans], pa.int32()), pa.array([piece] * len(spans), pa.int64())
                # within a range 32 bits tell shingles apart; two that they do not only let more documents pass
                columns = (key.astype(np.uint32), place, tag.astype(np.uint32), (tag >> np.uint64(32)).astype(np.uint16))
                for column, values in enumerate(columns, 8):
                    blank[column] = pa.array([values[a:b].tobytes() for _, a, b in spans], pa.binary())
                yield pa.RecordBatch.from_arrays(blank, schema=schema)

    numbered = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    def meet(group: pa.Table) -> pa.Table:
        if group.column("range")[0].as_py() < 0:
            none = pa.nulls(group.num_rows, pa.binary())
            return group.select(["piece", "place", "doc_id", "text_key", "n", "credit", "v"]).append_column("places", none).append_column("counts", none)
        owner = group.column("piece").to_pylist()
        key, place, low, high = (
            [np.frombuffer(x, dtype=t) for x in group.column(c).to_pylist()]
            for c, t in (("keys", np.uint32), ("places", np.uint16), ("tags", np.uint32), ("more", np.uint16))
        )
        tag = np.concatenate(low).astype(np.uint64) | np.concatenate(high).astype(np.uint64) << np.uint64(32)
        every, all_places = np.concatenate(key), np.concatenate(place)
        order = np.argsort(every, kind="stable")
        first = np.flatnonzero(np.r_[True, every[order][1:] != every[order][:-1]])
        of_two = np.maximum.reduceat(tag[order], first) != np.minimum.reduceat(tag[order], first)
        of_two |= np.maximum.reduceat(all_places[order], first) == ELSEWHERE
        shared = np.empty(len(every), dtype=bool)
        shared[order] = np.repeat(of_two, np.diff(np.r_[first, len(every)]))
        out, start = [], 0
        for piece, own in zip(owner, place, strict=True):
            stop = start + len(own)
            used, n = np.unique(own[shared[start:stop] & (own != ELSEWHERE)], return_counts=True)
            if len(used):
                out.append((piece, used.astype(np.int32).tobytes(), n.astype(np.int32).tobytes()))
            start = stop
        columns = list(zip(*out, strict=True)) if out else [(), (), ()]
        blank = [pa.nulls(len(out), t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
        answers = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)]
        return pa.table([answers[0], *blank, *answers[1:]], names=["piece", "place", "doc_id", "text_key", "n", "credit", "v", "places", "counts"])

    return stored(numbered.mapInArrow(rows, _SENT).groupBy("range").applyInArrow(meet, _MET), "sketch")


def _range(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)


def shared_counts(sketched: DataFrame) -> DataFrame:
    """How many of a set's first shingles other sets of other pieces have: piece, place, shared."""

    def add(group: pa.Table) -> pa.Table:
        places, counts = (np.concatenate([np.frombuffer(x, dtype=np.int32) for x in group.column(c).to_pylist()]) for c in ("places", "counts"))
        total = np.bincount(places, weights=counts).astype(np.int64)
        used = np.flatnonzero(total)
        return pa.table({"piece": pa.array([group.column("piece")[0].as_py()] * len(used), pa.int64()), "place": used.astype(np.int32), "shared": total[used]})

    return sketched.where("places is not null").select("piece", "places", "counts").groupBy("piece").applyInArrow(add, "piece long, place int, shared long")


# ------------------------------------------------------------------------------------------------ steps 2 and 3


def _enough_shared(percent: int) -> Column:
    return F.col("credit") + F.coalesce("shared", F.lit(0)) >= 1 + F.expr(f"{EXTRA} * (({percent} * n + 99) div 100) div 100")


def token_sets(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The whole sets of one document for each wanted v (more than once only for rows equal in id and text): v, n, tokens,
    least hashes, signatures."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    wanted = wanted.where(F.length("v") > 0)
    same = rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["text_key"] == wanted["text_key"])
    held = rows.join(wanted, same).select(rows["text"], wanted["v"])

    def build_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in pieces(batches):
            sets = [shingle_set(text, size, table) for text in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("v"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()),
                 pa.array([[int(mixed_bits(s ^ np.uint64(k + 1)).min().view(np.int64)) for k in range(ORDERS)] for s in sets], pa.list_(pa.int64())),
                 pa.array([parity(s, LONG).tolist() for s in sets], pa.list_(pa.int64()))],
                names=["v", "n", "tokens", "least", "long"],
            )

    made = held.mapInArrow(build_rows, "v binary, n long, tokens binary, least array<long>, long array<long>")
    # a Bloom filter of the wanted texts, however small the documents, keeps most others out of the shuffle
    conf, setting = documents.sparkSession.conf, "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = conf.get(setting)
    conf.set(setting, "0")
    try:
        return stored(made, "sets")
    finally:
        conf.set(setting, before)


def block_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what is connected within blocks of one least hash."""
    spark = sets.sparkSession
    keyed = sets.select("v", F.posexplode("least").alias("turn", "key"))
    # grouped by a bucket, too, so that the join can split the least hash of a passage that many sets have
    bucket = spread(F.col("turn"), F.col("key")).alias("bucket")
    large = keyed.groupBy("turn", "key", bucket).agg(F.count("*").alias("members")).where(F.col("members") > 1).drop("bucket")
    # blocks beyond BLOCK sets are cut by a hash; links across the cut are left to the completion
    cut = F.pmod(F.xxhash64("v"), F.ceil(F.col("members") / BLOCK))
    slots = keyed.join(large, ["turn", "key"]).groupBy("v").agg(F.collect_set(F.struct("turn", "key", cut.alias("cut"))).alias("slots"))
    blocks = sets.select("v", "tokens").join(slots, "v").select(F.explode("slots").alias("s"), "v", "tokens").select("s.*", "v", "tokens")
    blocks = blocks.repartition(partitions(spark), "turn", "key", "cut").sortWithinPartitions("turn", "key", "cut", "v")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, sets = None, [], []

        def found() -> pa.RecordBatch | None:
            roots = join(sets, percent)
            pairs = [(ids[r], ids[i]) for i, r in enumerate(roots) if r != i]
            if pairs:
                return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*pairs, strict=True)], names=["a", "b"])
            return None

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("turn", "key", "cut", "v", "tokens"))
            for turn, key, cut, v, tokens in zip(*columns, strict=True):
                if (turn, key, cut) != block:
                    if len(sets) > 1 and (out := found()):
                        yield out
                    block, ids, sets = (turn, key, cut), [], []
                ids.append(v)
                sets.append(np.frombuffer(tokens, dtype=np.uint64))
        if len(sets) > 1 and (out := found()):
            yield out

    return blocks.mapInArrow(walk, "a binary, b binary")


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(20)) % np.uint64(CELLS)


def commonness(sets: DataFrame) -> np.ndarray:
    """How many shingles of all sets fall into each cell."""
    parts = 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            for tokens in batch.column("tokens").to_pylist():
                np.add.at(total, _cells(np.frombuffer(tokens, dtype=np.uint64)), 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([x.tobytes() for x in np.split(total, parts)], pa.binary())], names=["part", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, dtype=np.int64) for x in group.column("counts").to_pylist())
        return pa.table({"part": group.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, counts binary"
    rows = sets.select("tokens").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
    if not rows:
        return np.zeros(CELLS, dtype=np.int64)
    return np.concatenate([np.frombuffer(r["counts"], dtype=np.int64) for r in sorted(rows, key=lambda r: r["part"])])


def rarest(tokens: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """So many of a set's rarest shingles that any partner has one of them among its own."""
    return tokens[np.lexsort((tokens, counts[_cells(tokens)]))[: prefix_length(len(tokens), percent)]]


def _first_ones(sets: DataFrame, percent: int) -> DataFrame:
    """Each set with each of its rarest shingles and its place in their order."""
    counts = np.minimum(commonness(sets), 2**31 - 1).astype(np.int32)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = [rarest(np.frombuffer(t, dtype=np.uint64), counts, percent) for t in batch.column("tokens").to_pylist()]
            rows = pa.array(np.repeat(np.arange(len(first)), [len(f) for f in first]))
            token = np.concatenate(first).view(np.int64) if first else np.empty(0, dtype=np.int64)
            place = np.concatenate([np.arange(len(f)) for f in first]) if first else token
            columns = [*[batch.column(c).take(rows) for c in ("v", "component", "n")], pa.array(token), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, names=["v", "component", "n", "token", "place"])

    schema = "v binary, component binary, n long, token long, place long"
    return sets.select("v", "component", "n", "tokens").mapInArrow(explode, schema)


def remaining_links(sets: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between sets of different components, each verified."""
    held = sets.join(known, "v", "left").withColumn("component", F.coalesce("component", "v"))
    labelled = _first_ones(held, percent)
    mixed = labelled.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
    open_rows = stored(labelled.join(mixed, "token", "left_semi"), "open")
    a, b = open_rows.alias("a"), open_rows.alias("b")
    sizes = F.col("a.n") + F.col("b.n")
    # from the first shingle that two sets share on, both have to hold the least overlap; from later ones on they hold less
    ahead = F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
    pairs = a.join(
        b,
        (F.col("a.token") == F.col("b.token"))
        & (F.col("a.component") < F.col("b.component"))
        & (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
        & ((100 + percent) * ahead >= percent * sizes),
    )
    pairs = stored(pairs.select(F.col("a.v").alias("a"), F.col("b.v").alias("b")).distinct(), "pairs")
    # most pairs share a passage and no more: long signatures tell before whole sets are moved
    signs = [sets.select(F.col("v").alias(c), F.col("n").alias(f"n_{c}"), F.col("long").alias(f"long_{c}")) for c in ("a", "b")]
    bits = F.aggregate(F.zip_with("long_a", "long_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)
    near = pairs.join(signs[0], "a").join(signs[1], "b").where((100 - percent) * (F.col("n_a") + F.col("n_b")) >= (100 + percent) * bits)
    pairs = stored(near.select("a", "b").distinct(), "near-pairs")
    used = pairs.select(F.col("a").alias("v")).union(pairs.select(F.col("b").alias("v"))).distinct()
    used = stored(sets.select("v", "tokens").join(used, "v", "left_semi"), "near-sets")
    left, right = used.select(F.col("v").alias("a"), F.col("tokens").alias("x")), used.select(F.col("v").alias("b"), F.col("tokens").alias("y"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).to_pylist() for c in ("x", "y"))
            holds = [linked(np.frombuffer(p, dtype=np.uint64), np.frombuffer(q, dtype=np.uint64), percent) for p, q in zip(x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(holds, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(verify, "a binary, b binary")


def _labelled(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """Every row with the label of its class (null without words) and the class's least doc_id."""
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text")
    sketched = sketch(documents, size, percent, 4 * partitions(spark))
    rows = sketched.where("places is null").select("piece", "place", "doc_id", "text_key", "n", "credit", "v")
    possible = rows.join(shared_counts(sketched), ["piece", "place"], "left").where(_enough_shared(percent) & (F.col("n") > 0))
    wanted = stored(possible.groupBy("v").agg(F.min(F.struct("doc_id", "text_key")).alias("least")).select("v", "least.*"), "wanted")
    sets = token_sets(documents, wanted, size)
    first = stored(block_links(sets, percent), "block-links")
    known = components(first, "blocks")
    more = stored(remaining_links(sets, known, percent), "more-links")
    final = components(first.unionByName(more), "classes") if more.take(1) else known
    labelled = rows.join(final, "v", "left").select("doc_id", "text_key", "n", F.coalesce("component", "v").alias("label"))
    least = labelled.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least_id"))
    return labelled.join(least, "label", "left")


def classes(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Every row of the documents with its class: doc_id, n_shingles, component_id.

    Sets are the distinct shingles of `size` words (split at ASCII white space, A-Z in lower case); fewer words are one
    shingle; null and blank texts have none and link with nothing. `component_id` is the least doc_id reachable by
    links, the row's own included; null ids are reachable, but name no component where another id does. Repeated rows
    link with each other, as equal sets do. Further columns are ignored.
    """
    return _labelled(documents, size, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def one_of_each(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents without all but one of each class, with all their columns.

    Of a class, the row with the least doc_id stays (a null id only among null ids), of rows with that id the one with
    the least hash of its text, and one of rows that are equal in both. Texts without words are in no class and stay.
    """
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    kept = _labelled(documents, size, percent).where("label is not null").groupBy("label").agg(F.min(order).alias("kept"))
    kept = kept.select(F.col("kept.doc_id").alias("_kept_id"), F.col("kept.text_key").alias("_kept_key"))
    names = documents.columns
    filled = documents.withColumn("_text_key", F.xxhash64("text")).withColumn("_blank", F.coalesce(F.rlike("text", F.lit(r"\A[\x20\x09-\x0D]*+\z")), F.lit(True)))
    same = filled["doc_id"].cast("long").eqNullSafe(kept["_kept_id"]) & (filled["_text_key"] == kept["_kept_key"])
    once = filled.where(~F.col("_blank")).join(kept, same, "left_semi").dropDuplicates(["doc_id", "_text_key"])
    return once.select(*names).unionByName(filled.where("_blank").select(*names))
