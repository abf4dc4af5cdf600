"""Benchmark decontamination by fingerprints of item-sized windows.

A document is read through windows as long as each benchmark item. A window gets a SimHash of its word shingles, and a
multi-index finds the items whose fingerprint is within a Hamming radius: eight blocks of eight bits, each with all
values near an item's, so that no fingerprint within the radius is missed. What it finds is decided by the exact
similarity of the shingles, weighted by how often they occur.

A window as similar as is asked holds most of its item's shingles. Documents without that many of any item's are not
read further; that is exact, too, and costs one look at each shingle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantroom.llm.words import WordHashes, hashed, pieces, shingles, split_words, texts

SHINGLE, PERCENT = 5, 80
#: Bits in which a window's fingerprint may differ from an item's, and in one of the eight blocks at least.
RADIUS, BLOCK_RADIUS = 23, 2
#: Bytes of benchmark text that travel with the tasks at a time; a larger benchmark is taken in blocks.
BLOCK_BYTES = 8 << 20
#: Windows of a text that are fingerprinted at a time.
WINDOWS = 4096

_FOUND = "doc_id long, text_key long, item_id long, start_word long, n_words long, similarity double, distance int"
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def signs(keys: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each hash."""
    return np.unpackbits(keys.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """SimHash, as 8 bytes, from sums of signs."""
    return np.packbits(sums > 0, axis=1)


def similarity(a: Counter, b: Counter) -> tuple[int, int]:
    """Weight of the common shingles and of all: the similarity is their ratio."""
    common = sum(min(n, b[k]) for k, n in a.items())
    return common, sum(a.values()) + sum(b.values()) - common


class Sized:
    """Items of one length, with the multi-index over their fingerprints."""

    def __init__(self, length: int, items: list[tuple[int, np.ndarray]]):
        self.length, self.size = length, min(SHINGLE, length)
        self.items = items
        self.shingles = [shingles(w, self.size) for _, w in items]
        self.counts = [Counter(s.tolist()) for s in self.shingles]
        self.least = -(-PERCENT * (length - self.size + 1) // 100)
        self.prints = fingerprints(np.stack([signs(s).sum(axis=0) for s in self.shingles]))
        values = np.arange(256, dtype=np.uint8)
        # near[block, value, item]: whether the item's block differs from the value in few enough bits
        self.near = np.stack([_POPCOUNT[values[:, None] ^ self.prints[None, :, j]] <= BLOCK_RADIUS for j in range(8)])

    def within(self, prints: np.ndarray) -> list[tuple[int, int, int]]:
        """(window, item, distance) of all within the radius."""
        candidate = np.zeros((len(prints), len(self.items)), dtype=bool)
        for j in range(8):
            candidate |= self.near[j][prints[:, j]]
        window, item = np.nonzero(candidate)
        distance = _POPCOUNT[prints[window] ^ self.prints[item]].sum(axis=1)
        return [(int(w), int(i), int(d)) for w, i, d in zip(window, item, distance, strict=True) if d <= RADIUS]


class Index:
    """A block of the benchmark."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        table = WordHashes()
        by_length: dict[int, list] = {}
        for item_id, text in rows:
            words = hashed(split_words(text), table)
            if len(words):
                by_length.setdefault(len(words), []).append((item_id, words))
        self.sized = [Sized(n, items) for n, items in sorted(by_length.items())]
        self.keys: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({s.size for s in self.sized}):
            found = [(int(k), g, i) for g, s in enumerate(self.sized) if s.size == size for i, own in enumerate(s.shingles) for k in set(own.tolist())]
            found.sort()
            key = np.array([f[0] for f in found], dtype=np.uint64)
            sieve = np.zeros(1 << 20, dtype=bool)
            sieve[(key & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.keys[size] = (key, np.array([f[1] for f in found]), np.array([f[2] for f in found]), sieve)

    def hits(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each group of items of one length that a text may hold: group, the text's shingles, places of hits."""
        for size, (key, group, item, sieve) in self.keys.items():
            if len(words) < size:
                continue
            own = shingles(words, size)
            place = np.flatnonzero(sieve[(own & np.uint64((1 << 20) - 1)).astype(np.int64)])
            low, high = np.searchsorted(key, own[place], "left"), np.searchsorted(key, own[place], "right")
            place, low, n = place[high > low], low[high > low], (high - low)[high > low]
            if not len(place):
                continue
            entry = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            place = np.repeat(place, n)
            for g in np.unique(group[entry]):
                mine = group[entry] == g
                enough = np.bincount(item[entry[mine]]) >= self.sized[g].least
                if enough.any():
                    yield int(g), own, np.unique(place[mine][enough[item[entry[mine]]]])

    def find(self, words: np.ndarray) -> list[tuple[int | None, int, int, float, int]]:
        """(item_id, start, words, similarity, distance): the best window of every item that a text holds."""
        best: dict[tuple[int, int], tuple] = {}
        for g, own, place in self.hits(words):
            sized = self.sized[g]
            span = min(sized.length, len(words)) - sized.size + 1
            # all windows that hold a hit
            near = np.zeros(len(own) + 1, dtype=np.int64)
            np.add.at(near, np.maximum(place - span + 1, 0), 1)
            np.add.at(near, place + 1, -1)
            starts = np.flatnonzero(np.cumsum(near[:-1]) > 0)
            starts = starts[starts <= len(own) - span]
            for part in (starts[i : i + WINDOWS] for i in range(0, len(starts), WINDOWS)):
                first = int(part[0])
                sums = np.concatenate([np.zeros((1, 64), dtype=np.int32), np.cumsum(signs(own[first : int(part[-1]) + span]), axis=0, dtype=np.int32)])
                for window, i, distance in sized.within(fingerprints(sums[part - first + span] - sums[part - first])):
                    start = int(part[window])
                    common, all_ = similarity(Counter(own[start : start + span].tolist()), sized.counts[i])
                    if 100 * common >= PERCENT * all_:
                        rank = (-common / all_, start, distance)
                        best[g, i] = min(best.get((g, i), rank), rank)
        return [
            (self.sized[g].items[i][0], start, min(self.sized[g].length, len(words)), -ratio, distance) for (g, i), (ratio, start, distance) in sorted(best.items())
        ]


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items that documents hold: doc_id, text_key, item_id, start_word, n_words, similarity, distance.

    One row for each row of the documents and each item with a window of the item's length (the whole text, if it is
    shorter) whose similarity over shingles of five words is at least 0.8; items of fewer words are one shingle. Words
    are split at ASCII white space and compared in lower case for A-Z. The best window is named, the first of equals.
    Null and blank texts hold nothing, null and blank items are held by nothing; repeated items and rows are reported
    each; further columns are ignored.

    A benchmark beyond BLOCK_BYTES is taken in blocks, with a pass over the documents for each; no pass compares
    documents with each other or shuffles them.
    """
    spark = documents.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")

    def search(block: list[tuple[int | None, bytes]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, table = Index(block), WordHashes()
            for batch in pieces(batches):
                out: list[list] = [[] for _ in range(7)]
                columns = (batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), texts(batch))
                for doc_id, key, text in zip(*columns, strict=True):
                    for found in index.find(hashed(split_words(text), table)):
                        for column, value in zip(out, (doc_id, key, *found), strict=True):
                            column.append(value)
                kinds = [pa.int64()] * 5 + [pa.float64(), pa.int32()]
                names = ["doc_id", "text_key", "item_id", "start_word", "n_words", "similarity", "distance"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

        return run

    found = None
    for block in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        part = rows.mapInArrow(search([(r["item_id"], bytes(r["text"])) for r in chosen]), _FOUND)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], _FOUND)


def without_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    bad = leaks(documents, benchmark).select(F.col("doc_id").alias("_leak_id"), F.col("text_key").alias("_leak_key")).distinct()
    same = documents["doc_id"].cast("long").eqNullSafe(bad["_leak_id"]) & (F.xxhash64(documents["text"]) == bad["_leak_key"])
    return documents.join(bad, same, "left_anti").select(*documents.columns)
