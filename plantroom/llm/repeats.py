"""Passages that repeat across documents, by sparse suffix arrays.

Of all suffixes of a text, only those at content-selected places are kept: the least hash of 16 words in every window
of 35 places. Two texts that share 50 words select the same place inside them. The kept suffixes are sorted by their
first words, in ranges, and neighbours are compared. Where two are equal, the match is extended to the left and to the
right: the 50-word windows around the place are sorted and compared in the same way, and a run of windows that other
documents have, too, is one repeated passage, whatever its length.

What one task sees twice it passes on once, so a passage of every document is no hot group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantroom.llm.shared import partitions, stored
from plantroom.llm.words import WordHashes, hashed, mixed_bits, pieces, split_words, texts

#: Words of a match at least, and of a kept suffix's head.
LEAST, HEAD = 50, 16

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of `size` words, rolling; empty if there are fewer words."""
    n = len(words)
    if n < size:
        return np.empty(0, dtype=np.uint64)
    power = np.full(n + 1, np.uint64(_BASE))
    inverse = np.full(n, np.uint64(_INVERSE))
    power[0] = inverse[0] = 1
    power, inverse = np.cumprod(power, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * inverse, dtype=np.uint64)])
    return mixed_bits((sums[size:] - sums[:-size]) * power[: n - size + 1])


def kept_places(words: np.ndarray, least: int = LEAST, head: int = HEAD) -> tuple[np.ndarray, np.ndarray]:
    """Places of the kept suffixes and the hashes of their heads: the first least of each window of places."""
    heads = window_hashes(words, head)
    span = least - head + 1
    if len(heads) < span:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    chosen = np.lib.stride_tricks.sliding_window_view(heads, span).argmin(axis=1) + np.arange(len(heads) - span + 1)
    chosen = np.unique(chosen)
    return chosen, heads[chosen]


def _passed_on(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What to tell other tasks of the keys of a piece, and what is known here.

    Returns keys and entry numbers to send (as -1 - number for a key of several documents here), and for each entry
    whether another document here has its key, and whether an earlier one has.
    """
    order = np.lexsort((np.arange(len(keys)), keys))
    key, place = keys[order], places[order]
    new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.empty(0, dtype=bool)
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    several = np.maximum.reduceat(place, first) != np.minimum.reduceat(place, first) if len(key) else new
    here = several[group]
    later = here & (place != place[first][group])
    sent = new | ~here
    number = order[sent].astype(np.int64)
    known, after = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    known[order], after[order] = here, later
    return key[sent], np.where(here[sent], -1 - number, number), known, after


_SENT = [("range", pa.int32()), ("keys", pa.binary()), ("numbers", pa.binary())]


def _by_range(keys: np.ndarray, numbers: np.ndarray, ranges: int) -> list[tuple[int, bytes, bytes]]:
    """Sorted keys and their entry numbers, cut into ranges of the keys' upper bits."""
    cut = np.searchsorted((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32), np.arange(ranges + 1))
    return [(r, keys[a:b].tobytes(), numbers[a:b].astype(np.int32).tobytes()) for r, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if a < b]


def met(sent: DataFrame) -> DataFrame:
    """For each piece the entries that documents of other pieces have, too, or that several of its own have: piece,
    numbers (-1 - number for the first piece of all that have it)."""

    def neighbours(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("piece").to_numpy(), kind="stable")
        owner = group.column("piece").to_numpy()[order]
        blobs = [(group.column("keys")[int(i)].as_py(), group.column("numbers")[int(i)].as_py()) for i in order]
        key = np.concatenate([np.frombuffer(k, dtype=np.uint64) for k, _ in blobs])
        number = np.concatenate([np.frombuffer(n, dtype=np.int32) for _, n in blobs])
        piece = np.repeat(np.arange(len(blobs)), [len(k) // 8 for k, _ in blobs])
        place = np.argsort(key, kind="stable")
        key, number, piece = key[place], number[place], piece[place]
        new = np.r_[True, key[1:] != key[:-1]]
        first, which = np.flatnonzero(new), np.cumsum(new) - 1
        several = (np.maximum.reduceat(owner[piece], first) != np.minimum.reduceat(owner[piece], first)) | (np.minimum.reduceat(number, first) < 0)
        earliest = owner[piece] == owner[piece[first]][which]
        found = several[which]
        piece, earliest, number = piece[found], earliest[found], number[found]
        number = np.where(number < 0, -1 - number, number)
        number = np.where(earliest, -1 - number, number).astype(np.int32)
        by_piece = np.argsort(owner[piece], kind="stable")
        ids, starts = np.unique(owner[piece][by_piece], return_index=True)
        parts = np.split(number[by_piece], starts[1:])
        return pa.table({"piece": pa.array(ids, pa.int64()), "numbers": pa.array([p.tobytes() for p in parts][: len(ids)], pa.binary())})

    return sent.groupBy("range").applyInArrow(neighbours, "piece long, numbers binary")


def _answers(table: pa.Table, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries that others have, and those of them where an earlier piece has the key."""
    common, later = np.zeros(entries, dtype=bool), np.zeros(entries, dtype=bool)
    for blob in table.column("numbers").to_pylist():
        number = np.frombuffer(blob, dtype=np.int32)
        plain = np.where(number < 0, -1 - number, number)
        common[plain] = True
        later[plain] = number >= 0
    return common, later


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, dtype=np.uint8), count=n).astype(bool)


_DOCS = [("piece", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("at", pa.int64()), ("places", pa.binary()), ("known", pa.binary()), ("after", pa.binary())]
_SCHEMA = pa.schema([("part", pa.int32()), *_DOCS, *_SENT])
_DDL = "part int, piece long, doc_id long, text_key long, at long, places binary, known binary, after binary, range int, keys binary, numbers binary"


def _piece_rows(batch: pa.RecordBatch, found: list[tuple[np.ndarray, np.ndarray]], ranges: int) -> Iterator[pa.RecordBatch]:
    """Rows of a piece: its documents with the places of their keys (part 0), the keys to compare (part 1)."""
    sizes = np.array([len(p) for p, _ in found])
    if not sizes.sum():
        return
    keys, owner = np.concatenate([k for _, k in found]), np.repeat(np.arange(len(found)), sizes)
    sent, numbers, known, after = _passed_on(keys, owner)
    starts = np.cumsum(sizes) - sizes
    piece = batch.column("row")[0].as_py()
    used = np.flatnonzero(sizes)
    rows: list = [pa.nulls(len(used), f.type) for f in _SCHEMA]
    rows[0], rows[1] = pa.array([0] * len(used), pa.int32()), pa.array([piece] * len(used), pa.int64())
    rows[2], rows[3], rows[4] = batch.column("doc_id").take(pa.array(used)), batch.column("text_key").take(pa.array(used)), pa.array(starts[used], pa.int64())
    rows[5] = pa.array([found[i][0].astype(np.int32).tobytes() for i in used], pa.binary())
    for column, flags in ((6, known), (7, after)):
        rows[column] = pa.array([_bits(flags[starts[i] : starts[i] + sizes[i]]) for i in used], pa.binary())
    yield pa.RecordBatch.from_arrays(rows, schema=_SCHEMA)
    spans = _by_range(sent, numbers, ranges)
    rows = [pa.nulls(len(spans), f.type) for f in _SCHEMA]
    rows[0], rows[1] = pa.array([1] * len(spans), pa.int32()), pa.array([piece] * len(spans), pa.int64())
    for column, values, kind in zip((8, 9, 10), zip(*spans, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True):
        rows[column] = pa.array(values, kind)
    yield pa.RecordBatch.from_arrays(rows, schema=_SCHEMA)


def _numbered(documents: DataFrame, *more: str) -> DataFrame:
    return documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text_key", *more, "text")


def _decided(left: pa.Table, right: pa.Table) -> Iterator[tuple[int | None, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each document of a piece: id, text key, places, which of them others have, and which an earlier one has."""
    places = [np.frombuffer(x, dtype=np.int32) for x in left.column("places").to_pylist()]
    at = left.column("at").to_pylist()
    common, later = _answers(right, max((a + len(p) for a, p in zip(at, places, strict=True)), default=0))
    rows = (left.column(c).to_pylist() for c in ("doc_id", "text_key", "known", "after"))
    for doc_id, key, known, after, a, place in zip(*rows, at, places, strict=True):
        n = len(place)
        yield doc_id, key, place, _flags(known, n) | common[a : a + n], _flags(after, n) | later[a : a + n]


def kept_suffixes(documents: DataFrame, ranges: int) -> DataFrame:
    """doc_id, text_key and the places whose suffix begins like one of another document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in pieces(batches):
            yield from _piece_rows(batch, [kept_places(hashed(split_words(t), table)) for t in texts(batch)], ranges)

    def decide(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        for doc_id, key, place, common, _ in _decided(left, right):
            if common.any():
                for column, value in zip(out, (doc_id, key, place[common].tobytes()), strict=True):
                    column.append(value)
        return pa.table([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "text_key", "places"])

    table = stored(_numbered(documents).mapInArrow(rows, _DDL), "suffixes", partition_by="part")
    answers = met(table.where("part = 1").select("range", "piece", "keys", "numbers")).groupBy("piece")
    held = table.where("part = 0").groupBy("piece").cogroup(answers).applyInArrow(decide, "doc_id long, text_key long, places binary")
    return stored(held.dropDuplicates(["doc_id", "text_key"]), "repeated-suffixes")


def repeated_passages(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """Passages of at least `least` words that stand in several documents: doc_id, start_word, n_words, n_later.

    One row for each longest run of words all of whose windows of `least` words another row of the input holds, too;
    `n_later` of its words stand in a window that an earlier row of the table holds. Words are split at ASCII white
    space and compared in lower case for A-Z. Repeated rows repeat all their words; what repeats only within one text
    is not reported; null, blank and shorter texts have no passages. Further columns are ignored.
    """
    ranges = 4 * partitions(documents.sparkSession)
    keyed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    chosen = kept_suffixes(keyed, ranges).withColumnsRenamed({"doc_id": "_id", "text_key": "_key", "places": "kept"})
    same = keyed["doc_id"].eqNullSafe(chosen["_id"]) & (keyed["text_key"] == chosen["_key"])
    candidates = keyed.join(chosen, same).select("doc_id", "text_key", "kept", "text")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in pieces(batches):
            found = []
            for text, kept in zip(texts(batch), batch.column("kept").to_pylist(), strict=True):
                hashes = window_hashes(hashed(split_words(text), table), least)
                # left and right of every kept place: the windows that hold its head
                near = np.zeros(len(hashes) + 1, dtype=np.int64)
                place = np.frombuffer(kept, dtype=np.int32).astype(np.int64)
                np.add.at(near, np.clip(place + HEAD - least, 0, len(hashes)), 1)
                np.add.at(near, np.clip(place + 1, 0, len(hashes)), -1)
                starts = np.flatnonzero(np.cumsum(near[:-1]) > 0)
                found.append((starts, hashes[starts]))
            yield from _piece_rows(batch, found, ranges)

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list] = ([], [], [], [])
        for doc_id, _, start, common, later in _decided(left, right):
            shared, again = start[common], start[common & later]
            if not len(shared):
                continue
            first = np.flatnonzero(np.r_[True, shared[1:] > shared[:-1] + least])
            last = np.r_[first[1:], len(shared)] - 1
            covered = np.zeros(int(shared[-1]) + least + 1, dtype=np.int64)
            np.add.at(covered, again, 1)
            np.add.at(covered, again + least, -1)
            words = np.concatenate([[0], np.cumsum(np.cumsum(covered) > 0)])
            for a, b in zip(shared[first], shared[last] + least, strict=True):
                for column, value in zip(out, (doc_id, int(a), int(b - a), int(words[b] - words[a])), strict=True):
                    column.append(value)
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["doc_id", "start_word", "n_words", "n_later"])

    table = stored(_numbered(candidates, "kept").mapInArrow(windows, _DDL), "windows", partition_by="part")
    answers = met(table.where("part = 1").select("range", "piece", "keys", "numbers")).groupBy("piece")
    return table.where("part = 0").groupBy("piece").cogroup(answers).applyInArrow(extend, "doc_id long, start_word long, n_words long, n_later long")
