"""Words of texts as hashes, for tasks that work on arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that a task turns into arrays at a time (a single longer text is one piece).
PIECE_BYTES = 4 << 20
#: Words a task remembers; beyond, it starts anew.
REMEMBERED = 400_000


class WordHashes(dict):
    """64-bit hashes of words, each computed once while it is remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value


def split_words(text: bytes | None) -> list[bytes]:
    """Runs without ASCII white space, A-Z in lower case; nothing else is changed."""
    return text.lower().split() if text else []


def hashed(words: list[bytes], table: WordHashes) -> np.ndarray:
    return np.fromiter(map(table.__getitem__, words), dtype=np.uint64, count=len(words))


def pieces(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES, rows: int = 1 << 31
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of bounded text and number."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = min(start + rows, max(start + 1, int(np.searchsorted(ends, done + limit, "right"))))
            yield batch.slice(start, stop - start)
            start = stop


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)


def mixed_bits(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = (values ^ (values >> _S)) * _M1
    values = (values ^ (values >> _S)) * _M2
    return values ^ (values >> _S)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words in order; fewer words are one run, no words none."""
    if not len(words):
        return np.empty(0, dtype=np.uint64)
    n = max(1, len(words) - size + 1)
    out = np.full(n, np.uint64(min(size, len(words))), dtype=np.uint64)
    for k in range(min(size, len(words))):
        out = mixed_bits(out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n])
    return out
