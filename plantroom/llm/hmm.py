"""Language-model scoring: a hidden Markov model beside a unigram base.

The model emits symbols: the commonest words have one each, all others share a bounded number of buckets by their hash,
and within its bucket a word has the share its count gives it. So the parameters stay bounded while every count of the
corpus enters a score. Baum-Welch counts of every round come from every training document, cut into segments, and are
added up across partitions, until a round gains little; documents are scored whole, by the scaled forward recursion.

Counts of rare words and the documents that hold them meet in ranges of the words' hashes; common words, a bounded
list, travel with the tasks, so no range holds a word that stands in every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantroom.llm.shared import partitions, stored
from plantroom.llm.words import WordHashes, hashed, pieces, split_words, texts

#: Words whose counts travel with the tasks; of these, words with a symbol of their own; buckets of all other words.
COMMON, OWN, BUCKETS = 60_000, 2_000, 512
SYMBOLS = 1 + OWN + BUCKETS
STATES, SEGMENT = 6, 64
#: Rounds over the whole corpus end with one that gains less log10 likelihood a token.
GAIN = 1e-4
#: By how much steps beyond an estimate grow, and the largest.
STRETCH, MOST = 1.3, 4.0
SEED = 5
#: The token behind the last word; no word has this hash but by chance.
END = np.uint64(WordHashes()[b"\n"])
#: Hashes of words a task holds before it passes counts on.
HELD = 3_000_000


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def bucket(words: np.ndarray) -> np.ndarray:
    return ((words >> np.uint64(20)) % np.uint64(BUCKETS)).astype(np.int64)


def range_of(words: np.ndarray, ranges: int) -> np.ndarray:
    """Ranges by the upper bits: sorted words are sorted by range, too."""
    return ((words >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def tokens(batch: pa.RecordBatch, table: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each closed by the end token, and how many each text has."""
    found, sizes = [], []
    for text in texts(batch):
        words = split_words(text)
        found.append(np.append(hashed(words, table), END))
        sizes.append(len(words) + 1)
    return np.concatenate(found), np.array(sizes)


# --------------------------------------------------------------------------------------------------- word counts


def count_words(documents: DataFrame, ranges: int) -> dict:
    """Counts over all training documents: N, V, the commonest words with their counts, sums by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        keys, counts = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)

        def passed_on():
            at = np.searchsorted(range_of(keys, ranges), np.arange(ranges + 1))
            spans = [(r, at[r], at[r + 1]) for r in range(ranges) if at[r] < at[r + 1]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r for r, _, _ in spans], pa.int32()),
                    pa.array([keys[a:b].tobytes() for _, a, b in spans], pa.binary()),
                    pa.array([counts[a:b].tobytes() for _, a, b in spans], pa.binary()),
                ],
                names=["range", "keys", "counts"],
            )

        for batch in pieces(batches):
            words, _ = tokens(batch, table)
            own, n = np.unique(words, return_counts=True)
            keys, counts = _summed(np.concatenate([keys, own]), np.concatenate([counts, n]))
            if len(keys) > HELD:
                yield passed_on()
                keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield passed_on()

    often = 3 * COMMON // ranges + 30

    def add(group: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in group.column("keys").to_pylist()])
        counts = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in group.column("counts").to_pylist()])
        keys, counts = _summed(keys, counts)
        top = np.lexsort((keys, -counts))[:often]
        if END in keys:
            top = np.union1d(top, np.flatnonzero(keys == END))
        b = bucket(keys)
        types, total = np.bincount(b, minlength=BUCKETS), np.bincount(b, weights=counts, minlength=BUCKETS)
        none = pa.nulls(BUCKETS, pa.int64())
        return pa.table(
            {
                "bucket": pa.concat_arrays([pa.array(np.arange(BUCKETS), pa.int64()), pa.nulls(len(top), pa.int64())]),
                "types": pa.concat_arrays([pa.array(types, pa.int64()), pa.nulls(len(top), pa.int64())]),
                "word": pa.concat_arrays([none, pa.array(keys[top].view(np.int64))]),
                "n": pa.concat_arrays([pa.array(total.astype(np.int64)), pa.array(counts[top])]),
            }
        )

    learned = documents.where(~held_out(F.col("doc_id"))).select("text")
    found = learned.mapInArrow(count, "range int, keys binary, counts binary").groupBy("range")
    table = stored(found.applyInArrow(add, "bucket long, types long, word long, n long"), "words")
    by_bucket = table.where("bucket is not null").groupBy("bucket").agg(F.sum("types").alias("types"), F.sum("n").alias("n")).collect()
    types, total = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for r in by_bucket:
        types[r["bucket"]], total[r["bucket"]] = r["types"], r["n"]
    words = table.where("word is not null")
    top = words.where(F.col("word") != int(END.view(np.int64))).orderBy(F.desc("n"), "word").limit(COMMON).collect()
    end = words.where(F.col("word") == int(END.view(np.int64))).agg(F.sum("n")).first()[0] or 0
    keys = np.array([END.view(np.int64)] + [r["word"] for r in top], dtype=np.int64).view(np.uint64)
    counts = np.array([end] + [r["n"] for r in top], dtype=np.int64)
    # words with a symbol of their own, the end token first, leave their buckets
    own = min(1 + OWN, len(keys))
    np.subtract.at(total, bucket(keys[:own]), counts[:own])
    np.subtract.at(types, bucket(keys[:own]), (counts[:own] > 0).astype(np.int64))
    symbol = np.concatenate([np.arange(own), 1 + OWN + bucket(keys[own:])])
    order = np.argsort(keys)
    return {
        "documents": int(end), "N": int(counts[:own].sum() + total.sum()), "V": int((counts[:own] > 0).sum() + types.sum()),
        "words": keys[order], "counts": counts[order], "symbols": symbol[order].astype(np.uint16),
        "bucket_norm": np.log10(total + types + 1.0), "unigram": np.concatenate([counts[:own], np.zeros(1 + OWN - own), total]) + 1.0,
    }


# --------------------------------------------------------------------------------------------------- encoded corpus

_ENCODED = (
    "part int, piece long, row long, doc_id long, held_out boolean, n_tokens long, known long, base double, emitted double, symbols binary, "
    "range int, words binary, places binary, times binary"
)


def encode(documents: DataFrame, vocabulary: dict, ranges: int) -> DataFrame:
    """One table of two kinds of rows: documents as symbols (part 0), and rare words with their documents (part 1)."""
    common, counts, symbols = vocabulary["words"], vocabulary["counts"], vocabulary["symbols"]
    norm = vocabulary["bucket_norm"]
    schema = pa.schema(
        [("part", pa.int32()), ("piece", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
         ("known", pa.int64()), ("base", pa.float64()), ("emitted", pa.float64()), ("symbols", pa.binary()), ("range", pa.int32()),
         ("words", pa.binary()), ("places", pa.binary()), ("times", pa.binary())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordHashes()
        for batch in pieces(batches):
            words, sizes = tokens(batch, table)
            n, document = len(sizes), np.repeat(np.arange(len(sizes)), sizes)
            at = np.minimum(np.searchsorted(common, words), len(common) - 1)
            is_common = common[at] == words
            symbol = np.where(is_common, symbols[at], 1 + OWN + bucket(words)).astype(np.uint16)
            logs = np.where(is_common, np.log10(counts[at] + 1.0), 0.0)
            shared = symbol > OWN
            base = np.bincount(document, weights=logs, minlength=n)
            within = np.where(shared, logs - norm[np.maximum(symbol.astype(np.int64) - 1 - OWN, 0)], 0.0)
            emitted = np.bincount(document, weights=within, minlength=n)
            known = np.bincount(document, weights=is_common & (counts[at] > 0), minlength=n).astype(np.int64)
            ends = np.cumsum(sizes)
            blobs = [symbol[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)]
            piece = batch.column("row")[0].as_py()
            none = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, dtype=np.int32)), pa.array(np.full(n, piece)), batch.column("row"), batch.column("doc_id"), batch.column("held_out"),
                 pa.array(sizes.astype(np.int64)), pa.array(known), pa.array(base), pa.array(emitted), pa.array(blobs, pa.binary()),
                 pa.nulls(n, pa.int32()), none, none, none],
                schema=schema,
            )
            rare, place = words[~is_common], document[~is_common]
            order = np.lexsort((place, rare))
            rare, place = rare[order], place[order]
            first = np.flatnonzero(np.r_[True, (rare[1:] != rare[:-1]) | (place[1:] != place[:-1])]) if len(rare) else np.empty(0, dtype=np.int64)
            times = np.diff(np.r_[first, len(rare)]).astype(np.int32)
            rare, place = rare[first], place[first]
            learned = ~np.asarray(batch.column("held_out").to_numpy(zero_copy_only=False), dtype=bool)
            # the sign of `times` says whether the document is one to learn from
            times = np.where(learned[place], times, -times).astype(np.int32)
            cut = np.searchsorted(range_of(rare, ranges), np.arange(ranges + 1))
            spans = [(r, cut[r], cut[r + 1]) for r in range(ranges) if cut[r] < cut[r + 1]]
            if spans:
                n = len(spans)
                blank = [pa.nulls(n, f.type) for f in schema]
                blank[0], blank[1], blank[10] = pa.array([1] * n, pa.int32()), pa.array([piece] * n, pa.int64()), pa.array([s[0] for s in spans], pa.int32())
                for column, values in ((11, rare), (12, place.astype(np.int32)), (13, times)):
                    blank[column] = pa.array([values[a:b].tobytes() for _, a, b in spans], pa.binary())
                yield pa.RecordBatch.from_arrays(blank, schema=schema)

    numbered = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    return stored(numbered.mapInArrow(rows, _ENCODED), "encoded", partition_by="part")


def rare_scores(encoded: DataFrame) -> DataFrame:
    """Sum of log10(c + 1) and number of known tokens over the rare words of each document: row, rare, rare_known."""

    def meet(group: pa.Table) -> pa.Table:
        owner = group.column("piece").to_numpy()
        words, places, times = (
            [np.frombuffer(x, dtype=t) for x in group.column(c).to_pylist()] for c, t in (("words", np.uint64), ("places", np.int32), ("times", np.int32))
        )
        key = np.concatenate(words)
        time = np.concatenate(times).astype(np.int64)
        order = np.argsort(key, kind="stable")
        first = np.r_[True, key[order][1:] != key[order][:-1]]
        number = np.empty(len(key), dtype=np.int64)
        number[order] = np.cumsum(first) - 1
        count = np.bincount(number, weights=np.maximum(time, 0))[number]
        logs, known = np.abs(time) * np.log10(count + 1.0), np.abs(time) * (count > 0)
        out, start = [], 0
        for piece, place in zip(owner, places, strict=True):
            stop = start + len(place)
            used, at = np.unique(place, return_inverse=True)
            sums = np.bincount(at, weights=logs[start:stop])
            hits = np.bincount(at, weights=known[start:stop])
            out.append((piece, used.astype(np.int32).tobytes(), sums.tobytes(), hits.astype(np.int32).tobytes()))
            start = stop
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                        names=["piece", "places", "sums", "hits"])

    def add(group: pa.Table) -> pa.Table:
        places, sums, hits = (
            np.concatenate([np.frombuffer(x, dtype=t) for x in group.column(c).to_pylist()]) for c, t in (("places", np.int32), ("sums", np.float64), ("hits", np.int32))
        )
        used, at = np.unique(places, return_inverse=True)
        # added in one order, whichever range came first
        order = np.lexsort((sums, at))
        piece = group.column("piece")[0].as_py()
        return pa.table(
            {
                "row": pa.array(used.astype(np.int64) + piece),
                "rare": np.bincount(at[order], weights=sums[order]),
                "rare_known": np.bincount(at, weights=hits).astype(np.int64),
            }
        )

    rare = encoded.where("part = 1").select("range", "piece", "words", "places", "times")
    met = rare.groupBy("range").applyInArrow(meet, "piece long, places binary, sums binary, hits binary")
    return met.groupBy("piece").applyInArrow(add, "row long, rare double, rare_known long")


# --------------------------------------------------------------------------------------------------- the model


def _in_time(symbols: list[np.ndarray]):
    """Sequences in order of falling length, flat, with offsets, and how many are still running at each time."""
    sizes = np.array([len(s) for s in symbols])
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate([symbols[i] for i in order]).astype(np.int64)
    sizes = sizes[order]
    running = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), "right")
    return order, flat, np.cumsum(sizes) - sizes, running


def forward(symbols: list[np.ndarray], model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 likelihood of each sequence by the scaled forward recursion; all sequences advance together."""
    start, move, emit = model
    by_symbol = np.ascontiguousarray(emit.T)
    order, flat, offsets, running = _in_time(symbols)
    total = np.zeros(len(symbols))
    state = np.empty(0)
    for t, n in enumerate(running):
        state = (state[:n] @ move if t else np.broadcast_to(start, (n, len(start)))) * by_symbol[flat[offsets[:n] + t]]
        scale = state.sum(axis=1)
        state /= scale[:, None]
        total[:n] += np.log10(scale)
    out = np.empty(len(symbols))
    out[order] = total
    return out


def expected_counts(segments: list[np.ndarray], model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch: expected starts, moves and emissions of the segments, each a sequence of its own."""
    return rated_counts(segments, model)[:3]


def rated_counts(segments: list[np.ndarray], model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts, and the log10 likelihood of the segments by the model with their number of tokens."""
    # single precision within a segment, whose states are scaled at every step; sums in double precision
    start, move, emit = (x.astype(np.float32) for x in model)
    _, flat, offsets, running = _in_time(segments)
    # a row for each state: steps over all segments are steps along memory
    onward = np.ascontiguousarray(move.T)
    states, scales, seen, odds = [], [], [], []
    for t, n in enumerate(running):
        seen.append(flat[offsets[:n] + t])
        odds.append(emit.take(seen[-1], axis=1))
        state = odds[-1] * (onward @ states[-1][:, :n] if t else start[:, None])
        scales.append(state.sum(axis=0))
        state /= scales[-1]
        states.append(state)
    moves = np.zeros(move.shape)
    after = np.ones_like(states[-1])
    for t in range(len(running) - 1, -1, -1):
        n = running[t]
        if t + 1 < len(running):
            m = running[t + 1]
            ahead = odds[t + 1]
            ahead *= after
            ahead /= scales[t + 1]
            moves += states[t][:, :m] @ ahead.T
            after = np.ones((len(start), n), dtype=np.float32)
            np.matmul(move, ahead, out=after[:, :m])
        states[t] *= after
    every = np.concatenate(seen)
    emitted = np.stack([np.bincount(every, weights=w, minlength=emit.shape[1]) for w in np.concatenate(states, axis=1)])
    rated = np.array([float(np.log10(np.concatenate(scales), dtype=np.float64).sum()), float(len(flat))])
    return states[0].sum(axis=1, dtype=np.float64), moves * model[1], emitted, rated


def estimated(counts: tuple[np.ndarray, np.ndarray, np.ndarray], unigram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities from counts; every symbol keeps a share in every state."""
    start, move, emit = counts
    prior = unigram / unigram.sum()
    emit = emit + 0.01 * emit.sum(axis=1, keepdims=True) * prior + 1e-3 * prior
    return (start + 1e-3) / (start + 1e-3).sum(), (move + 1e-3) / (move + 1e-3).sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True)


def segments_of(symbols: np.ndarray) -> list[np.ndarray]:
    return [symbols[i : i + SEGMENT] for i in range(0, len(symbols), SEGMENT)]


def _starting_model(unigram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    noise = np.random.default_rng(SEED)
    emit = unigram / unigram.sum() * noise.gamma(1.0, 1.0, (STATES, len(unigram)))
    move = np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES)
    return np.full(STATES, 1.0 / STATES), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True)


def _stretched(old: np.ndarray, new: np.ndarray, step: float) -> np.ndarray:
    """Further from the old probabilities than the new ones, in the same direction, by logarithms."""
    far = new * (new / old) ** (step - 1.0)
    return far / far.sum(axis=-1, keepdims=True)


def train(encoded: DataFrame, unigram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch over all training documents, from a random model until a round gains less than GAIN a token.

    Every round counts every segment of every training document. After a round that gained, the next model lies beyond
    its estimate, by a step that grows; a round that shows the likelihood to have fallen goes back to that estimate, and
    the steps begin anew. It ends: likelihoods do not exceed 1, and plain estimates never fall.
    """
    learned = encoded.where("part = 0 and not held_out").select("symbols")
    model, reached = _starting_model(unigram), -np.inf
    estimate, step = model, 1.0
    shapes = [(STATES,), (STATES, STATES), (STATES, len(unigram)), (2,)]

    def unpacked(blob: bytes) -> list[np.ndarray]:
        flat, out = np.frombuffer(blob, dtype=np.float64), []
        for shape in shapes:
            size = int(np.prod(shape))
            out.append(flat[:size].reshape(shape))
            flat = flat[size:]
        return out

    while True:

        def count(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros(s) for s in shapes]
            waiting: list[np.ndarray] = []
            held = 0

            def flush():
                for total, more in zip(sums, rated_counts(waiting, model), strict=True):
                    total += more
                waiting.clear()

            for batch in batches:
                for blob in batch.column(0).to_pylist():
                    new = segments_of(np.frombuffer(blob, dtype=np.uint16))
                    waiting += new
                    held += len(new)
                    if len(waiting) >= 4096:
                        flush()
            if waiting:
                flush()
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([held % 16], pa.int32()), pa.array([np.concatenate([s.ravel() for s in sums]).tobytes()])], names=["slot", "counts"])

        def add(group: pa.Table) -> pa.Table:
            total = 0.0
            for blob in sorted(group.column("counts").to_pylist()):
                total = total + np.frombuffer(blob, dtype=np.float64)
            return pa.table({"counts": [total.tobytes()]})

        # counts of tasks meet in 16 sums, so the driver gets 16 rows however many tasks there are
        parts = learned.mapInArrow(count, "slot int, counts binary").groupBy("slot").applyInArrow(add, "counts binary").collect()
        if not parts:
            return model
        *total, rated = [sum(x) for x in zip(*(unpacked(b) for b in sorted(bytes(r["counts"]) for r in parts)), strict=True)]
        likelihood = rated[0] / rated[1]
        if likelihood < reached and step > 1.0:
            model, step = estimate, 1.0
            continue
        estimate = estimated(tuple(total), unigram)
        if likelihood - reached < GAIN:
            return estimate
        step, reached = min(STRETCH * step, MOST), likelihood
        model = tuple(_stretched(old, new, step) for old, new in zip(model, estimate, strict=True))


def scored(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10) of every document.

    Null texts count as empty: the end token alone. One row for each row of the input; a null doc_id is a document to
    learn from; further columns are ignored. Without any document to learn from, every base score is 0.
    """
    spark = documents.sparkSession
    ranges = 4 * partitions(spark)
    vocabulary = count_words(documents, ranges)
    encoded = encode(documents, vocabulary, ranges)
    model = train(encoded, vocabulary["unigram"])
    all_tokens, floor = vocabulary["N"], np.log10(vocabulary["N"] + vocabulary["V"] + 1.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = forward([np.frombuffer(x, dtype=np.uint16) for x in batch.column("symbols").to_pylist()], model)
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found)], names=["row", "hidden"])

    whole = encoded.where("part = 0")
    hidden = whole.select("row", "symbols").mapInArrow(score, "row long, hidden double")
    plain = whole.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "emitted")
    rare = F.coalesce("rare", F.lit(0.0))
    return (
        plain.join(hidden, "row")
        .join(rare_scores(encoded), "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
            F.lit(all_tokens).cast("long").alias("train_tokens"),
            (F.col("base") + rare - F.col("n_tokens") * F.lit(float(floor))).alias("base_score"),
            (F.col("hidden") + F.col("emitted") + rare).alias("score"),
        )
    )
