"""Toxicity by multiple-instance learning.

Only whole documents have labels. A document is taken as a bag of sentences: each sentence gets a probability from a
linear model over its words and word beginnings, and the document's is the noisy-or, 1 - (1 - p1)(1 - p2)... The model
is fitted to document labels through that rule, so the weight falls on the sentences that explain a label, and the
sentences above one half are the ones to point at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantroom.llm.shared import sampled, stored
from plantroom.llm.words import pieces

#: Labelled documents the model is fitted to, at most so many of each label: those of the smallest hashes of their ids.
SAMPLE = 3000
#: A feature is a word or its first letters, hashed to so many weights.
WEIGHTS = 1 << 20
BEGINNINGS = (3, 4, 5)
EPOCHS, RATE, DECAY = 160, 0.3, 1e-3
#: How much commoner a feature is in toxic documents; the bias of a sentence at most.
LIFT, BIAS = 3.0, -12.0
#: Words remembered by a task.
REMEMBERED = 300_000

_SENTENCE = re.compile(rb"[.!?\n]+")
_WORD = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def features(word: bytes) -> set[int]:
    """Weights that a word in lower case uses: its own, and those of its first letters."""
    keys = {b"=" + word}
    letters = word.decode("utf-8", "replace")
    keys.update(b"%d^%s" % (n, letters[:n].encode()) for n in BEGINNINGS if len(letters) > n)
    return {xxhash.xxh3_64_intdigest(k) % WEIGHTS for k in keys}


def sentences(text: bytes | None) -> list[bytes]:
    """Sentences with a word in them."""
    return [s for s in _SENTENCE.split(text or b"") if _WORD.search(s)]


def lowered(batch: pa.RecordBatch) -> list[bytes | None]:
    return pc.utf8_lower(batch.column("text")).cast(pa.binary()).to_pylist()


class WordWeights(dict):
    """A word's share of its sentence's log-odds, computed once while it is remembered."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) > REMEMBERED:
            self.clear()
        value = float(sum(self.weights[f] for f in sorted(features(word))))
        self[word] = value
        return value


def sentence_odds(text: bytes | None, table: WordWeights, bias: float) -> list[float]:
    get = table.__getitem__
    return [bias + sum(map(get, set(_WORD.findall(s)))) for s in sentences(text)]


def noisy_or(odds: list[float]) -> float:
    """1 - product of (1 - p) over the sentences; a text without sentences scores 0."""
    if not odds:
        return 0.0
    return float(-np.expm1(-np.logaddexp(0.0, np.asarray(odds)).sum()))


def held_out(doc_id: Column) -> Column:
    """Every fifth document by a checksum of its id: never used to learn."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def learning_rows(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, list]:
    """The features that may get weights, and a bounded sample of labelled documents reduced to them.

    Up to `sample` documents of each label, by the smallest hashes of their ids; ids with contradicting labels, null
    ids and null labels are left out; of rows with one id the smallest text counts. A feature must stand in at least 3
    toxic documents of the sample, and there more than `LIFT` times as often as in the others: rarer ones could only
    remember single documents.
    """
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .where("toxic = most")
    )
    marked = stored(marked.select("doc_id", "toxic"), "marked")
    by_hash = [F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)), F.col("doc_id")]
    ids = {}
    for label, rows in marked.groupBy("toxic").count().collect():
        some = marked.where((F.col("toxic") == label) & sampled(rows, sample, "doc_id"))
        ids |= {r["doc_id"]: label for r in some.orderBy(*by_hash).limit(sample).collect()}
    if not ids:
        return np.empty(0, dtype=np.int64), []
    spark = documents.sparkSession
    wanted = F.broadcast(spark.createDataFrame(sorted(ids.items()), "doc_id long, toxic int"))  # 2 * sample rows at most
    rows = stored(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id")
        .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")),
        "labelled",
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            labels = np.asarray(batch.column("toxic"))
            found = [np.array(sorted(set().union(*map(features, set(_WORD.findall(t or b""))))), dtype=np.int64) for t in lowered(batch)]
            keys = np.concatenate([2 * f + label for f, label in zip(found, labels, strict=True)])
            values, counts = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values // 2), pa.array(values % 2), pa.array(counts)], names=["feature", "toxic", "n"])

    toxic_rows = max(1, sum(ids.values()))
    other_rows = max(1, len(ids) - sum(ids.values()))
    counts = rows.mapInArrow(count, "feature long, toxic long, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("other"),
    )
    lift = (F.col("toxic") + 0.5) / toxic_rows / ((F.col("other") + 0.5) / other_rows)
    used = counts.where((F.col("toxic") >= 3) & (lift > LIFT)).select("feature").collect()  # WEIGHTS numbers at most
    kept = np.array(sorted(r["feature"] for r in used), dtype=np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {int(f): i for i, f in enumerate(kept)}
        for batch in pieces(batches):
            bags = [_bag(text, number) for text in lowered(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array([n for n, _ in bags], pa.int32()), pa.array([b for _, b in bags], pa.binary())],
                names=["doc_id", "toxic", "n", "bag"],
            )

    return kept, sorted(rows.select("doc_id", "toxic", "text").mapInArrow(encode, "doc_id long, toxic int, n int, bag binary").collect())


def _bag(text: bytes | None, number: dict[int, int]) -> tuple[int, bytes]:
    """How many sentences a text has, and pairs (sentence, number of a kept feature), each once."""
    found = sentences(text)
    pairs = [(i, number[f]) for i, s in enumerate(found) for f in set().union(*map(features, set(_WORD.findall(s)))) if f in number]
    return len(found), np.array(sorted(pairs), dtype=np.int32).tobytes()


def fit(kept: np.ndarray, rows: list) -> tuple[np.ndarray, np.ndarray, float]:
    """Features, their weights and the bias that make the noisy-or of the sentences likely for the labels.

    Weights are not negative: a sentence is accused by what it holds. The bias is so low that thousands of sentences
    without any such word do not add up.
    """
    toxic = np.array([r["toxic"] for r in rows], dtype=np.float64)
    if not len(rows) or toxic.min() == toxic.max() or not len(kept):
        return kept, np.zeros(len(kept)), BIAS
    sizes = np.array([max(1, r["n"]) for r in rows])
    offsets = np.cumsum(sizes) - sizes
    bags = [np.frombuffer(r["bag"], dtype=np.int32).reshape(-1, 2) for r in rows]
    document = np.repeat(np.arange(len(rows)), sizes)
    line = np.concatenate([b[:, 0] + o for b, o in zip(bags, offsets, strict=True)])
    column = np.concatenate([b[:, 1] for b in bags])
    owner = document[line]
    once = np.unique(owner.astype(np.int64) * len(kept) + column)
    seen = np.stack([np.bincount(once[toxic[once // len(kept)] == label] % len(kept), minlength=len(kept)) for label in (0, 1)])
    share = (seen + 0.5) / np.array([[np.sum(toxic == 0) + 1.0], [np.sum(toxic == 1) + 1.0]])
    w, bias = 0.7 * np.log(share[1] / share[0]), BIAS
    balance = np.where(toxic == 1, np.clip(np.sum(toxic == 0) / np.sum(toxic == 1), 0.25, 4.0), 1.0)
    squares, bias_square = np.full(len(w), 1e-8), 1e-8
    for _ in range(EPOCHS):
        odds = bias + np.bincount(line, weights=w[column], minlength=len(document))
        total = np.bincount(document, weights=np.logaddexp(0.0, odds), minlength=len(rows))
        # slope of log(1 - exp(-total)) for toxic documents, of -total for the others
        pull = np.where(toxic == 1, 1.0 / np.expm1(np.clip(total, 1e-6, 50.0)), -1.0) * balance / len(rows)
        step = pull[document] / (1.0 + np.exp(-np.clip(odds, -40, 40)))
        slope = np.bincount(column, weights=step[line], minlength=len(w)) - DECAY * w / len(w)
        squares += slope * slope
        w = np.maximum(w + RATE * slope / np.sqrt(squares), 0.0)
        bias_square += step.sum() ** 2
        bias = min(BIAS, bias + RATE * step.sum() / np.sqrt(bias_square))
    return kept, w, float(bias)


Model = tuple[np.ndarray, np.ndarray, float]


def train(documents: DataFrame, labels: DataFrame) -> Model:
    return fit(*learning_rows(documents, labels))


def scored(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns but `text`, and the score under a name of its own, of every document; one pass without a shuffle.

    The score is 0 for null texts and texts without a word. One row for each row of the input; the model (the used
    weights only) travels with the tasks.
    """
    used, values, bias = model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(WEIGHTS)
        weights[used] = values
        table = WordWeights(weights)
        for batch in pieces(batches):
            found = [noisy_or(sentence_odds(text, table, bias)) for text in lowered(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())], names=[*batch.schema.names[:-1], name])

    kinds = documents.schema
    keys = [f.name for f in kinds if f.name != "text"]
    schema = ", ".join(f"`{k}` {kinds[k].dataType.simpleString()}" for k in keys) + f", `{name}` double"
    return documents.select(*keys, "text").mapInArrow(score, schema.removeprefix(", "))


def classified(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document: doc_id, held_out, score (0 to 1), predicted (1 from one half on)."""
    ids = documents.select("doc_id", "text")
    return scored(ids, train(ids, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def offending(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The sentences that explain a score: doc_id, sentence (from 0), p, text, for all with p of at least `least`."""
    used, values, bias = model
    limit = float(np.log(least / (1.0 - least)))

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(WEIGHTS)
        weights[used] = values
        table = WordWeights(weights)
        for batch in pieces(batches):
            out: list[list] = [[], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), lowered(batch), strict=True):
                for i, (s, odds) in enumerate(zip(sentences(text), sentence_odds(text, table, bias), strict=True)):
                    if odds >= limit:
                        for column, value in zip(out, (doc_id, i, 1.0 / (1.0 + np.exp(-odds)), s.decode("utf-8", "replace").strip()), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.float64(), pa.string()), strict=True)],
                names=["doc_id", "sentence", "p", "text"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(point, "doc_id long, sentence int, p double, text string")


def without_toxic(documents: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The documents whose score is below the limit, with all their columns."""
    scores = scored(documents.withColumn("_toxicity_text", F.col("text")), train(documents, labels), "_toxicity")
    names = documents.columns
    return scores.withColumnRenamed("_toxicity_text", "text").where(F.col("_toxicity") < limit).select(*[f"`{n}`" for n in names])
