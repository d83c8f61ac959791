"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A text is the bag of its character n-grams (bytes of the lower-cased text, sizes 3 to 6) that do
not run over a word boundary; a boundary may stand at either end.  n-grams are hashed into
buckets, each with an embedding; the text's vector is the mean over its bag and a linear
softmax gives two class probabilities.  Embeddings and softmax are trained together with
Adagrad.  A misspelt word shares most of its n-grams with the word it came from.

Fitting uses a bounded sample (a documented parameter, ``Settings``): per class the rows with
the smallest id hashes among labelled rows that are not held out, texts up to ``max_bytes``.
One task fits the model to that sample; only the model reaches the driver.  Scoring covers every whole text: as the model is linear
after the mean, each bucket is one number, and a batch is scored with array operations in
slices of bounded size; the model broadcast has ``2 ** bits`` floats whatever the data.

Defined cases: a null or empty text, or one without any n-gram, scores by the bias alone;
with no labelled row of some class every score is the share of class 1 seen (0 without labels);
an id labelled more than once is toxic if any label says so; null labels are not used;
repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autopulse.llm.common import MIN_LONG, byte_keys, held_out, map_batches, slices, splitmix, text_buffer

SIZES = (3, 4, 5, 6)
KEYS = byte_keys(7)
MULTIPLIER = 0x9E3779B97F4A7C15


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Key of each byte and whether it is a word boundary: ASCII other than letters and digits."""
    boundary = np.array([not (chr(b).isalnum() or b >= 0x80) for b in range(256)])
    return np.where(boundary, np.uint64(0), KEYS), boundary


BYTE_KEY, BOUNDARY = _letters()


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    dim: int = 4
    toxic_rows: int = 1200
    clean_rows: int = 2800
    max_bytes: int = 16_384
    min_rows: int = 4
    epochs: int = 10
    batch: int = 64
    rate: float = 1.0
    gain: float = 100.0
    damp: float = 0.1
    shrink: float = 0.006
    seed: int = 11


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # per bucket: difference of the two logits
    bias: float
    bits: int


def _grams(data: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the bucket at each start, and whether the n-gram counts."""
    keys, edge = BYTE_KEY[data], np.concatenate(([0], np.cumsum(BOUNDARY[data])))
    shift = np.uint64(64 - bits)
    rolling = keys
    for n in range(2, max(SIZES) + 1):
        rolling = rolling[:-1] + keys[n - 1:] * np.uint64(pow(MULTIPLIER, n - 1, 1 << 64))
        if n in SIZES:
            count = len(rolling)
            inner = edge[n - 1: n - 1 + count] == edge[1: 1 + count]  # no boundary strictly inside
            yield (splitmix(rolling) >> shift).astype(np.int64), inner


def _framed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts with a space before and after each; the offsets of the framed texts."""
    column = pc.utf8_lower(pc.fill_null(column, ""))
    column = pc.binary_join_element_wise(" ", column, " ", "")
    return text_buffer(column)


def _documents(offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, starts, side="right") - 1


def score_column(column: pa.Array, model: Model) -> np.ndarray:
    """Probability of class 1 for each text of a column of bounded size."""
    data, offsets = _framed(column)
    total, count = np.zeros(len(column)), np.zeros(len(column))
    if len(data) >= max(SIZES):
        for bucket, inside in _grams(data, model.bits):
            value = np.concatenate(([0.0], np.cumsum(np.where(inside, model.weight[bucket], 0.0))))
            seen = np.concatenate(([0], np.cumsum(inside)))
            ends = np.minimum(offsets, len(bucket))  # n-grams over two texts have a boundary inside
            total += value[ends[1:]] - value[ends[:-1]]
            count += seen[ends[1:]] - seen[ends[:-1]]
    logit = model.bias + total / np.maximum(count, 1)
    return 1.0 / (1.0 + np.exp(-np.clip(logit, -60, 60)))


def _bags(texts: pa.Array, bits: int, min_rows: int, step: int = 64) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse bags of a bounded sample: for each row its buckets and their shares of the row's n-grams.

    Rows are views into the arrays of ``step`` rows, which are thinned out one after another: the
    driver never holds a second copy of all bags.
    """
    size = 1 << bits
    parts, seen = [], np.zeros(size, np.int64)
    for lo in range(0, len(texts), step):
        data, offsets = _framed(texts.slice(lo, step))
        keys = [np.zeros(0, np.int64)]
        if len(data) >= max(SIZES):
            for bucket, inside in _grams(data, bits):
                at = np.flatnonzero(inside)
                keys.append(_documents(offsets, at) << bits | bucket[at])
        key, times = np.unique(np.concatenate(keys), return_counts=True)
        row, bucket = key >> bits, key & (size - 1)
        total = np.bincount(row, times, minlength=step)
        seen += np.bincount(bucket, minlength=size)
        starts = np.searchsorted(row, np.arange(min(step, len(texts) - lo) + 1))
        parts.append((starts, bucket.astype(np.int32), (times / total[row]).astype(np.float32)))
    often = seen >= min_rows  # what only a text or two have teaches nothing
    bags = []
    for i, (starts, bucket, share) in enumerate(parts):
        parts[i], stays = None, often[bucket]
        starts = np.concatenate(([0], np.cumsum(stays)))[starts]
        bucket, share = bucket[stays], share[stays]
        bags += [(bucket[a:b], share[a:b]) for a, b in zip(starts[:-1], starts[1:])]
    return bags


def fit(texts: pa.Array, labels: np.ndarray, settings: Settings = Settings()) -> Model:
    """Train embeddings and softmax jointly; deterministic for a given sample order."""
    size = 1 << settings.bits
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.0
        return Model(np.zeros(size, np.float32), 60.0 if share == 1 else -60.0, settings.bits)
    rng = np.random.default_rng(settings.seed)
    bags = _bags(texts, settings.bits, settings.min_rows)
    emb = rng.normal(0, 0.01, (size, settings.dim))
    soft = rng.normal(0, settings.dim ** -0.5, (settings.dim, 2))
    bias = np.log(np.array([1 - labels.mean(), labels.mean()]))
    g_emb, g_soft = np.full((size, settings.dim), settings.damp), np.full((settings.dim, 2), 0.01)
    target = np.eye(2)[labels.astype(int)]
    steps, step = settings.epochs * -(-len(labels) // settings.batch), 0
    for _ in range(settings.epochs):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), settings.batch):
            docs = order[lo: lo + settings.batch]
            rate = settings.rate * (1 - step / steps)
            step += 1
            sizes = [len(bags[d][0]) for d in docs]
            share = np.concatenate([bags[d][1] for d in docs]) * settings.gain
            local = np.repeat(np.arange(len(docs)), sizes)
            used, where = np.unique(np.concatenate([bags[d][0] for d in docs]), return_inverse=True)
            part = share[:, None] * emb[used][where]
            mean = np.stack([np.bincount(local, part[:, j], len(docs)) for j in range(settings.dim)], axis=1)
            logit = mean @ soft + bias
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            err = p / p.sum(axis=1, keepdims=True) - target[docs]
            back = (err @ soft.T)[local] * share[:, None]
            d_emb = np.stack([np.bincount(where, back[:, j], len(used)) for j in range(settings.dim)], axis=1)
            g_emb[used] += d_emb ** 2
            pace = rate / np.sqrt(g_emb[used])
            moved = emb[used] - pace * d_emb
            # group shrinkage: an n-gram seen in a few texts by chance goes back to zero
            norm = np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)
            emb[used] = moved * np.maximum(0, 1 - settings.shrink * pace.mean(axis=1, keepdims=True) / norm)
            d_soft = mean.T @ err
            g_soft += d_soft ** 2
            soft -= 0.1 * rate * d_soft / np.sqrt(g_soft)
    weight = settings.gain * (emb @ (soft[:, 1] - soft[:, 0]))
    return Model(weight.astype(np.float32), float(bias[1] - bias[0]), settings.bits)


def training_sample(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic", fold: int = 5, out: int = 0) -> DataFrame:
    """``doc_id, text, label`` of at most ``toxic_rows + clean_rows`` labelled rows outside the held-out fold, fixed by the id's hash.

    Of each class the rows with the smallest hashes are chosen.  Hashes are spread evenly, so a
    bound on the hash leaves little more than the wanted rows to sort, however many are labelled;
    should it leave fewer, all rows are sorted.  Labels are chosen first, so the join with the
    texts has a broadcast side of the sample's size.  Labels other than 0 and 1 teach nothing; of
    an id's different labels the largest counts, of its different texts the smallest.
    """
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col, fold, out))
             .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label_col)).cast("int").alias("label"))
             .where("label IN (0, 1)").withColumn("hash", F.xxhash64("doc_id")))
    found = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows at most
    chosen = []
    for label, rows in ((1, settings.toxic_rows), (0, settings.clean_rows)):
        part = known.where(F.col("label") == label)
        share = (rows + 10 * math.sqrt(rows) + 100) / max(1, found.get(label, 0))
        if share < 1:
            near = part.where(F.col("hash") < MIN_LONG + int(share * 2.0 ** 64))
            part = near if near.count() >= rows else part
        chosen.append(part.orderBy("hash", "doc_id").limit(rows).select("doc_id", "label"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(
        F.octet_length(text_col) <= settings.max_bytes)
    rows = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), **columns) -> Model:
    """The model of the sample: a single task takes the sample's rows and fits, the driver gets the weights alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        sample = pa.Table.from_batches(parts).sort_by("doc_id").combine_chunks()
        model = fit(sample.column("text").chunk(0), sample.column("label").to_numpy().astype(np.int64), settings)
        yield pa.RecordBatch.from_arrays([pa.array([model.weight.tobytes()], pa.binary()), pa.array([model.bias])],
                                         names=["weight", "bias"])

    sample = training_sample(docs, labels, settings, **columns)
    fitted = map_batches(sample.repartition(1), run, "weight binary, bias double").collect()  # a row at most
    if not fitted:
        return fit(pa.array([], pa.string()), np.zeros(0, np.int64), settings)
    return Model(np.frombuffer(fitted[0]["weight"], np.float32), fitted[0]["bias"], settings.bits)


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(score_column(part.column("text"), shared.value))],
                    names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with all their columns and without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(score_column(part.column(text_col), shared.value) < limit))

    return map_batches(docs, run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    scored = score_texts(docs, train(docs, labels, settings))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
