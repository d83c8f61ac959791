"""Importance resampling toward a target: hashed n-gram gains and a Gumbel top-k draw.

Every text becomes runs of one to ``n`` consecutive words, each hashed into a bucket.  A bucket's
gain is the log ratio of its share among the target's features to its share among the corpus's,
add-one smoothed and rounded down to thousandths; a document's weight is the sum of the gains of
its features.  Adding Gumbel noise fixed by the identifier and keeping the highest scores draws
documents in proportion to their weights, without replacement.

Words never leave Arrow: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and
``dictionary_encode`` give each word an index; an index and its shifted neighbour make a pair whose
dictionary is the distinct bigrams, a bigram's index and the next word's the distinct trigrams.
Checksums are computed for distinct pairs only, from the checksums of their two parts (a CRC is
linear, so the left part is advanced by the right one's length); ``take`` brings the buckets' gains
back to the places, and a segment sum adds them up per document.

Counts are exact over all rows: a task adds up its buckets before anything is shuffled, and the
driver sees one row per bucket.  Ranks come from one range-partitioned sort of narrow rows: the
place inside a partition plus the sizes of the partitions before it, so no task holds all scores.

Defined cases: a null or empty text, or one without a word, has no features and weight 0; a null
identifier hashes as an empty one; ties in score go to the smaller identifier, a null one last, and
repeated rows are separate candidates; an empty target leaves only the smoothing; an empty corpus
gives an empty result; very long texts are read whole; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autopulse.llm.common import map_batches, materialise, ranges, slices, text_buffer

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
MAX_RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = "42"
SLICE_BYTES = 1 << 20
_ROW_BITS = 33  # monotonically_increasing_id holds the partition above these bits


# --- checksums of joined strings ------------------------------------------------------------------

@lru_cache(maxsize=64)
def _advance_table(power: int) -> np.ndarray:
    """What 2^power zero bytes make of each byte of a CRC-32, by its place (4 x 256)."""
    if power:
        half = _advance_table(power - 1)
        return np.stack([_apply(half, row) for row in half])
    single = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
    bits = np.arange(256, dtype=np.uint32)
    return np.stack([single, bits, bits << 8, bits << 16])  # the low byte goes through, the others move down


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]


def joined_crc(left: np.ndarray, right: np.ndarray, right_size: np.ndarray) -> np.ndarray:
    """CRC-32 of left + right from the CRCs of both and the size of the right one."""
    out = left.copy()
    for power in range(int(right_size.max(initial=0)).bit_length()):
        at = np.flatnonzero((right_size >> power) & 1)
        out[at] = _apply(_advance_table(power), out[at])
    return out ^ right


# --- features of one slice ------------------------------------------------------------------------

class Features:
    """The n-grams of a column of texts: per run length, distinct checksums and each place's index into them."""

    def __init__(self, texts: pa.Array, max_run: int = MAX_RUN) -> None:
        # texts are cut at blanks first, and a batch's distinct pieces into words: far fewer
        pieces = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        piece = pc.list_flatten(pieces).dictionary_encode()
        words = pc.split_pattern_regex(pc.ascii_lower(piece.dictionary), SEPARATORS)
        owner, flat = pc.list_parent_indices(words), pc.list_flatten(words)
        real = pc.not_equal(pc.binary_length(flat), 0)
        coded = flat.filter(real).dictionary_encode()
        sizes = np.bincount(owner.filter(real).to_numpy(), minlength=len(words))
        place = piece.indices.to_numpy()
        at = ranges((np.cumsum(sizes) - sizes)[place], sizes[place])
        codes = coded.indices.to_numpy().astype(np.int64)[at]
        doc = np.repeat(pc.list_parent_indices(pieces).to_numpy(), sizes[place])
        data, ends = text_buffer(coded.dictionary)
        spelled = data.tobytes()
        crc = np.array([zlib.crc32(spelled[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())], np.uint32)
        size = np.diff(ends) + 1
        after_blank = joined_crc(np.full(len(crc), zlib.crc32(b" "), np.uint32), crc, size - 1)
        self.n_words = np.bincount(doc, minlength=len(texts))
        self.runs = [(crc, codes, doc)]
        index = codes  # the run that begins at each place, as an index into `crc`
        for n in range(2, max_run + 1):
            whole = doc[n - 1:] == doc[: len(doc) - n + 1]
            first, last = index[: len(whole)][whole], codes[n - 1:][whole]
            pairs, places = np.unique(first * max(len(size), 1) + last, return_inverse=True)
            left, right = np.divmod(pairs, max(len(size), 1))
            crc = joined_crc(crc[left], after_blank[right], size[right])
            self.runs.append((crc, places, doc[: len(whole)][whole]))
            index = np.zeros(len(whole), np.int64)
            index[whole] = places

    @property
    def n_features(self) -> np.ndarray:
        n = np.zeros(len(self.n_words), np.int64)
        for _, _, doc in self.runs:
            n += np.bincount(doc, minlength=len(n))
        return n

    def counts(self, buckets: int) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for crc, places, _ in self.runs:
            times = np.bincount(places, minlength=len(crc))
            np.add.at(out, crc % np.uint32(buckets), times)
        return out

    def weights(self, gains: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.n_words), np.int64)
        for crc, places, doc in self.runs:
            if len(places):
                taken = pa.array(gains[crc % np.uint32(len(gains))]).take(pa.array(places)).to_numpy()
                first = np.flatnonzero(np.diff(doc, prepend=-1))
                out[doc[first]] += np.add.reduceat(taken, first)
        return out


# --- the operator ---------------------------------------------------------------------------------

def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, max_run: int = MAX_RUN) -> DataFrame:
    """``bucket, n``: features of all rows per bucket, added up in each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                total += Features(part.column("text"), max_run).counts(buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    parts = map_batches(texts.select(F.col(text_col).alias("text")), run, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, corpus_col: str = "text", target_col: str = "text",
                 buckets: int = BUCKETS, max_run: int = MAX_RUN) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the corpus."""
    both = (bucket_counts(corpus, corpus_col, buckets, max_run).withColumn("side", F.lit(0))
            .unionByName(bucket_counts(target, target_col, buckets, max_run).withColumn("side", F.lit(1))))
    n = np.zeros((2, buckets), np.int64)
    for r in both.collect():  # at most two rows per bucket
        n[r["side"], r["bucket"]] = r["n"]
    s_all, t_all = float(n[0].sum() + buckets), float(n[1].sum() + buckets)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in n.T.tolist()], np.int64)


def feature_weights(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
                    max_run: int = MAX_RUN) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # one integer per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                f = Features(part.column("text"), max_run)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(f.n_words), pa.array(f.n_features), pa.array(f.weights(shared.value))],
                    names=["doc_id", "n_words", "n_features", "weight"])

    return map_batches(rows, run, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel_noise(id_col: str = "doc_id", seed: str = SEED):
    """Thousandths of Gumbel noise, fixed by the identifier."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Add ``rank`` to ``scored`` (doc_id, n_words, score): 1, 2, ... for the drawn rows, null for the others."""
    scored = materialise(scored, "resample-scores")
    fit = F.col("n_words") >= min_words
    k = scored.where(fit).count() * percent // 100
    order = [fit.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    placed = (scored.withColumn("_row", F.monotonically_increasing_id())  # parts ties and lets equal rows spread
              .repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_place", F.monotonically_increasing_id()))
    placed = materialise(placed, "resample-order").withColumn("_part", F.shiftright("_place", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the sort
    parts = placed.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1) + 1
    # fit rows come first, so the first k places are the drawn ones
    return placed.join(F.broadcast(parts), "_part").withColumn("rank", F.when(rank <= k, rank)).select(*scored.columns, "rank")


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        target_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED,
                        buckets: int = BUCKETS, max_run: int = MAX_RUN) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for every row of ``docs``."""
    gains = bucket_gains(docs, target, text_col, target_col, buckets, max_run)
    weighed = feature_weights(docs, gains, id_col, text_col, max_run)
    return draw(weighed.withColumn("score", F.col("weight") + gumbel_noise("doc_id", seed)), percent, min_words)
