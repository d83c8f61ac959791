"""Benchmark decontamination: a BM25 index of test items, block-max WAND over every training passage.

Test items are the indexed documents, passages of training texts the queries.  A passage is a
window of twice the longest item's words, moved by half, so an item that stands in a text lies
whole in some passage.  A posting's impact is its BM25 share of the item's own full score, so a
passage that holds the whole item scores 1 and one threshold serves all items.

Each passage is first bounded by the sum of its terms' largest impacts (WAND's list bounds, in
array operations), then by the block maxima of every block of ``BOUND_ITEMS`` items (a product of
small matrices); only passages that could reach the threshold are evaluated, by block-max WAND over the sorted posting lists, which returns every item at or above it.  A retrieved item
counts when both its question and its answer overlap the passage: at least ``OVERLAP`` of each
part's word trigrams.  The question ends with the last question mark; an item without one is
halved.

Items are indexed in shards of about ``SHARD_BYTES`` of text, each built by the task that its items
are dealt to and written to the shared folder.  Shards travel in groups of at most ``GROUP_BYTES``:
a group is one broadcast and one scan of the documents, whose words are hashed once for all its
shards.  A larger benchmark means more groups, never a larger broadcast.  Document frequencies and
the average length are taken over all items.

A word is a run of letters and digits; in scripts without blanks (Chinese, Japanese, Thai, ...)
every character is one, and CJK punctuation parts words.  Items with fewer than ``MIN_WORDS`` words
have too few trigrams to score: they count wherever their words stand in a text in that order
(one hash of the whole item against that of every run of as many words), with score and overlaps 1
and ``passages`` the number of places.

Defined cases: items without a word (null and empty texts too) are not searched; equal items are
separate items with equal answers; a null or empty document has no passage; a very long text is
searched whole, in overlapping passages; repeated documents are all answered; an empty benchmark gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autopulse.llm.common import Powers, byte_keys, map_batches, materialise, slices, splitmix, text_buffer

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.7
GRAM = 3
MIN_WORDS = 5
BLOCK = 16
BOUND_ITEMS = 4
SHARD_BYTES = 64 << 10  # of item text: an index's table of block bounds stays within some megabytes
GROUP_BYTES = 64 << 20  # of indexes that one scan of the documents takes along
#: characters of scripts that part words by no blank: each is a word
SINGLE = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x2E80, 0x2FDF),
          (0x3040, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAA7F),
          (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF))
#: CJK and full-width punctuation, in no word
PARTING = ((0x3000, 0x303F), (0xFE30, 0xFE4F), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
QUESTION_MARKS = "?\uff1f"


def _class(ranges) -> str:
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


WORD = rf"{_class(SINGLE)}|[a-z0-9\x{{80}}-\x{{10FFFF}}&&[^{_class(SINGLE + PARTING)[1:-1]}]]+"

KEYS = byte_keys(31)
IN_WORD = np.array([(chr(b).isalnum() and b < 0x80) or b >= 0x80 for b in range(256)])
POWERS = Powers()


def _wide(data: np.ndarray, ranges) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the characters in ``ranges`` (all from U+0800 on) and the bytes' numbers in each."""
    at = np.flatnonzero(data >= 0xE0)
    size = np.where(data[at] >= 0xF0, 4, 3)
    b = [data[np.minimum(at + k, len(data) - 1)].astype(np.int64) & 0x3F for k in range(1, 4)]
    code = np.where(size == 4, (data[at].astype(np.int64) & 7) << 18 | b[0] << 12 | b[1] << 6 | b[2],
                    (data[at].astype(np.int64) & 15) << 12 | b[0] << 6 | b[1])
    hit = np.zeros(len(at), bool)
    for lo, hi in ranges:
        hit |= (code >= lo) & (code <= hi)
    return at[hit], size[hit]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a column's lower-cased texts, and the first word of each text."""
    if not len(column):
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    data, offsets = text_buffer(pc.utf8_lower(pc.fill_null(column, "")))
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    inside = IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    if (data >= 0xE0).any():
        at, size = _wide(data, SINGLE)
        edge[at] = edge[at + size] = True
        at, size = _wide(data, PARTING)
        for k in range(4):
            inside[(at + k)[size > k]] = False
    starts = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | edge[:-1]))
    ends = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | edge[1:])) + 1
    prefix = POWERS.prefix(KEYS[data])
    hashes = splitmix(POWERS.span(prefix, starts, ends) + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def sequence_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that start at each word, as far as they reach."""
    out = hashes[: max(0, len(hashes) - size + 1)]
    for k in range(1, size):
        out = splitmix(out * np.uint64(3) + hashes[k: k + len(out)])
    return out


@dataclass
class Index:
    """Impact-ordered by item number within each list; ``block_max`` covers ``BLOCK`` postings."""

    item_ids: list
    words: list[np.ndarray]  # term number of each word of each item
    question: list[int]  # words of the question
    terms: np.ndarray  # sorted word hashes
    lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # items, impacts, block maxima
    most: np.ndarray  # largest impact of each term
    span: int
    bounds: np.ndarray  # largest impact of each term in each block of BOUND_ITEMS items
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by number of words: sorted sequence hashes, items under MIN_WORDS

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Term number of each word, -1 for a word that no item has."""
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == hashes, at, -1)


def build_index(item_ids: list, texts: list[str], frequency: dict[int, int], items: int, mean_words: float) -> Index:
    """``item_ids`` come out with those under ``MIN_WORDS`` words last; frequencies and mean are the others'."""
    hashes, first = word_hashes(pa.array(texts, pa.string()))
    size = np.diff(first)
    order = np.argsort((size < MIN_WORDS) & (size > 0), kind="stable")
    item_ids, texts = [item_ids[i] for i in order], [texts[i] for i in order]
    short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for n in range(1, MIN_WORDS):
        at = np.flatnonzero(size[order] == n)
        if len(at):
            key = sequence_hashes(hashes, n)[first[order[at]]]
            by = np.argsort(key, kind="stable")
            short[n] = key[by], at[by]
    texts = texts[: len(texts) - sum(len(at) for _, at in short.values())]
    hashes, first = word_hashes(pa.array(texts, pa.string()))
    terms, number = np.unique(hashes, return_inverse=True)
    words = [number[a:b] for a, b in zip(first, first[1:])]
    question = []
    for text, seq in zip(texts, words):
        cut = max(text.rfind(mark) for mark in QUESTION_MARKS)
        asked = len(word_hashes(pa.array([text[: cut + 1]]))[0]) if cut >= 0 else 0
        question.append(asked if 0 < asked < len(seq) else -(-len(seq) // 2))
    df = np.array([frequency[int(t.view(np.int64))] for t in terms])
    idf = np.log(1 + (items - df + 0.5) / (df + 0.5))
    posted: list[list[tuple[int, float]]] = [[] for _ in terms]
    for i, seq in enumerate(words):
        term, times = np.unique(seq, return_counts=True)
        weight = idf[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * len(seq) / mean_words))
        for t, w in zip(term, weight / weight.sum()):
            posted[t].append((i, float(w)))
    lists = []
    for p in posted:
        at, impact = np.array([i for i, _ in p]), np.array([w for _, w in p])
        lists.append((at, impact, np.maximum.reduceat(impact, np.arange(0, len(impact), BLOCK))))
    most = np.array([lst[1].max() for lst in lists])
    bounds = np.zeros((len(terms), -(-len(words) // BOUND_ITEMS)), np.float32)
    for t, (at, impact, _) in enumerate(lists):
        np.maximum.at(bounds[t], at // BOUND_ITEMS, impact)
    span = max(64, 2 * max((len(w) for w in words), default=0))
    return Index(item_ids, words, question, terms, lists, most, span, bounds, short)


def block_max_wand(index: Index, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """Every item whose summed impacts over the distinct ``terms`` reach ``threshold``."""
    eps = 1e-9
    found: list[tuple[int, float]] = []
    cursors = [[int(index.lists[t][0][0]), 0, t] for t in terms]  # current item, place in list, term
    while cursors:
        cursors.sort(key=lambda c: c[0])
        bound, pivot = 0.0, -1
        for k, c in enumerate(cursors):
            bound += index.most[c[2]]
            if bound >= threshold - eps:
                pivot = k
                break
        if pivot < 0:
            return found
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        blocks, border = 0.0, len(index.words)
        for c in cursors[: pivot + 1]:
            at, _, maxima = index.lists[c[2]]
            place = c[1] + int(np.searchsorted(at[c[1]:], item))
            if place < len(at):
                block = place // BLOCK
                blocks += maxima[block]
                border = min(border, int(at[min(len(at), (block + 1) * BLOCK) - 1]) + 1)
        if pivot + 1 < len(cursors):
            border = min(border, cursors[pivot + 1][0])
        if blocks < threshold - eps:
            target = max(border, item + 1)  # no item before the nearest block border can reach it
        elif cursors[0][0] == item:
            score = sum(float(index.lists[c[2]][1][c[1]]) for c in cursors[: pivot + 1])
            if score >= threshold - eps:
                found.append((item, score))
            target = item + 1
        else:
            target = item
        for c in cursors[: pivot + 1]:
            at = index.lists[c[2]][0]
            c[1] += int(np.searchsorted(at[c[1]:], target))
            c[0] = int(at[c[1]]) if c[1] < len(at) else -1
        cursors = [c for c in cursors if c[0] >= 0]
    return found


def _grams(seq: np.ndarray, size: int) -> set:
    return {tuple(seq[i: i + size]) for i in range(len(seq) - size + 1)}


def overlap(index: Index, item: int, passage: np.ndarray) -> tuple[float, float]:
    """Share of the question's and of the answer's word n-grams that the passage has."""
    seq, cut = index.words[item], index.question[item]
    out = []
    for part in (seq[:cut], seq[cut:]):
        size = min(GRAM, len(part))
        wanted = _grams(part, size)
        out.append(len(wanted & _grams(passage, size)) / len(wanted) if wanted else 1.0)
    return out[0], out[1]


def leaks(column: pa.Array, indexes: list[Index], threshold: float = THRESHOLD) -> list[tuple]:
    """``row, item identifier, passages, score, question overlap, answer overlap`` of confirmed items, best passage each."""
    hashes, first = word_hashes(column)  # once for all indexes
    out = []
    for index in indexes:
        found = _short_leaks(hashes, first, index) + (_long_leaks(hashes, first, index, threshold) if index.words else [])
        out += [(row, index.item_ids[item], *rest) for row, item, *rest in found]
    return out


def _short_leaks(hashes: np.ndarray, first: np.ndarray, index: Index) -> list[tuple[int, int, int, float, float, float]]:
    out = []
    for size, (keys, items) in sorted(index.short.items()):
        runs = sequence_hashes(hashes, size)
        at = np.flatnonzero(np.isin(runs, keys))
        row = np.searchsorted(first, at, side="right") - 1
        whole = at + size <= first[row + 1]
        found = Counter(zip(row[whole].tolist(), runs[at[whole]].tolist()))
        for (r, key), places in sorted(found.items()):
            lo, hi = (int(np.searchsorted(keys, np.uint64(key), side=s)) for s in ("left", "right"))
            out += [(r, int(i), places, 1.0, 1.0, 1.0) for i in items[lo:hi]]
    return out


def _long_leaks(hashes: np.ndarray, first: np.ndarray, index: Index,
                threshold: float) -> list[tuple[int, int, int, float, float, float]]:
    term = index.lookup(hashes)
    stride = index.span // 2
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    blocks = np.maximum(1, -(-np.diff(first) // stride))
    base = np.concatenate(([0], np.cumsum(blocks)))  # block b of a text and block b + 1 make passage b
    block = base[doc] + (np.arange(len(hashes)) - first[doc]) // stride
    known = np.flatnonzero(term >= 0)
    if not len(known):
        return []
    weight = np.bincount(block[known], index.most[term[known]], base[-1])
    inner = np.ones(base[-1], bool)
    inner[base[1:] - 1] = False  # the last block of a text has no successor
    loose = weight + np.where(inner, np.append(weight[1:], 0.0), 0.0)
    maybe = loose >= threshold - 1e-9
    best: dict[tuple[int, int], list] = {}
    touched = known[maybe[block[known]] | (maybe[block[known] - 1] & (block[known] > base[doc[known]]))]
    own = touched[maybe[block[touched]]]
    earlier = touched[(block[touched] > base[doc[touched]])]
    earlier = earlier[maybe[block[earlier] - 1]]
    pair = np.unique(np.concatenate((block[own], block[earlier] - 1)) * len(index.terms)
                     + np.concatenate((term[own], term[earlier])))
    passage, distinct = pair // len(index.terms), pair % len(index.terms)
    bound = np.bincount(passage, index.most[distinct], base[-1])
    hopeful = bound >= threshold - 1e-9
    chosen = np.flatnonzero(hopeful)
    for lo in range(0, len(chosen), 256):
        part = chosen[lo: lo + 256]
        cuts = np.searchsorted(passage, part), np.searchsorted(passage, part + 1)
        at = np.concatenate([np.arange(x, y) for x, y in zip(*cuts)])
        holds = np.zeros((len(part), len(index.terms)), np.float32)
        holds[np.repeat(np.arange(len(part)), cuts[1] - cuts[0]), distinct[at]] = 1
        hopeful[part] = (holds @ index.bounds).max(axis=1) >= threshold - 1e-4
    for p in np.flatnonzero(hopeful):
        lo, hi = np.searchsorted(passage, (p, p + 1))
        hits = block_max_wand(index, distinct[lo:hi], threshold)
        if not hits:
            continue
        row = int(np.searchsorted(base, p, side="right")) - 1
        start = first[row] + (p - base[row]) * stride
        window = term[start: min(start + index.span, first[row + 1])]
        for item, score in hits:
            asked, answered = overlap(index, item, window)
            if asked >= OVERLAP and answered >= OVERLAP:
                got = best.setdefault((row, item), [0, 0.0, 0.0, 0.0])
                got[0] += 1
                if (score, asked, answered) > tuple(got[1:]):
                    got[1:] = [score, asked, answered]
    return [(row, item, *v) for (row, item), v in sorted(best.items())]


def index_shards(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 shard_bytes: int = SHARD_BYTES) -> DataFrame | None:
    """``place, size, index``: pickled indexes of bounded size that together hold every item with a word.

    Built by the tasks that the items are dealt to; None without such an item.
    """
    found = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(WORD), F.lit(0))
    items = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"), F.size(found).alias("n"))
    items = items.where("n > 0")
    scored = F.col("n") >= MIN_WORDS  # frequencies and mean length are of the items that are scored
    total = items.agg(F.count_if(scored).alias("items"), F.avg(F.when(scored, F.col("n"))).alias("mean"),
                      F.sum(F.octet_length("text")).alias("bytes")).first()
    if not total["bytes"]:
        return None
    n_items, mean = total["items"], total["mean"]
    shards = max(1, -(-total["bytes"] // shard_bytes))
    items = items.withColumn("place", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int"))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, first = word_hashes(batch.column("text"))
            each = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(first, first[1:])]
            if each:
                place = np.repeat(batch.column("place").to_numpy(), [len(e) for e in each])
                yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(np.concatenate(each))],
                                                 names=["place", "term"])

    def build(rows: pa.Table, known: pa.Table) -> pa.Table:
        cells = sorted(rows.select(["item_id", "text"]).to_pylist(),
                       key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
        frequency = dict(zip(known.column("term").to_pylist(), known.column("df").to_pylist()))
        index = build_index([r["item_id"] for r in cells], [r["text"] for r in cells], frequency, n_items, mean)
        blob = pickle.dumps(index)
        return pa.table({"place": rows.column("place")[:1], "size": pa.array([len(blob)], pa.int64()),
                         "index": pa.array([blob], pa.binary())})

    used = map_batches(items.where(scored).select("place", "text"), terms, "place int, term long")
    counts = used.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    known = used.distinct().join(counts, "term")
    built = (items.groupBy("place").cogroup(known.groupBy("place"))
             .applyInArrow(build, "place int, size long, index binary"))
    return materialise(built, "decontam-shards")


def index_groups(benchmark: DataFrame, group_bytes: int = GROUP_BYTES) -> Iterator[list[Index]]:
    """The indexes in groups of at most ``group_bytes`` (one at least): each is one broadcast and one scan of the documents."""
    shards = index_shards(benchmark)
    if shards is None:
        return
    group, held = [], 0
    sizes = sorted((r["place"], r["size"]) for r in shards.select("place", "size").collect())
    for k, (place, size) in enumerate(sizes):
        group.append(place)
        held += size
        if k + 1 == len(sizes) or held + sizes[k + 1][1] > group_bytes:
            rows = shards.where(F.col("place").isin(group)).orderBy("place").collect()
            yield [pickle.loads(r["index"]) for r in rows]
            group, held = [], 0


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, passages, score, question_overlap, answer_overlap`` of every confirmed leak."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = [rows.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
    schema = (f"doc_id {kinds[0]}, item_id {kinds[1]}, passages long, score double, question_overlap double, "
              "answer_overlap double")
    out = docs.sparkSession.createDataFrame([], schema)
    for indexes in index_groups(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(indexes)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    got = leaks(part.column("text"), shared.value, threshold)
                    if got:
                        cols = list(zip(*got))
                        yield pa.RecordBatch.from_arrays(
                            [part.column("doc_id").take(pa.array(cols[0])), pa.array(cols[1]),
                             pa.array(cols[2], pa.int64()), *[pa.array(c, pa.float64()) for c in cols[3:]]],
                            names=["doc_id", "item_id", "passages", "score", "question_overlap", "answer_overlap"])

        out = out.unionByName(map_batches(rows, run, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without a confirmed leak, with all their columns and without a shuffle."""
    for indexes in index_groups(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(indexes)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, text_col):
                    keep = np.ones(part.num_rows, bool)
                    keep[[row for row, *_ in leaks(part.column(text_col), shared.value, threshold)]] = False
                    yield part.filter(pa.array(keep))

        docs = map_batches(docs, run, docs.schema)
    return docs
