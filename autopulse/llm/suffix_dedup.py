"""Repeated passages by ranks of growing length over sampled windows.

A byte goes if it lies in a string of ``threshold`` bytes that also starts in a document with a
smaller id.  Equal strings get equal ranks, a rank being a hash of what stands there, so that
positions can be ranked where their text is and only ranks have to meet.  This is not prefix
doubling in its full form: ranks come from the text at each length instead of from sorted pairs of
the ranks of the length before (README has the figures of that form).

1. First rank: every window of ``threshold`` bytes picks the least hash among its grams of
   2/5 threshold bytes (the leftmost of equals).  Equal windows pick the same gram at the same
   place, so one row per run of windows with one gram is enough, about 1 per 15 bytes.  Spark
   deals the runs by gram rank; a rank that one document alone has is unique and dropped.
2. Reranking to the whole run: runs that agree in the gram and in all the bytes their windows
   cover are one rank.  All but those of the smallest document are settled as removed.
3. Past the threshold: where a gram has different runs, one representative of each is opened
   into its windows, and window i is ranked by the pair (rank of half a window at i, rank of half
   a window at i + threshold / 2).  Pairs with two documents settle all but the smallest.

Rows count as equal only by two ranks of 64 bits each.

Each step settles what a task can settle from its own rows before anything is shuffled: of
equal ranks only the smallest document's row goes on, so a passage that a third of all documents
share costs one row per task, and a group of copies is settled like any other.

Ranks are dealt in passes over slices of them, as many as keep what one pass shuffles near
``PASS_SHARE`` of the text; between steps the folders and shuffle files of those before are
deleted.  Steps 1 and 2 read the text again in each pass; step 3 reads only the bytes that opened
runs cover, which are stored once.

Defined cases: a null text is empty; texts shorter than the threshold lose nothing; equal ids
are one document, whose rows do not remove each other's bytes; a row with a null id is kept whole
and removes nothing; an empty table gives an empty result; other columns are not read.  Removed
runs that touch are one span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autopulse.llm.common import (
    Powers, byte_keys, map_batches, only_slots, ranges, release, ship, slices, slot, splitmix, stored, text_buffer,
)

THRESHOLD = 50
BUCKET_BYTES = 8 << 20
SEGMENT = 1 << 18  # of text that is ranked at once: a rank's arrays take about 100 bytes a byte
PLACE_BITS = 22  # a piece has fewer than 4 SEGMENT bytes
LOCAL_BYTES = 6 << 20  # of text that a task settles at once
RUN_BYTES, WINDOW_BYTES = 18, 18  # that a run or a window takes in the shuffle, compressed
RUN_EVERY = 15  # bytes of text, at a threshold of 50
PASS_SHARE = 0.75  # of the text's bytes that one pass shuffles
PASS_LEAST = 64 << 20  # bytes that are shuffled at once whatever the text's size
MARK = np.iinfo(np.int64).max  # stands for a document in rows that only mark a rank
KEYS = byte_keys(41)
POWERS = Powers()
#: A second, independent rank: rows are equal only if both are, 128 bits together.
KEYS_2 = byte_keys(43)
#: Runs hold at most as many windows as a byte counts.
LARGEST = 425
MAP_SCHEMA = "bucket long, n long, rank binary, full binary, doc binary, start binary, more binary"
FOUND_SCHEMA = "open boolean, doc_id long, start long, size long"
PIECES_SCHEMA = "doc_id long, text binary, runs array<struct<start:long,size:long,place:long>>"
LISTS_SCHEMA = "doc_id long, spans array<struct<start:long,size:long>>"
FOUND = pa.schema([("open", pa.bool_()), ("doc_id", pa.int64()), ("start", pa.int64()), ("size", pa.int64())])


def _in_slice(rank: np.ndarray, part: int, parts: int) -> np.ndarray:
    return rank % np.uint64(parts) == np.uint64(part)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least value in every window of ``width`` values.

    Values are compared by the bits above ``PLACE_BITS``; the place in the low bits makes the
    leftmost of equals the least, the same in equal windows wherever they stand.
    """
    mask = np.uint64((1 << PLACE_BITS) - 1)
    best, reach = (values & ~mask) | np.arange(len(values), dtype=np.uint64), 1
    while reach < width:
        step = min(reach, width - reach)
        best = np.minimum(best[step:], best[:-step])
        reach += step
    return (best & mask).astype(np.int64)


def window_runs(data: np.ndarray, offsets: np.ndarray, threshold: int, part: int = 0, parts: int = 1):
    """Runs of windows with one least gram: text number, first window, further windows, both ranks.

    Only those whose rank is in slice ``part`` of ``parts``.
    """
    gram = max(1, 2 * threshold // 5)
    count = len(data) - threshold + 1
    if count <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    prefix = POWERS.prefix(KEYS[data])
    size = len(data) - gram + 1
    grams = splitmix((prefix[gram:] - prefix[:size]) * POWERS.down[:size])
    least = sliding_least(grams, threshold - gram + 1)[:count]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:count]
    inside = np.arange(count) + threshold <= np.repeat(offsets[1:], np.diff(offsets))[:count]
    change = np.ones(count, bool)
    change[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(change & inside)
    if parts > 1:
        first = first[_in_slice(grams[least[first]], part, parts)]
    stop = np.append(np.flatnonzero(change), count)
    ends = stop[np.searchsorted(stop, first, side="right")]
    ends = np.minimum(ends, offsets[text[first] + 1] - threshold + 1)  # past the last window of the text
    rank = grams[least[first]]
    whole = POWERS.span(prefix, first, ends + threshold - 1)
    full = splitmix(whole + (least[first] - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    + (ends - first).astype(np.uint64))
    return text[first], first - offsets[text[first]], ends - first - 1, rank, full


def _segments(data: np.ndarray, offsets: np.ndarray, threshold: int, part: int, parts: int):
    """``window_runs`` in pieces of bounded size; a long text's windows are dealt over pieces."""
    if len(data) <= 2 * SEGMENT or len(offsets) > 2:
        yield window_runs(data, offsets, threshold, part, parts)
        return
    for lo in range(0, len(data) - threshold + 1, SEGMENT):
        piece = data[lo: lo + SEGMENT + threshold - 1]
        text, start, more, rank, full = window_runs(piece, np.array([0, len(piece)]), threshold, part, parts)
        yield text, start + lo, more, rank, full


def merge_spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of spans per document; touching spans become one."""
    order = np.lexsort((end, start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    _, number = np.unique(doc, return_inverse=True)
    lift = number * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + lift)
    head = np.ones(len(doc), bool)
    head[1:] = start[1:] + lift[1:] > reach[:-1]
    at = np.flatnonzero(head)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], reach[last] - lift[at]


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Number of each row's group among rows sorted by ``keys``."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    head = np.zeros(len(keys[0]), np.int64)
    for k in keys:
        head[1:] |= k[1:] != k[:-1]
    return np.cumsum(head)


def settle(rank, full, doc, start):
    """Which rows are removed (a smaller document has the same run), and which ranks stay in question.

    Returns three masks in the order of the rows: removed; of a rank with different runs in
    two or more documents; of a rank that a second row has.
    """
    removed, varied, shared = (np.zeros(len(rank), bool) for _ in range(3))
    order = np.argsort(rank)
    ranked = rank[order]
    same = ranked[1:] == ranked[:-1]
    shared_sorted = np.zeros(len(rank), bool)
    shared_sorted[1:] |= same
    shared_sorted[:-1] |= same
    at = order[shared_sorted]
    shared[at] = True
    if len(at):
        at = at[np.lexsort((doc[at], full[at], rank[at]))]
        by_rank, by_run = _groups(rank[at]), _groups(rank[at], full[at])
        heads = np.flatnonzero(np.concatenate(([True], by_run[1:] != by_run[:-1])))
        removed[at] = doc[at] > doc[at][heads][by_run]
        tops = np.flatnonzero(np.concatenate(([True], by_rank[1:] != by_rank[:-1])))
        runs = np.bincount(by_rank[heads])
        alone = np.minimum.reduceat(doc[at], tops) == np.maximum.reduceat(doc[at], tops)
        varied[at] = ((runs > 1) & ~alone)[by_rank]
    return removed, varied, shared


def _planes(values: np.ndarray) -> bytes:
    """Integers as byte planes, so that the empty high bytes compress in the shuffle."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplanes(data, kind, n: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(data, np.uint8).reshape(width, n)
    return np.ascontiguousarray(raw.T).reshape(-1).view(kind)


def _packed(bucket: np.ndarray, rank, full, doc, start, more) -> pa.RecordBatch:
    """One row per bucket that holds its rows' columns as bytes, in the order given."""
    low = int(bucket.min()) if len(bucket) else 0
    span = int(bucket.max()) - low + 1 if len(bucket) else 1
    order = np.argsort((bucket - low).astype(np.uint16 if span <= 1 << 16 else np.int64), kind="stable")
    bucket = bucket[order]
    cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)])) if len(bucket) else [0]
    heads, sizes = [int(bucket[a]) for a in cuts[:-1]], np.diff(cuts).tolist()
    out = []
    for c in (rank, full, doc, start, more):
        c = c[order]  # one column at a time is held twice
        out.append(pa.array([_planes(c[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array(heads, pa.int64()), pa.array(sizes, pa.int64()),
                                       *out],
                                      names=["bucket", "n", "rank", "full", "doc", "start", "more"])


def _unpacked(table: pa.Table):
    parts: list[list[np.ndarray]] = [[] for _ in range(5)]
    kinds = (np.uint64, np.uint64, np.int64, np.int64, np.uint8)
    for k, name in enumerate(("rank", "full", "doc", "start", "more")):
        for chunk_n, chunk in zip(table.column("n").chunks, table.column(name).chunks):
            for n, v in zip(chunk_n.to_pylist(), chunk):
                parts[k].append(_unplanes(v.as_buffer(), kinds[k], n))
    return [np.concatenate(p) if p else np.zeros(0, kind) for p, kind in zip(parts, kinds)]


def _found(removed, opened) -> pa.RecordBatch:
    (d0, s0, e0), (d1, s1, m1) = removed, opened
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate((np.zeros(len(d0), bool), np.ones(len(d1), bool)))),
        pa.array(np.concatenate((d0, d1)).astype(np.int64)), pa.array(np.concatenate((s0, s1)).astype(np.int64)),
        pa.array(np.concatenate((e0 - s0, m1.astype(np.int64) + 1)).astype(np.int64))], schema=FOUND)


def _pass_rows(found: pa.RecordBatch, buckets: int, seed: int) -> pa.RecordBatch:
    """What is settled or known to be open already travels beside the ranks, in buckets below 0."""
    doc = found.column("doc_id").to_numpy()
    kind = np.where(found.column("open").to_numpy(zero_copy_only=False), 1, 0).astype(np.uint64)
    size = found.column("size").to_numpy().astype(np.uint64)
    bucket = -1 - ((doc // 64 + seed) % buckets)
    return _packed(bucket, kind, size, doc, found.column("start").to_numpy(), np.zeros(len(doc), np.uint8))


def _resolve(table: pa.Table, threshold: int, doubled: bool) -> pa.Table:
    """One bucket: settle its ranks; ``doubled``: rows are single windows, none is opened further."""
    rank, full, doc, start, more = _unpacked(table)
    if len(table) and table.column("bucket")[0].as_py() < 0:
        return pa.Table.from_arrays([pa.array(rank == 1), pa.array(doc), pa.array(start),
                                     pa.array(full.astype(np.int64))], schema=FOUND)
    marker = doc == MARK
    marked = np.unique(rank[marker])
    rank, full, doc, start, more = [c[~marker] for c in (rank, full, doc, start, more)]
    removed, varied, _ = settle(rank, full, doc, start)
    out = merge_spans(doc[removed], start[removed], start[removed] + more[removed] + threshold)
    opened = np.zeros(len(rank), bool) if doubled else ~removed & (varied | np.isin(rank, marked))
    return pa.Table.from_batches([_found(out, (doc[opened], start[opened], more[opened]))])


def _joined(got: list[tuple]) -> list[np.ndarray]:
    """The columns of all parts; ``got`` is emptied."""
    columns = [list(c) for c in zip(*got)]
    got.clear()
    return [np.concatenate(columns.pop(0)) for _ in range(len(columns))]


def _send(rank, full, doc, start, more, threshold: int, buckets: int, doubled: bool) -> list[pa.RecordBatch]:
    """Settle a task's own rows; what needs other tasks' rows goes to the bucket of its rank."""
    removed, varied, _ = settle(rank, full, doc, start)
    out = merge_spans(doc[removed], start[removed], start[removed] + more[removed] + threshold)
    opened = np.zeros(len(rank), bool) if doubled else ~removed & varied
    found = _found(out, (doc[opened], start[opened], more[opened]))
    marks = np.unique(rank[opened])  # one row tells the others that this rank has different runs
    test, none = ~removed & ~opened, np.zeros(len(marks), np.int64)
    rank, doc = np.concatenate((rank[test], marks)), np.concatenate((doc[test], none + MARK))
    full = np.concatenate((full[test], none.astype(np.uint64)))
    start, more = np.concatenate((start[test], none)), np.concatenate((more[test], none.astype(np.uint8)))
    bucket = (splitmix(rank) % np.uint64(buckets)).astype(np.int64)
    return [_packed(bucket, rank, full, doc, start, more), _pass_rows(found, buckets, threshold)]


def _first_ranks(rows: DataFrame, threshold: int, buckets: int, part: int = 0, parts: int = 1) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("doc_id")))
            got, held = [], 0
            for piece in slices(batch, limit=SEGMENT):
                data, offsets = text_buffer(piece.column("text"))
                ids = piece.column("doc_id").to_numpy()
                for text, start, more, rank, full in _segments(data, offsets, threshold, part, parts):
                    got.append((rank, full, ids[text], start, more.astype(np.uint8)))
                    held += min(len(data), SEGMENT) // parts
                    if held >= LOCAL_BYTES:
                        yield from _send(*_joined(got), threshold, buckets, False)
                        held = 0
            if got:
                yield from _send(*_joined(got), threshold, buckets, False)

    return map_batches(rows, run, MAP_SCHEMA)


def _pieces(opened: DataFrame, threshold: int) -> DataFrame:
    """The bytes that a document's opened runs cover, joined, and where in them each run begins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, sizes, cells = [], [], [0], []
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column("text")[i].as_buffer(), np.uint8)
                runs = batch.column("runs")[i].values
                start, size = (runs.field(k).to_numpy(zero_copy_only=False) for k in ("start", "size"))
                size = np.minimum(size, len(data) - threshold + 1 - start)  # rows of one id may differ in length
                start, size = start[size > 0], size[size > 0]
                if not len(start):
                    continue
                _, lo, hi = merge_spans(np.zeros(len(start), np.int64), start, start + size + threshold - 1)
                piece = np.searchsorted(lo, start, side="right") - 1
                before = np.cumsum(hi - lo) - (hi - lo)
                ids.append(batch.column("doc_id")[i].as_py())
                texts.append(data[ranges(lo, hi - lo)].tobytes())
                sizes.append(sizes[-1] + len(start))
                cells.append((start, size, before[piece] + start - lo[piece]))
            columns = [np.concatenate(c) for c in zip(*cells)] if cells else [np.zeros(0, np.int64)] * 3
            runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["start", "size", "place"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), runs)], names=["doc_id", "text", "runs"])

    return map_batches(opened, run, PIECES_SCHEMA)


def _window_ranks(pieces: DataFrame, threshold: int, buckets: int, part: int = 0, parts: int = 1) -> DataFrame:
    """Pairs of half-window ranks, those of one slice, for every window of the opened runs."""
    half = threshold // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got, held = [], 0
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column("text")[i].as_buffer(), np.uint8)
                runs = batch.column("runs")[i].values
                start, size, place = (runs.field(k).to_numpy(zero_copy_only=False) for k in ("start", "size", "place"))
                at = ranges(place, size)
                prefix = POWERS.prefix(KEYS[data])
                left = splitmix(POWERS.span(prefix, at, at + half))
                right = splitmix(POWERS.span(prefix, at + half, at + threshold))
                pair = splitmix(left * np.uint64(3) + right)
                at_text = ranges(start, size)
                if parts > 1:
                    mine = _in_slice(pair, part, parts)
                    pair, at, at_text = pair[mine], at[mine], at_text[mine]
                doc = np.full(len(at), batch.column("doc_id")[i].as_py(), np.int64)
                second = splitmix(POWERS.span(POWERS.prefix(KEYS_2[data]), at, at + threshold))
                got.append((pair, second, doc, at_text, np.zeros(len(at), np.uint8)))
                held += len(at)
                if held >= LOCAL_BYTES // 12:
                    yield from _send(*_joined(got), threshold, buckets, True)
                    held = 0
            if got:
                yield from _send(*_joined(got), threshold, buckets, True)

    return map_batches(pieces, run, MAP_SCHEMA)


def _meet(ranks: DataFrame, threshold: int, doubled: bool) -> DataFrame:
    ship(ranks.sparkSession)
    return ranks.groupBy("bucket").applyInArrow(lambda t: _resolve(t, threshold, doubled), FOUND_SCHEMA)


def _passes(shuffled: int, total: int) -> int:
    """In how many passes so many bytes are shuffled."""
    return max(1, -(-shuffled // int(max(PASS_LEAST, PASS_SHARE * total))))


def _store_found(spark, ranks, buckets: int, shuffled: int, total: int, threshold: int, doubled: bool) -> list[str]:
    """``_meet`` in passes over slices of ranks; ``ranks`` makes the rows of one slice."""
    paths, parts = [], _passes(shuffled, total)
    for part in range(parts):
        found = _meet(ranks(-(-buckets // parts), part, parts), threshold, doubled)
        paths.append(stored(found, "suffix-second" if doubled else "suffix-first"))
        del found
        release(spark, shuffled=shuffled)
    return paths


def _store_pieces(rows: DataFrame, first: DataFrame, threshold: int) -> str:
    spark = rows.sparkSession
    runs = first.where("open").groupBy("doc_id").agg(F.collect_list(F.struct("start", "size")).alias("runs"))
    at = stored(runs, "suffix-open")
    runs = spark.read.schema(runs.schema).parquet(at)
    opened = only_slots(rows.where("text IS NOT NULL"), "doc_id", runs, "doc_id").join(runs, "doc_id")
    out = stored(_pieces(opened, threshold), "suffix-pieces")
    release(spark, at)
    return out


def _store_spans(docs: DataFrame, threshold: int, id_col: str, text_col: str) -> tuple[list[str], int]:
    """Folders of ``FOUND_SCHEMA`` whose rows that aren't open are the removed bytes; the text's size."""
    if not 5 <= threshold <= LARGEST:
        raise ValueError(f"threshold must be from 5 to {LARGEST}, got {threshold}")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    runs = total // max(1, RUN_EVERY * threshold // 50)
    found = _store_found(spark, lambda *k: _first_ranks(rows, threshold, *k), -(-total // BUCKET_BYTES) or 1,
                         runs * RUN_BYTES, total, threshold, False)
    first = spark.read.schema(FOUND_SCHEMA).parquet(*found)
    windows = first.where("open").agg(F.sum("size").alias("n")).first()["n"] or 0
    if windows:
        at = _store_pieces(rows, first, threshold)
        release(spark, shuffled=total)
        pieces = spark.read.schema(PIECES_SCHEMA).parquet(at)
        found += _store_found(spark, lambda *k: _window_ranks(pieces, threshold, *k),
                              -(-windows // max(1, BUCKET_BYTES // RUN_EVERY)),
                              windows * WINDOW_BYTES, total, threshold, True)
        release(spark, at)
    return found, total


def repeated_spans(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, start, size`` of removed bytes; spans of one document may touch or overlap."""
    found, _ = _store_spans(docs, threshold, id_col, text_col)
    return _spans(docs.sparkSession, found)


def _spans(spark, found: list[str]) -> DataFrame:
    return spark.read.schema(FOUND_SCHEMA).parquet(*found).where("NOT open").select("doc_id", "start", "size")


def _span_lists(spans: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, spans``: each document's spans as one list, those that touch joined."""
    def rows(got: list[tuple]) -> pa.RecordBatch:
        doc, start, end = merge_spans(*_joined(got))
        none = np.zeros(len(doc), np.uint64)
        bucket = (splitmix(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        return _packed(bucket, none, (end - start).view(np.uint64), doc, start, none.astype(np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, held = [], 0
        for batch in batches:
            doc, start, size = (batch.column(k).to_numpy() for k in ("doc_id", "start", "size"))
            got.append((doc, start, start + size))
            held += len(doc)
            if held >= LOCAL_BYTES // 12:
                yield rows(got)
                held = 0
        if got:
            yield rows(got)

    def lists(table: pa.Table) -> pa.Table:
        _, size, doc, start, _ = _unpacked(table)
        doc, start, end = merge_spans(doc, start, start + size.view(np.int64))
        heads = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        cells = pa.StructArray.from_arrays([pa.array(start), pa.array(end - start)], ["start", "size"])
        offsets = pa.array(np.append(heads, len(doc)), pa.int32())
        return pa.table({"doc_id": pa.array(doc[heads]), "spans": pa.ListArray.from_arrays(offsets, cells)})

    return map_batches(spans, run, MAP_SCHEMA).groupBy("bucket").applyInArrow(lists, LISTS_SCHEMA)


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: each document's remaining bytes."""
    spark = docs.sparkSession
    found, total = _store_spans(docs, threshold, id_col, text_col)
    at = stored(_span_lists(_spans(spark, found), -(-total // BUCKET_BYTES) or 1), "suffix-lists")
    release(spark, *found, shuffled=total)
    lists = spark.read.schema(LISTS_SCHEMA).parquet(at)
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, count, kept = [], [], [], []
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column("text")[i].as_buffer(), np.uint8)
                cells = batch.column("spans")[i].values
                if cells is None:
                    size.append(len(data))
                    gone.append(0)
                    count.append(0)
                    kept.append(data.tobytes())
                    continue
                start, length = (cells.field(k).to_numpy(zero_copy_only=False) for k in ("start", "size"))
                end = np.minimum(start + length, len(data))
                _, start, end = merge_spans(np.zeros(len(start), np.int64), start, end)
                edge = np.zeros(len(data) + 1, np.int64)
                edge[start] += 1
                np.subtract.at(edge, end, 1)
                stays = np.cumsum(edge[:-1]) == 0
                size.append(len(data))
                gone.append(int(len(data) - stays.sum()))
                count.append(len(start))
                kept.append(data[stays].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in (size, gone, count)],
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    touched = only_slots(rows, "doc_id", lists, "doc_id").join(lists, "doc_id", "left")
    taken = lists.select(slot(F.col("doc_id")).alias("_slot")).distinct()
    untouched = rows.withColumn("_slot", slot(F.col("doc_id"))).join(F.broadcast(taken), "_slot", "left_anti").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept"))
    return map_batches(touched, run, schema).unionByName(untouched).withColumn("doc_id", F.col("doc_id").cast(kind))
