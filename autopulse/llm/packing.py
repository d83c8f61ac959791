"""Best-fit packing by a grouping genetic algorithm on islands.

Documents are tokenised once; those longer than a sequence are cut into whole sequences, the
first piece taking the remainder.  Whole pieces are sequences by themselves.  The others are
dealt by hash into blocks of about ``BLOCK_ITEMS`` pieces, so a hot source or a group of copies
is spread like anything else, and each block is packed by several islands:

* a chromosome is a list of bins (groups), not of items; the first ones come from best fit over
  shuffled orders and best-fit decreasing;
* crossover takes whole well-filled bins of one parent, those of the other that share no piece
  with them, and best-fits the displaced pieces, largest first;
* before the displaced pieces go in, single pieces and pairs of the kept bins give way to a
  displaced one that fills their bin better;
* after each epoch an island's elite migrates to the next island of its block (a join on block
  and island), and the next epoch starts from both.

A block is settled when an island's bins meet the lower bound (total tokens, or pieces that can't
share a bin: then no search can do better), or when an epoch improves none of its islands.  Bins
that are full to ``DONE`` tokens stay.  The pieces of the others are dealt into new, fewer blocks
and packed again, as long as that takes fewer bins and more than one block is left.  Each round is
a table in the shared folder; a task only ever holds one block.

``tokenize_pieces`` gives the pieces' real token ids if asked; packing needs lengths only.

Defined cases: a null or empty text is a piece of one token (the closing id 0); ties in fill go to
the first bin; equal rows are separate pieces (told apart by an arrival number); a very long text
is tokenised whole and cut into sequences; an empty table gives an empty result; other columns are
not read.  A sequence is numbered by the smallest arrival number of its pieces.
"""

from __future__ import annotations

import base64
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autopulse.llm.common import map_batches, materialise

CAPACITY = 2048
BLOCK_ITEMS = 2000
ISLANDS = 2
POPULATION = 6
#: Children of an island in an epoch.
CROSSOVERS = 24
#: An epoch that raises the mean squared fill by less has improved nothing.
LEAST_GAIN = 1e-4
#: Pairs are exchanged only in bins of at most so many pieces.
PAIR_BIN = 8
MOST_TASKS = 4096
DONE = CAPACITY - 2
END_ID = 0
#: Both tokenizer libraries agree below this code point; texts beyond it take the reference library.
PLAIN_LIMIT = "ɐ"
SPECIAL = "<|endoftext|>"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoders(model: str, ranks: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return Tokenizer.from_file(model), fast


def encode(text: str, model: str, ranks: str) -> np.ndarray:
    """Token ids of a text by the tokenizer file ``model``.

    Texts of common Latin characters go through the same vocabulary and merges in the
    faster library, which gives the same ids; all others, and texts that spell a special
    token, go through the tokenizer file itself.
    """
    exact, fast = _encoders(model, ranks)
    if (text.isascii() or max(text) < PLAIN_LIMIT) and SPECIAL not in text:
        return np.array(fast.encode_ordinary(text), dtype="<u4")
    return np.array(exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


def tokenize_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                    paths: tuple[str, str] | None = None, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, ids]``; paths name files that every node has."""
    model, ranks = paths or default_paths()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"]
    schema = f"doc_id {kind.dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            source, out, ids_out = [], [], []
            for row, text in enumerate(pc.fill_null(batch.column("text"), "")):
                ids = np.append(encode(text.as_py(), model, ranks), np.array([END_ID], "<u4")).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[a:b].tobytes()
                    source.append(row)
                    out.append((piece, a, b - a, zlib.crc32(part)))
                    if with_ids:
                        ids_out.append(ids[a:b].astype(np.int64))
            cols = list(zip(*out))
            arrays = [batch.column("doc_id").take(pa.array(source)), pa.array(cols[0], pa.int32()),
                      *[pa.array(c, pa.int64()) for c in cols[1:]]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return map_batches(rows, run, schema + (", ids array<bigint>" if with_ids else ""))


# --- the grouping genetic algorithm over one block ----------------------------------------

def best_fit(order: list[int], lengths: list[int], capacity: int, bins: list[list[int]],
             rooms: list[int]) -> list[list[int]]:
    """Put items one by one into the fullest bin that takes them; ``rooms``: free tokens of ``bins``."""
    free = sorted((r, b) for b, r in enumerate(rooms) if r)
    for item in order:
        need = lengths[item]
        at = bisect_left(free, (need, -1))
        if at < len(free):
            room, b = free.pop(at)
            bins[b].append(item)
        else:
            room, b = capacity, len(bins)
            bins.append([item])
        if room > need:
            insort(free, (room - need, b))
    return bins


def fitness(bins: list[list[int]], lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller bins (mean squared fill)."""
    fill = [sum(lengths[i] for i in b) / capacity for b in bins]
    return -len(bins), sum(f * f for f in fill) / max(1, len(fill))


def lower_bound(lengths: list[int], capacity: int) -> int:
    """Bins that any packing needs: by total size, and by pieces too large to share with others."""
    size = np.sort(np.asarray(lengths, np.int64))
    if not len(size):
        return 0
    total = np.concatenate(([0], np.cumsum(size)))
    half = np.searchsorted(size, capacity // 2, side="right")
    # for each threshold k: pieces above capacity - k stand alone, those above half stand apart,
    # and those from k to half fill what the latter leave
    k = np.unique(np.append(size[:half], 0))
    alone = np.searchsorted(size, capacity - k, side="right")
    alone = np.maximum(alone, half)
    small = np.searchsorted(size, k, side="left")
    left = (alone - half) * capacity - (total[alone] - total[half])
    rest = total[half] - total[np.minimum(small, half)] - left
    return int(max((len(size) - half + np.maximum(0, -(-rest // capacity))).max(), -(-int(total[-1]) // capacity)))


def exchange(bins: list[list[int]], rest: list[int], lengths: list[int], capacity: int) -> list[int]:
    """Let a displaced piece take the place of one or two pieces where it fills the bin better; the new ``rest``."""
    free = sorted((lengths[i], i) for i in rest)

    def larger(size: int, most: int):
        at = bisect_left(free, (most + 1, -1)) - 1
        return free.pop(at) if at >= 0 and free[at][0] > size else None

    for group in bins:
        room = capacity - sum(lengths[i] for i in group)
        if not room or not free:
            continue
        pairs = combinations(group, 2) if len(group) <= PAIR_BIN else ()
        for out in [*((i,) for i in group), *pairs]:
            size = sum(lengths[i] for i in out)
            if any(i not in group for i in out):
                continue
            better = larger(size, size + room)
            if better:
                for i in out:
                    group.remove(i)
                    insort(free, (lengths[i], i))
                group.append(better[1])
                room -= better[0] - size
                if not room:
                    break
    return [i for _, i in free]


def crossover(a: list[list[int]], b: list[list[int]], lengths: list[int], capacity: int, rng) -> list[list[int]]:
    """Whole well-filled bins of ``a``, bins of ``b`` without duplicates, displaced items by exchange and best fit."""
    fill = [sum(lengths[i] for i in g) for g in a]
    bar = capacity - int(rng.integers(0, max(2, capacity // 32)))
    child = [list(g) for g, f in zip(a, fill) if f >= bar]
    placed = {i for g in child for i in g}
    rest: list[int] = []
    for g in b:
        if placed.isdisjoint(g) and sum(lengths[i] for i in g) >= bar:
            child.append(list(g))
        else:
            rest.extend(i for i in g if i not in placed)
    seen = {i for g in child for i in g}
    rest = exchange(child, [i for i in rest if i not in seen], lengths, capacity)
    jitter = rng.random(len(rest))
    rest = [i for _, i in sorted(zip(jitter * 24 - np.array([lengths[i] for i in rest]), rest))] if rest else []
    rooms = [capacity - sum(lengths[i] for i in g) for g in child]
    return best_fit(rest, lengths, capacity, child, rooms)


def decode(genome: list[int]) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for item, b in enumerate(genome):
        bins.setdefault(b, []).append(item)
    return list(bins.values())


def encode_bins(bins: list[list[int]], n: int) -> list[int]:
    genome = [0] * n
    for b, items in enumerate(bins):
        for i in items:
            genome[i] = b
    return genome


def evolve(lengths: list[int], elites: list[list[int]], capacity: int, seed: int) -> list[int]:
    """One epoch of one island: the elite's bin per item."""
    rng = np.random.default_rng(seed)
    n = len(lengths)
    people = [decode(g) for g in elites if g]
    size = np.array(lengths)
    bound = lower_bound(lengths, capacity)
    while len(people) < POPULATION and not any(len(p) <= bound for p in people):
        noise = 0.0 if not people else float(rng.integers(1, 1 + capacity // 8))
        order = np.lexsort((np.arange(n), -(size + rng.random(n) * noise))).tolist()
        people.append(best_fit(order, lengths, capacity, [], []))
    ranked = sorted(((fitness(p, lengths, capacity), k, p) for k, p in enumerate(people)), reverse=True)
    for k in range(CROSSOVERS):
        if -ranked[0][0][0] <= bound:
            break
        a, b = rng.choice(len(ranked), 2, replace=False)
        child = crossover(ranked[a][2], ranked[b][2], lengths, capacity, rng)
        ranked = sorted([*ranked, (fitness(child, lengths, capacity), -1 - k, child)], reverse=True)[:POPULATION]
    return encode_bins(ranked[0][2], n)


# --- islands over Spark ---------------------------------------------------------------------

STATE = ("block long, island int, items array<bigint>, lengths array<bigint>, genome array<bigint>, bins long, "
         "fill double, proven boolean, improved boolean")


def _epoch(state: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """One row per island: evolve from its elite and the migrant's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                seed = (r["block"] * 1009 + r["island"] * 31 + epoch) & 0x7FFFFFFF
                genome = evolve(r["lengths"], [g for g in (r["genome"], r["migrant"]) if g], capacity, seed)
                bins, fill = fitness(decode(genome), r["lengths"], capacity)
                gained = r["bins"] is None or -bins < r["bins"] or -bins == r["bins"] and fill > r["fill"] + LEAST_GAIN
                yield pa.RecordBatch.from_pylist(
                    [{**{k: r[k] for k in ("block", "island", "items", "lengths")}, "genome": genome, "bins": -bins,
                      "fill": fill, "proven": -bins <= lower_bound(r["lengths"], capacity), "improved": gained}], schema=arrow)

    arrow = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("items", pa.list_(pa.int64())),
                       ("lengths", pa.list_(pa.int64())), ("genome", pa.list_(pa.int64())), ("bins", pa.int64()),
                       ("fill", pa.float64()), ("proven", pa.bool_()), ("improved", pa.bool_())])
    return map_batches(state, run, STATE)


def pack_blocks(items: DataFrame, blocks: int, capacity: int, round_no: int) -> DataFrame:
    """``item, length, block, bin`` of the best island of every block."""
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", F.lit(round_no)), F.lit(blocks)))
    grouped = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("item", "length"))).alias("rows"))
    state = (grouped.select("block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                            F.col("rows.item").alias("items"), F.col("rows.length").alias("lengths"),
                            *[F.lit(None).cast(t).alias(c) for c, t in (("genome", "array<bigint>"), ("migrant", "array<bigint>"),
                                                                        ("bins", "bigint"), ("fill", "double"))]))
    settled, tasks = None, min(ISLANDS * blocks, MOST_TASKS)
    for epoch in count():
        # a stated number: few bytes but much work a row, so partitions are not to be joined by size
        state = materialise(_epoch(state.repartition(tasks, "block", "island"), capacity, epoch), f"pack-{round_no}-{epoch}")
        known = state.groupBy("block").agg((F.bool_or("improved") & ~F.bool_or("proven")).alias("open"))
        ended = state.join(known.where(~F.col("open")), "block", "left_semi")
        settled = ended if settled is None else settled.unionByName(ended)
        going = state.join(known.where("open"), "block", "left_semi")
        if going.isEmpty():
            break
        # the ring: each island hears from the one before it
        move = going.select("block", ((F.col("island") + 1) % ISLANDS).cast("int").alias("island"),
                            F.col("genome").alias("migrant"))
        state = going.drop("proven", "improved").join(move, ["block", "island"])
    best = settled.groupBy("block").agg(F.min_by(
        F.struct("items", "lengths", "genome"), F.struct("bins", -F.col("fill"), "island")).alias("e"))
    cells = best.select("block", F.explode(F.arrays_zip(
        F.col("e.items").alias("item"), F.col("e.lengths").alias("length"), F.col("e.genome").alias("bin"))).alias("c"))
    return cells.select("block", "c.item", "c.length", "c.bin")


def _loose(packed: DataFrame) -> tuple[DataFrame, int, int]:
    """The rows of sequences that are not full, and how many rows and sequences those are."""
    loose = packed.where(F.col("filled") < DONE)
    n = loose.agg(F.count(F.lit(1)).alias("items"), F.count_distinct("sequence").alias("bins")).first()
    return loose, n["items"], n["bins"]


def pack(pieces: DataFrame, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``length`` tokens each, at most ``capacity``)."""
    numbered = materialise(pieces.withColumn("item", F.monotonically_increasing_id()), "pack-pieces")
    todo = numbered.where(F.col("length") < capacity).select("item", "length")
    done = numbered.where(F.col("length") >= capacity).select(
        "item", "length", F.concat(F.lit("w"), F.col("item").cast("string")).alias("sequence"))
    n, bins, loose = todo.count(), None, None
    for round_no in count():
        blocks = max(1, -(-n // block_items))
        name = F.concat_ws("-", F.lit(str(round_no)), F.col("block").cast("string"), F.col("bin").cast("string"))
        packed = pack_blocks(todo, blocks, capacity, round_no).withColumn("sequence", name)
        filled = F.sum("length").over(Window.partitionBy("sequence"))
        packed = materialise(packed.withColumn("filled", filled), f"pack-round-{round_no}")
        if bins is not None and packed.select("sequence").distinct().count() >= bins:
            break  # dealing the loose pieces anew saves nothing: they stay as they were
        full = packed.where(F.col("filled") >= DONE)
        done = done.unionByName(full.select("item", "length", "sequence"))
        loose, n, bins = _loose(packed)
        todo = loose.select("item", "length")
        if blocks == 1 or not n:
            break
    done = done.unionByName(loose.select("item", "length", "sequence"))
    # a sequence holds at most `capacity` pieces, so its window is bounded
    same = Window.partitionBy("sequence")
    before = F.sum("length").over(same.orderBy("item")) - F.col("length")
    placed = done.withColumn("offset", before).withColumn("sequence_id", F.min("item").over(same))
    return numbered.join(placed.select("item", "offset", "sequence_id"), "item").drop("item")


def best_fit_packing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                     paths: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: one row per piece."""
    pieces = tokenize_pieces(docs, id_col, text_col, capacity, paths)
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
