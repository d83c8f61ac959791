"""MinHash near-duplicates by an inverted join on signature coordinates.

Texts become sets of distinct five-word shingles.  Equal sets form one class, so copies are never
paired.  Each class has a signature of ``COORDINATES`` minima, and every (coordinate, value) pair
is an element posted to an inverted list:

* prefix: elements are ordered by global frequency, rarest first.  Two classes that agree in at
  least M coordinates share an element among their first COORDINATES - M + 1, so only
  these are posted.  Long lists (a passage that many texts hold) fall behind the prefix and are
  skipped, the way a skip merge leaves them to the final count;
* lists longer than ``BLOCK`` are dealt into blocks, and pairs of blocks are separate rows, so no
  list is held whole by a task; lists longer than ``LONG`` are settled first, see below; lists with
  the same members are looked at once;
* count: within a list the collisions of whole signatures are counted, and pairs with at least
  M that could reach the threshold by their set sizes are candidates.

A long list is mostly one family of near copies.  Its classes are compared with a few
representatives, linked, and compared again while that joins components: work in proportion to the
list.  Pairs inside the list's largest component then need no look any more; what is left are the
other classes against all, at most about two rows a member while they fit one block.  A list up to
``LONG`` is compared as it is, at most ``LONG / BLOCK`` rows a member.

Candidates are taken in rounds.  In the first, each class names its best partner per list.  Those
pairs are confirmed on full shingle sets, confirmed links merge components, and pairs inside a
component need no further look.  Classes with a candidate also get a longer sketch
(``SKETCH`` coordinates, a byte each), and in the next round they name all partners outside their
component that the sketch does not rule out (a third round would follow if a list held more than
GROWTH).  So no link that joins two components is lost, and a group of thousands of near copies is
mostly settled by the first round's few rows instead of all its pairs.

Components come from label propagation with pointer jumping over joins; nothing about all
documents reaches the driver.  The threshold is ``percent`` (85 unless the caller asks for another);
M and the sketch's least count follow from it: a pair exactly at the threshold falls below either
with a probability of at most ``MISSED``.

Defined cases: null or empty texts have no shingles and are linked with nothing; a text with
fewer than five words is one shingle; very long texts are read whole; copies share their class;
rows that share an id but not their text are judged apart, each by its own text; a null id is linked
with nothing and kept; an empty table gives an empty result; other columns are not read.  Classes
have numbers of their own inside; a component is named by its smallest id at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autopulse.llm.common import Powers, byte_keys, map_batches, materialise, only_slots, slices, splitmix, text_buffer

WORDS = 5
PERCENT = 85
COORDINATES = 64
SKETCH = 512
MISSED = 5e-6
BLOCK = 1024
GROWTH = 4 * BLOCK
LONG = 16 * BLOCK
#: Classes of a long list that all others are compared with in a settling round, and how many of them, of
#: different components, each of the others is paired with.
REPRESENTATIVES = 32
PAIRED = 3
#: Settling only saves work: the exhaustive comparison that follows is right after any number of rounds.
SETTLING_ROUNDS = 3

KEYS = byte_keys(23)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_RNG = np.random.default_rng(29)
SCALE = _RNG.integers(1, 1 << 63, COORDINATES + SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _RNG.integers(0, 1 << 63, COORDINATES + SKETCH, dtype=np.uint64)
POWERS = Powers()


def least_matches(coordinates: int, same: float) -> int:
    """Largest m that fewer than m of ``coordinates`` agree with a probability of at most ``MISSED``, each with ``same``."""
    below, m = 0.0, 0
    while m < coordinates:
        below += math.comb(coordinates, m) * same ** m * (1 - same) ** (coordinates - m)
        if below > MISSED:
            break
        m += 1
    return m


def filters(percent: int) -> tuple[int, int]:
    """Least agreeing coordinates of the signature and of the sketch, whose bytes also agree by chance."""
    p = percent / 100
    return max(1, least_matches(COORDINATES, p)), least_matches(SKETCH, p + (1 - p) / 256)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    data, offsets = text_buffer(column)
    n = len(column)
    if not len(data):
        yield from (np.zeros(0, np.uint64) for _ in range(n))
        return
    space = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([True], space[:-1])) | edge[:-1]
    after = np.concatenate((space[1:], [True])) | edge[1:]
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    prefix = POWERS.prefix(KEYS[LOWER[data]])
    word = splitmix(POWERS.span(prefix, starts, ends) + (ends - starts).astype(np.uint64))
    first = np.searchsorted(starts, offsets)
    chained = word[: max(0, len(word) - WORDS + 1)]
    for k in range(1, WORDS):
        chained = splitmix(chained * np.uint64(3) + word[k: k + len(chained)])
    for i in range(n):
        a, b = first[i], first[i + 1]
        if b - a >= WORDS:
            yield np.unique(chained[a: b - WORDS + 1])
        elif b > a:
            h = word[a: a + 1]
            for k in range(a + 1, b):
                h = splitmix(h * np.uint64(3) + word[k: k + 1])
            yield h + np.uint64(b - a)
        else:
            yield word[:0]


def _minima(hashes: np.ndarray, scale: np.ndarray, shift: np.ndarray) -> np.ndarray:
    best = np.full(len(scale), np.iinfo(np.uint64).max, np.uint64)
    step = max(256, (1 << 18) // len(scale))
    for lo in range(0, len(hashes), step):
        part = hashes[lo: lo + step]
        best = np.minimum(best, (part[None, :] * scale[:, None] + shift[:, None]).min(axis=1))
    return best


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minimum of each coordinate's hash over a set, 32 bits each."""
    best = _minima(hashes, SCALE[:COORDINATES], SHIFT[:COORDINATES])
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketch(hashes: np.ndarray) -> bytes:
    """A byte of each minimum over further coordinates: unequal minima share it once in 256 times."""
    best = _minima(hashes, SCALE[COORDINATES:], SHIFT[COORDINATES:])
    return (splitmix(best) >> np.uint64(56)).astype(np.uint8).tobytes()


def digests(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set."""
    if not len(hashes):
        return 0, 0
    return int(hashes.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(splitmix(hashes)).view(np.int64))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, n, d1, d2, coordinates, sig``: set size, 128-bit set digest, signature as array and as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                size, d1, d2, sigs = [], [], [], []
                for h in shingle_sets(part.column("text")):
                    size.append(len(h))
                    x, y = digests(h)
                    d1.append(x)
                    d2.append(y)
                    sigs.append(signature(h) if len(h) else np.zeros(0, np.int32))
                values = pa.array(np.concatenate(sigs) if sigs else np.zeros(0, np.int32))
                packed = pa.array([s.tobytes() for s in sigs], pa.binary())
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sigs]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(size, pa.int64()),
                     pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), values), packed],
                    names=["doc_id", "text_hash", "n", "d1", "d2", "coordinates", "sig"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).alias("text"))
    return map_batches(rows, run, "doc_id long, text_hash long, n long, d1 long, d2 long, coordinates array<int>, sig binary")


def prefix_postings(classes: DataFrame, matches: int) -> DataFrame:
    """``element, id`` of each class's rarest elements that other classes have too."""
    exploded = classes.select("id", F.posexplode("coordinates").alias("k", "v")).select(
        "id", F.shiftleft(F.col("k").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
        .alias("element"))
    shared = exploded.groupBy("element").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    lists = (exploded.join(shared, "element").groupBy("id")
             .agg(F.sort_array(F.collect_list(F.struct("f", "element"))).alias("e")))
    # the COORDINATES - size(e) elements that no other class has are the rarest of all
    take = F.greatest(F.lit(0), COORDINATES - matches + 1 - (COORDINATES - F.size("e")))
    return lists.select("id", F.explode(F.slice("e", F.lit(1), take)).alias("s")).select("s.element", "id")


def list_sizes(postings: DataFrame) -> DataFrame:
    return postings.groupBy("element").agg(F.count(F.lit(1)).alias("f")).where("f > 1")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Add ``label``: a class's component, itself while it has no link."""
    if labels is None:
        return rows.withColumn("label", F.col("id"))
    return rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _largest_parts(long: DataFrame) -> DataFrame:
    """``element, main, rest``: the label that most members of a list have, and how many have another."""
    parts = long.groupBy("element", "label").agg(F.count(F.lit(1)).alias("c"))
    return parts.groupBy("element").agg(F.max_by("label", F.struct("c", "label")).alias("main"),
                                        (F.sum("c") - F.max("c")).alias("rest"))


def bucket_members(postings: DataFrame, labels: DataFrame | None, block: int = BLOCK) -> DataFrame:
    """``element, split, bucket, id, side``: lists of two or more classes, long ones as pairs of blocks.

    Of a long list the members outside its largest component meet each other and, block by block,
    those inside; the latter don't meet among themselves.  Lists with the same members are one, named
    by their smallest element.
    """
    rows = postings.join(list_sizes(postings), "element")
    short = rows.where(F.col("f") <= block).select("element", "id", *[F.lit(0).alias(c) for c in ("own", "lo", "hi")])
    long = materialise(_labelled(rows.where(F.col("f") > block), labels), "near-long")
    dealt = (long.join(_largest_parts(long), "element").withColumn("inside", F.col("label") == F.col("main"))
             .withColumn("outer", F.ceil(F.col("rest") / block).cast("int"))
             .withColumn("inner", F.ceil((F.col("f") - F.col("rest")) / block).cast("int")))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("inside"), F.col("inner")).otherwise(F.col("outer")).cast("long")).cast("int")
    # blocks of the others are numbered 0 .. outer - 1, those inside the largest component from outer on
    dealt = dealt.withColumn("own", F.when(F.col("inside"), F.col("outer") + own).otherwise(own)).where("rest > 0")
    met = F.when(F.col("inside"), F.sequence(F.lit(0), F.col("outer") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("outer") + F.col("inner") - 1))
    dealt = dealt.withColumn("other", F.explode(met)).select(
        "element", "id", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    pairs = short.unionByName(dealt).groupBy("element", "lo", "hi").agg(
        F.sort_array(F.collect_list(F.struct("id", F.col("own").alias("side")))).alias("members"))
    split = F.col("lo") != F.col("hi")
    lists = pairs.where(F.size("members") > 1).select(
        "element", split.alias("split"),
        F.transform("members", lambda m: F.struct(m["id"].alias("id"), (m["side"] != F.col("lo")).alias("side"))).alias("m"))
    once = lists.groupBy("split", "m").agg(F.min("element").alias("element"))
    return (once.withColumn("bucket", F.monotonically_increasing_id())
            .select("element", "split", "bucket", F.explode("m").alias("x"))
            .select("element", "split", "bucket", "x.id", "x.side"))


def unsettled(postings: DataFrame, labels: DataFrame | None, most: int = LONG) -> DataFrame:
    """``element, id, label, rest, main``: each class in its long list with the most members outside the largest component.

    Lists with at most ``most`` members outside it are settled enough.
    """
    rows = postings.join(list_sizes(postings).where(F.col("f") > most), "element")
    long = _labelled(rows, labels)
    parts = _largest_parts(long).where(F.col("rest") > most)
    worst = F.max_by(F.struct("element", "label", "rest", "main"), F.struct("rest", "element"))
    return long.join(parts, "element").groupBy("id").agg(worst.alias("w")).select("id", "w.*")


def representative_pairs(listed: DataFrame, classes: DataFrame, least: int, percent: int, round_no: int,
                         block: int = BLOCK) -> DataFrame:
    """``a, b``: each class of a long list with the representatives of it that agree most, in ``least`` coordinates at least.

    A quarter of the representatives comes from the list's largest component, the others from outside.
    """
    rows = listed.join(classes.select("id", "n", "sig"), "id")
    inside = F.col("label") == F.col("main")
    order = F.struct(F.xxhash64("id", F.lit(round_no)).alias("h"), "id", "label", "n", "sig")
    # top few per list and side, taken in each task first
    tops = []
    for side, many in ((inside, REPRESENTATIVES // 4), (~inside, REPRESENTATIVES - REPRESENTATIVES // 4)):
        place = F.row_number().over(Window.partitionBy("element").orderBy("h", "id"))
        tops.append(rows.where(side).select("element", order.alias("o")).select("element", "o.*")
                    .withColumn("place", place).where(F.col("place") <= many))
    reps = tops[0].unionByName(tops[1]).groupBy("element").agg(
        F.collect_list(F.struct("id", "label", "n", "sig")).alias("reps"))
    salts = F.ceil(F.col("rest") / block).cast("long")
    members = (rows.withColumn("salt", F.pmod(F.xxhash64("id"), salts)).groupBy("element", "salt")
               .agg(F.max(salts).alias("salts"), F.collect_list(F.struct("id", "label", "n", "sig")).alias("m")))
    groups = members.join(reps, "element").select("m", "reps")

    def columns(cells):
        ids, label, size = (cells.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        return ids, label, size, np.stack([np.frombuffer(x.as_buffer(), np.int32) for x in cells.field(3)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for i in range(batch.num_rows):
                ids, label, size, sig = columns(batch.column("m")[i].values)
                r_ids, r_label, r_size, r_sig = columns(batch.column("reps")[i].values)
                agree = np.stack([(sig == r).sum(axis=1) for r in r_sig], axis=1)
                fits = (agree >= least) & (label[:, None] != r_label[None, :])
                fits &= 100 * np.minimum(size[:, None], r_size[None, :]) >= percent * np.maximum(size[:, None], r_size[None, :])
                agree[~fits] = -1
                for _ in range(PAIRED):
                    best = agree.argmax(axis=1)
                    at = np.flatnonzero(agree[np.arange(len(ids)), best] >= 0)
                    a += np.minimum(ids[at], r_ids[best[at]]).tolist()
                    b += np.maximum(ids[at], r_ids[best[at]]).tolist()
                    agree[r_label[None, :] == r_label[best][:, None]] = -1
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return map_batches(groups, run, "a long, b long").distinct()


def _first_common(prefix: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest element in both prefixes of each pair (rows of ``prefix``, padded differently by row)."""
    out = np.empty(len(i), np.int64)
    for lo in range(0, len(i), 8192):
        x, y = prefix[i[lo: lo + 8192]], prefix[j[lo: lo + 8192]]
        both = (x[:, :, None] == y[:, None, :]).any(axis=2)
        out[lo: lo + 8192] = np.where(both, x, np.iinfo(np.int64).max).min(axis=1)
    return out


def _best_partners(ids, label, size, sig, side, split: bool, least: int, top: int, percent: int,
                   element=None, prefix=None):
    """Pairs of one list that each member names, and whether some member had more.

    With ``prefix`` a pair counts only in the list of its smallest common element, so it is
    named once however many lists it shares.
    """
    agree = np.empty((len(ids), len(ids)), np.int16)
    step = max(1, (1 << 23) // sig.size)
    for lo in range(0, len(ids), step):
        agree[lo: lo + step] = (sig[lo: lo + step, None, :] == sig[None, :, :]).sum(axis=2)
    fits = (agree >= least) & (label[:, None] != label[None, :])
    fits &= 100 * np.minimum(size[:, None], size[None, :]) >= percent * np.maximum(size[:, None], size[None, :])
    if split:
        fits &= side[:, None] != side[None, :]
    if prefix is not None:
        i, j = np.nonzero(np.triu(fits))
        mine = _first_common(prefix, i, j) == element
        fits[:] = False
        fits[i[mine], j[mine]] = fits[j[mine], i[mine]] = True
    out, more = set(), False
    for i in np.flatnonzero(fits.any(axis=1)):
        at = np.flatnonzero(fits[i])
        more |= len(at) > top
        for j in at[np.lexsort((ids[at], -agree[i, at]))[:top]]:
            out.add((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
    return out, more


def candidates(members: DataFrame, classes: DataFrame, labels: DataFrame | None, least: int, top: int,
               percent: int) -> DataFrame:
    """``a, b, more``: pairs across components that agree in ``least`` coordinates, each class's ``top`` best per list.

    ``classes``: ``id``, set size ``n`` and ``sig``, the coordinates as bytes; with a column
    ``prefix`` (the class's posted elements) every pair is named in one list only.
    """
    once = "prefix" in classes.columns
    rows = members.join(classes.select("id", "n", "sig", *(["prefix"] if once else [])), "id")
    rows = _labelled(rows, labels)
    fields = ["id", "side", "label", "n", "sig", *(["prefix"] if once else [])]
    lists = (rows.groupBy("bucket", "split", "element").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.collect_list(F.struct(*fields)).alias("m"))
        .where("lo != hi").select("split", "element", "m"))
    kind = np.uint8 if once else np.int32
    posted = COORDINATES - filters(percent)[0] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, flags = [], [], []
            for i in range(batch.num_rows):
                m = batch.column("m")[i].values
                ids, side, label, size = (m.field(k).to_numpy(zero_copy_only=False) for k in range(4))
                sig = np.stack([np.frombuffer(x.as_buffer(), kind) for x in m.field(4)])
                prefix = None
                if once:  # what a class has no element for is filled with a number of its own
                    prefix = np.repeat(-1 - np.arange(len(ids))[:, None], COORDINATES, axis=1)
                    for k, e in enumerate(m.field(5).to_pylist()):
                        prefix[k, : len(e)] = e
                    prefix = prefix[:, :posted]
                pairs, more = _best_partners(ids, label, size, sig, side, batch.column("split")[i].as_py(), least, top,
                                             percent, batch.column("element")[i].as_py(), prefix)
                for x, y in pairs:
                    a.append(x)
                    b.append(y)
                    flags.append(more)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(flags, pa.bool_())], names=["a", "b", "more"])

    return map_batches(lists, run, "a long, b long, more boolean").groupBy("a", "b").agg(F.max("more").alias("more"))


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, n, shingles, sig``: sorted shingle hashes, as bytes, and sketches of the ``wanted`` classes (id, doc, n, d1, d2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = list(shingle_sets(part.column("text")))
                d1, d2 = zip(*map(digests, sets)) if sets else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array([len(h) for h in sets], pa.int64()), pa.array(d1, pa.int64()),
                     pa.array(d2, pa.int64()), pa.array([h.tobytes() for h in sets], pa.binary()),
                     pa.array([sketch(h) for h in sets], pa.binary())],
                    names=["doc", "n", "d1", "d2", "shingles", "sig"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    named = only_slots(rows, "doc", wanted, "doc").join(wanted.select("doc").distinct(), "doc", "left_semi")
    sets = map_batches(named, run, "doc long, n long, d1 long, d2 long, shingles binary, sig binary")
    return (sets.join(wanted, ["doc", "n", "d1", "d2"]).select("id", "n", "shingles", "sig")
            .dropDuplicates(["id"]))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, linked`` decided on full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                p = np.frombuffer(x.as_buffer(), np.uint64)
                q = np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                linked.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())],
                                             names=["a", "b", "linked"])

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    return map_batches(pairs.select("a", "b").join(left, "a").join(right, "b"), run, "a long, b long, linked boolean")


def components(links: DataFrame) -> DataFrame:
    """``id, label``: the smallest id reachable over ``links`` (a, b), for the ids that have links."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = materialise(both, "near-edges")
    labels = materialise(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select(
        "id", F.least("id", "m").alias("label")), "near-labels")
    while True:
        heard = (edges.join(labels.select(F.col("id").alias("b"), F.col("label").alias("l")), "b")
                 .groupBy(F.col("a").alias("id")).agg(F.min("l").alias("heard")))
        nearer = labels.join(heard, "id").select("id", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("next"))
        moved = nearer.join(jump, "label", "left").select(
            "id", "old", F.least("label", F.coalesce("next", "label")).alias("label"))
        moved = materialise(moved, "near-labels")
        labels = moved.select("id", "label")
        if moved.where("old != label").isEmpty():
            return labels


def _check(percent: int) -> None:
    if not 1 <= percent <= 100:
        raise ValueError(f"percent must be from 1 to 100, got {percent}")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``, linked from ``percent`` similarity."""
    _check(percent)
    matches, sketch_matches = filters(percent)
    sig = materialise(signatures(docs, id_col, text_col), "near-signatures")
    return _linked(docs, sig, id_col, text_col, percent, matches, sketch_matches).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "kept")


def _linked(docs: DataFrame, sig: DataFrame, id_col: str, text_col: str, percent: int, matches: int,
            sketch_matches: int) -> DataFrame:
    """``sig`` with ``component_id`` and ``kept``."""
    spark = docs.sparkSession
    usable = sig.where("n > 0 AND doc_id IS NOT NULL")
    groups = usable.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("doc"))
    groups = materialise(groups.withColumn("id", F.monotonically_increasing_id()), "near-classes")
    classes = usable.join(groups, ["n", "d1", "d2"]).where("doc_id = doc").select(
        "id", "doc", "n", "d1", "d2", "coordinates", "sig").dropDuplicates(["id"])
    classes = materialise(classes, "near-reps")
    postings = materialise(prefix_postings(classes, matches), "near-postings")
    posted = postings.groupBy("id").agg(F.collect_list("element").alias("prefix"))
    links, labels, tested, sets = spark.createDataFrame([], "a long, b long"), None, None, None

    def decide(found: DataFrame) -> DataFrame:
        """Confirm pairs on full sets and take the links over; the decided pairs."""
        nonlocal links, labels, tested, sets
        ids = found.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        new = ids if sets is None else ids.join(sets, "id", "left_anti")
        wanted = classes.select("id", "doc", "n", "d1", "d2").join(new, "id")
        more = materialise(full_sets(docs, materialise(wanted, "near-wanted"), id_col, text_col).join(posted, "id"), "near-sets")
        sets = more if sets is None else sets.unionByName(more)
        decided = materialise(confirm(found, sets, percent), "near-confirmed")
        links = links.unionByName(decided.where("linked").select("a", "b"))
        failed = decided.where("NOT linked").select("a", "b")
        tested = failed if tested is None else tested.unionByName(failed)
        labels = components(links)
        return decided

    for round_no in range(SETTLING_ROUNDS):  # long lists first, each in work proportional to its length
        listed = materialise(unsettled(postings, labels), "near-unsettled")
        if listed.isEmpty():
            break
        found = representative_pairs(listed, classes, matches, percent, round_no)
        found = materialise(found if tested is None else found.join(tested, ["a", "b"], "left_anti"), "near-listed")
        if found.isEmpty() or decide(found).where("linked").isEmpty():
            break
    members = materialise(bucket_members(postings, labels), "near-members")
    first, top = True, 1
    while True:
        if first:
            named = candidates(members, classes, labels, matches, top, percent)
        else:
            named = candidates(members, sets, labels, sketch_matches, top, percent)
        named = materialise(named, "near-named")
        found = named if tested is None else materialise(named.join(tested, ["a", "b"], "left_anti"), "near-untested")
        more = named.agg(F.max("more").alias("more")).first()["more"]
        if not found.isEmpty():
            decide(found.select("a", "b"))
        if not more:  # every candidate outside a component has been named and tested
            break
        top *= GROWTH
        first = False
    named = classes.select("id", "doc")
    if labels is not None:
        named = _labelled(named, labels)
        smallest = named.groupBy("label").agg(F.min("doc").alias("component"))
        named = named.join(smallest, "label").select("id", "component")
    else:
        named = named.select("id", F.col("doc").alias("component"))
    joined = sig.join(groups, ["n", "d1", "d2"], "left").join(named, "id", "left")
    linkable = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linkable, F.col("component")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "text_hash", "n", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, one per component, with all their columns.

    Rows are found again by id (null too) and text, so of rows that share an id only those whose own
    text stays are kept.
    """
    _check(percent)
    sig = materialise(signatures(docs, id_col, text_col), "near-signatures")
    kept = _linked(docs, sig, id_col, text_col, percent, *filters(percent)).where("kept").select(
        F.col("doc_id").alias("_id"), "text_hash")
    same = docs[id_col].cast("long").eqNullSafe(kept["_id"]) & (F.xxhash64(docs[text_col]) == kept["text_hash"])
    return docs.join(kept, same, "left_semi")
