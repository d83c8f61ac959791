"""Importance resampling, BPE and centroid clustering against brute-force versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from autopulse.llm import bpe, catalog, centroids, decontam, importance, kd_shard, near_dup, packing
from test_llm_operators import SCHEMA, SF, brute_components, hard_rows, prose

LETTERS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(3)


# --- op11 -----------------------------------------------------------------------------------

def brute_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LETTERS))
    return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute_resample(docs, bench, buckets=10_000, percent=5, min_words=20):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in brute_features(t)[1])
    t = Counter(bucket(f) for x in bench for f in brute_features(x)[1])
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in range(buckets)]
    rows, fit = [], []
    for i, text in docs:
        words, features = brute_features(text)
        weight = sum(gain[bucket(f)] for f in features)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(features), weight, score, None])
        if len(words) >= min_words:
            fit.append(rows[-1])
    fit.sort(key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=repr)


def resampled(docs, bench, **options):
    out = importance.importance_resample(docs, bench, **options)
    return sorted((tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_resampling_equals_brute_force(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute_resample(texts_of(docs), [r["text"] for r in bench.collect()])
    query = catalog.QUERIES["op11_importance_resampling"](spark, SF)
    assert sorted((tuple(r) for r in query.collect()), key=repr) == want
    assert sum(r[4] is not None for r in want) >= 5


@pytest.mark.parametrize("options", [{}, {"percent": 40, "min_words": 3, "buckets": 97}, {"percent": 100, "min_words": 0}])
def test_resampling_hard_cases(spark, hard, options):
    targets = [prose(np.random.default_rng(9), 50), None, "", "日本語 ÉCOLE école"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(targets)], "doc_id long, text string")
    got = resampled(hard, bench, **options)
    assert got == brute_resample(texts_of(hard), targets, **options)
    kept = [r[4] for r in got if r[4]]
    assert sorted(kept) == list(range(1, len(kept) + 1))


def test_resampling_empty_sides(spark, hard):
    none = hard.limit(0)
    assert resampled(none, hard) == []
    assert resampled(hard, none, percent=50) == brute_resample(texts_of(hard), [], percent=50)


def test_resampling_null_and_repeated_ids(spark):
    rng = np.random.default_rng(11)
    rows = [(None, prose(rng, 30)), (None, None), (3, prose(rng, 30)), (3, prose(rng, 30)), (4, "x"), (-2, prose(rng, 25))]
    rows += [rows[2]] * 50
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = importance.importance_resample(frame, frame, percent=50).collect()
    assert len(got) == len(rows)
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert ranks == list(range(1, 50 * sum(len((t or "").split()) >= 20 for _, t in rows) // 100 + 1))


@given(st.lists(st.text(alphabet="abZ éß日01-,. \x00\x7f", max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_features_of_any_text(texts):
    f = importance.Features(pa.array(texts, pa.string()))
    want = [brute_features(t) for t in texts]
    assert list(f.n_words) == [len(w) for w, _ in want] and list(f.n_features) == [len(x) for _, x in want]
    counts = Counter(zlib.crc32(x.encode()) % 101 for _, xs in want for x in xs)
    assert f.counts(101).tolist() == [counts[b] for b in range(101)]
    gains = np.arange(101) - 50
    assert f.weights(gains).tolist() == [sum(zlib.crc32(x.encode()) % 101 - 50 for x in xs) for _, xs in want]


@given(st.binary(max_size=300), st.binary(max_size=300))
@settings(max_examples=100, deadline=None)
def test_joined_crc(a, b):
    got = importance.joined_crc(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)]))
    assert int(got[0]) == zlib.crc32(a + b)


# --- op12 -----------------------------------------------------------------------------------

def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_path())


def library_rows(docs):
    exact = library()
    out = []
    for i, t in docs:
        ids = exact.encode(t or "", add_special_tokens=False).ids
        text = exact.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_bpe_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = catalog.QUERIES["op12_backtracking_bpe"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == library_rows(texts_of(docs))


def test_bpe_hard_cases(spark, hard):
    more = ["<|startoftext|>Hi<|endoftext|> <|EndOfText|>", "ΑΣ Σ ΑΣΑ İstanbul", "a b　c\x85d\x1ce f", "é ́x",
            "it's IT'S 'Ss don't'", "1234 ½²", "\x00\x7f\x1f", "ab" * 4000 + "'ll", "\U0001F600" * 50, " \n\t"]
    extra = spark.createDataFrame([(5000 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    docs = hard.select("doc_id", "text").unionByName(extra)
    coded = bpe.encode(docs)
    got = bpe.decode(coded.withColumn("decoded", F.lit("clash")))
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    rows = [(r["doc_id"], r["n_tokens"], hashlib.sha256(r["ids"]).hexdigest(), hashlib.sha256(r["decoded"].encode()).hexdigest())
            for r in got.collect()]
    assert sorted(rows, key=repr) == library_rows(texts_of(docs))
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0
    odd = spark.createDataFrame([(1, None), (2, np.array([49406, 70000, 320], "<u4").tobytes())], "doc_id long, ids binary")
    assert sorted(r["decoded"] for r in bpe.decode(odd).collect()) == ["", "<|startoftext|> a</w>"]


def merged_in_order(merges, word):
    """BPE as its definition has it: the earliest merge present, leftmost first, until none is left."""
    out = [merges.names.index(s if ord(s) < bpe.FINAL else chr(ord(s) - bpe.FINAL) + merges.suffix) for s in word]
    while True:
        found = [(merges.pairs[p], k) for k, p in enumerate(zip(out, out[1:])) if p in merges.pairs]
        if not found:
            return out
        made, k = min(found)
        out[k:k + 2] = [made]


@given(st.data())
@settings(max_examples=150, deadline=None)
def test_backtracking_equals_merging_for_any_vocabulary(data):
    """Random merge lists, those with products that merging never leaves alone included."""
    names, merges = list("abc"), []
    for _ in range(data.draw(st.integers(0, 12))):
        a, b = data.draw(st.sampled_from(names)), data.draw(st.sampled_from(names))
        if a + b not in names:
            names.append(a + b)
            merges.append([a, b])
    spec = {"model": {"type": "BPE", "vocab": {n: i for i, n in enumerate(names)}, "merges": merges}}
    table = bpe.Merges(spec)
    encoder = bpe.Encoder(table)
    for word in data.draw(st.lists(st.text(alphabet="abc", min_size=1, max_size=24), min_size=1, max_size=8)):
        assert encoder.encode(word) == merged_in_order(table, word)


def test_long_word_takes_linear_time():
    t = bpe.tokenizer(bpe.default_path())
    word = "".join(np.random.default_rng(4).choice(list("aeinrstlo"), 200_000))
    ids = t.merges.ids[t.encoder.encode(word[:-1] + chr(ord(word[-1]) + bpe.FINAL))].tolist()
    assert ids == library().encode(word, add_special_tokens=False).ids


def test_files_of_other_kinds_are_refused():
    with pytest.raises(ValueError):
        bpe.Merges({"model": {"type": "BPE", "vocab": {"a": 0}, "merges": [], "byte_fallback": True}})
    with pytest.raises(ValueError):
        bpe.Merges({"model": {"type": "BPE", "vocab": {"a": 0, "aa": 1, "aaa": 2}, "merges": [["a", "a"], ["aa", "a"], ["a", "aa"]]}})


# --- op13 -----------------------------------------------------------------------------------

def brute_clusters(rows, k, rounds, dim, scale=256):
    kept = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _, v in order[:k]]
    if not centers:
        return []

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[place(v)[1]].append(v)
        centers = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centers)]
    placed = [(i, *place(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in placed:
        inertia[c] += d
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest())
                   for i, c, d in placed), key=repr)


def clustered(frame, **options):
    return sorted((tuple(r) for r in centroids.centroid_clusters(frame, **options).collect()), key=repr)


VECTORS = "vec_id long, embedding array<double>, v array<int>, cluster string, d int"


def hard_vectors():
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=4) + 3 * (i % 3)).tolist()) for i in range(120)]
    rows += [(1000 + i, [1.0, -1.0, 0.001, -0.001]) for i in range(90)]  # one hot vector
    rows += [(2000, [0.0] * 4), (2001, None), (2002, []), (2003, [1.0] * 3), (2004, [1.0, None, 1.0, 1.0]),
             (2005, [float("nan")] * 4), (2006, [float("inf"), 1.0, 1.0, 1.0]), (None, [9.0] * 4), (None, [-9.0] * 4),
             (7, [100.0, -131072.0, 5.0, 131072.0 - 1 / 256]), (7, [1.0] * 4), (2007, [-1 / 512] * 4)]
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, [1], "x", 2) for i, v in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("k,rounds,pivots", [(6, 4, 3), (40, 5, 8), (1, 2, 8), (500, 1, 1)])
def test_clusters_equal_brute_force(spark, k, rounds, pivots):
    rows = hard_vectors()
    got = clustered(frame_of(spark, rows), clusters=k, rounds=rounds, dimensions=4, n_pivots=pivots)
    assert got == brute_clusters(rows, k, rounds, 4)


def test_clusters_empty_and_unusable(spark):
    rows = hard_vectors()
    assert clustered(frame_of(spark, rows).limit(0), dimensions=4) == []
    assert clustered(frame_of(spark, rows), dimensions=64) == []
    with pytest.raises(Exception, match="lies beyond"):
        clustered(frame_of(spark, [(1, [1e30, 0.0])]), dimensions=2)


def test_cluster_query_equals_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = duckdb.sql(catalog.SQL["op13_laesa_clusters"])
    got = catalog.QUERIES["op13_laesa_clusters"](spark, SF).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_pivots_skip_centroids_and_lose_none():
    rng = np.random.default_rng(12)
    centers = rng.integers(-500, 500, (40, 8))
    v = centers[rng.integers(0, 40, 3000)] + rng.integers(-60, 60, (3000, 8))
    pivots = centroids.choose_pivots(v[:400], 40, 5, 40)
    cluster, distance, evaluated = centroids.nearest(v, centroids.pivot_distances(v, pivots), centers,
                                                     centroids.pivot_distances(centers, pivots))
    full = ((v[:, None, :] - centers[None]) ** 2).sum(2)
    assert (cluster == full.argmin(1)).all() and (distance == full.min(1)).all()
    assert evaluated < 0.25 * full.size


# --- op3: the search against bounds and exact packings ---------------------------------------

def fewest_bins(lengths, capacity):
    """Exact by branch and bound, for a dozen items."""
    order, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(order):
            best[0] = len(rooms)
            return
        for room in sorted({r for r in rooms if r >= order[k]}):
            rest = list(rooms)
            rest.remove(room)
            place(k + 1, [*rest, room - order[k]])
        place(k + 1, [*rooms, capacity - order[k]])
    place(0, [])
    return best[0]


def searched(lengths, capacity, epochs=6):
    elite = None
    for e in range(epochs):
        elite = packing.evolve(lengths, [elite] if elite else [], capacity, e)
    bins = packing.decode(elite)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= capacity for b in bins)
    return len(bins)


def test_lower_bound_never_exceeds_an_exact_packing_and_search_finds_it():
    rng = np.random.default_rng(21)
    met = 0
    for _ in range(40):
        lengths = rng.integers(200, 1400, 11).tolist()
        exact = fewest_bins(lengths, 2048)
        assert packing.lower_bound(lengths, 2048) <= exact <= searched(lengths, 2048)
        met += searched(lengths, 2048) == exact
    assert met >= 38
    assert packing.lower_bound([], 2048) == 0 and packing.lower_bound([1025] * 7, 2048) == 7


@pytest.mark.parametrize("low,high", [(300, 900), (500, 800)])
def test_search_beats_best_fit_where_that_misses_the_bound(low, high):
    lengths = np.random.default_rng(0).integers(low, high + 1, 800).tolist()
    falling = np.argsort(-np.array(lengths), kind="stable").tolist()
    plain = len(packing.best_fit(falling, lengths, 2048, [], []))
    assert packing.lower_bound(lengths, 2048) <= searched(lengths, 2048, 3) < plain


def test_rounds_go_on_over_loose_sequences(spark):
    """Small blocks leave loose sequences; dealt anew they end near the whole table's bound."""
    rng = np.random.default_rng(2)
    lengths = rng.integers(100, 900, 3000).tolist()
    pieces = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id long, length long").repartition(4)
    rows = packing.pack(pieces, 2048, block_items=150).collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert len(rows) == len(lengths) and Counter(r["length"] for r in rows) == Counter(lengths)
    for b in bins.values():
        end = 0
        for offset, length in sorted(b):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(bins) <= 1.01 * packing.lower_bound(lengths, 2048) + 1


# --- op8: long lists ---------------------------------------------------------------------------

@pytest.mark.parametrize("f", [2_000, 8_000, 32_000])
def test_a_settled_family_takes_rows_in_proportion(spark, f):
    """All but a few members of a long list are one component: the rows to compare grow with the list."""
    postings = spark.range(f).select(F.lit(7).cast("long").alias("element"), "id")
    labels = spark.range(f).where("id % 1000 <> 3").select("id", F.lit(0).cast("long").alias("label"))
    members = near_dup.bucket_members(postings, labels)
    assert members.count() <= 2 * f + f // 1000 * (f // 1024 + 2)
    assert near_dup.unsettled(postings, labels).count() == 0
    # every pair with a member outside the component meets in some block
    outside = {i for i in range(f) if i % 1000 == 3}
    met = defaultdict(set)
    for r in members.groupBy("bucket").agg(F.collect_list("id").alias("ids")).collect():
        for i in outside & set(r["ids"]):
            met[i] |= set(r["ids"])
    assert all(len(met[i]) == f for i in outside)


def test_many_families_in_one_list(spark, monkeypatch):
    """Three families share a passage; representatives settle them, the result is brute force's."""
    for long_list in (near_dup.bucket_members, near_dup.unsettled, near_dup.representative_pairs):
        monkeypatch.setattr(long_list, "__defaults__", (12,))
    monkeypatch.setattr(near_dup, "REPRESENTATIVES", 4)
    rng = np.random.default_rng(19)
    shared, rows = prose(rng, 70), []
    for k in range(3):
        own = prose(rng, 50).split()
        for i in range(40):
            words = list(own)
            for _ in range(int(rng.integers(0, 3))):
                words[int(rng.integers(0, 50))] = f"v{rng.integers(0, 10 ** 6)}"
            rows.append((100 * k + i, shared + " " + " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(docs).collect()}
    assert got == brute_components(rows)


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    rng = np.random.default_rng(5)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows = [(5, a), (5, b), (1, a), (9, b + " end"), (7, c), (7, c), (3, None), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(docs).collect())
    assert got == Counter([(5, 1, False), (5, 5, True), (1, 1, True), (9, 5, False), (7, 7, True), (7, 7, True),
                           (3, 3, True), (None, None, True)])
    kept = Counter((r["doc_id"], r["text"]) for r in near_dup.keep_one(docs).collect())
    assert kept == Counter([(5, b), (1, a), (7, c), (7, c), (3, None), (None, a)])


# --- op5: many index shards --------------------------------------------------------------------

def test_many_shards_take_one_scan(spark, monkeypatch):
    bench, docs = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("benchmark", "documents"))
    bench = bench.unionByName(bench.selectExpr("item_id + 1000 AS item_id", "concat(text, ' and more') AS text"))
    def named(found):  # how many passages an item is found in follows from the longest item of its shard
        return sorted((r["doc_id"], r["item_id"]) for r in found.collect())

    whole = named(decontam.contaminated(docs, bench))
    monkeypatch.setattr(decontam.index_shards, "__defaults__", ("item_id", "text", 400))
    assert decontam.index_shards(bench).count() >= 20
    found = decontam.contaminated(docs, bench)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert named(found) == whole and whole
    monkeypatch.setattr(decontam.index_groups, "__defaults__", (1,))   # a group each
    assert named(decontam.contaminated(docs, bench)) == whole
    left = {r["doc_id"] for r in decontam.drop_contaminated(docs, bench).select("doc_id").collect()}
    assert left == {r["doc_id"] for r in docs.select("doc_id").collect()} - {w[0] for w in whole}


# --- op1: the tree against a brute k-d tree, and many leaves ------------------------------------

def brute_tree(rows, shards, dims, whole):
    """Leaf of each row by sorting whole nodes; rows: (id, size, {dim: value})."""
    out = {}

    def split(part, first, leaves):
        if leaves == 1 or not part:
            out.update({r[0]: first for r in part})
            return
        spread = {c: (max(r[2][c] for r in part) - min(r[2][c] for r in part)) / whole[c] for c in dims}
        dim = max(dims, key=lambda c: (spread[c], -dims.index(c)))
        part = sorted(part, key=lambda r: (r[2][dim], r[2]["tie"]))
        half, total, below = leaves // 2, sum(r[1] for r in part), 0
        goal = total * half / leaves
        for k, r in enumerate(part):
            if below + r[1] >= goal:
                break
            below += r[1]
        cut = k + 1 if below + r[1] - goal < goal - below else k
        split(part[:cut], first, half)
        split(part[cut:], first + half, leaves - half)
    split(rows, 0, shards)
    return out


@pytest.mark.parametrize("shards", [2, 7, 40])
def test_tree_equals_a_brute_tree(spark, shards):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    meta = kd_shard.metadata(docs)
    dims = kd_shard._dims(meta)
    rows = [(r["doc_id"], r["size"], {c: r[c] for c in dims}) for r in meta.collect()]
    whole = {c: max(1.0, float(max(r[2][c] for r in rows) - min(r[2][c] for r in rows))) for c in dims}
    got = {r["doc_id"]: r["shard"] for r in kd_shard.kd_shards(docs, shards).collect()}
    assert got == brute_tree(rows, shards, dims, whole)


def test_ten_thousand_leaves_from_target_bytes(spark):
    rows = spark.range(40_000).selectExpr("id AS doc_id", "repeat('x', 40 + cast(id % 7 AS int)) AS text",
                                          "if(id % 3 = 0, 'hot', cast(id % 100 AS string)) AS source")
    total = rows.selectExpr("sum(octet_length(text) + 16)").first()[0]
    placed = kd_shard.kd_shards(rows, target_bytes=total // 10_000)
    size = Counter()
    slots = defaultdict(list)
    for r in placed.select("shard", "size", "slot").collect():
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    leaves = -(-total // (total // 10_000))
    assert leaves >= 10_000 and len(size) == leaves == max(size) + 1
    assert max(size.values()) <= 2.2 * total / leaves      # four rows a leaf: one row more or less at each cut
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_groups_split_like_the_tree(spark, monkeypatch):
    """Splitting on in groups gives leaves as near equal as the driver's tree."""
    docs = spark.range(3_000).selectExpr("id AS doc_id", "repeat('y', cast(id * 7919 % 211 AS int)) AS text", "'s' AS source")
    monkeypatch.setattr(kd_shard.grow_tree, "__defaults__", (4,))
    size = Counter()
    for r in kd_shard.kd_shards(docs, 40).select("shard", "size").collect():
        size[r["shard"]] += r["size"]
    assert sorted(size) == list(range(40)) and max(size.values()) < 1.03 * min(size.values())


# --- pipeline: nulls, repeated rows, an empty table, columns with clashing names -----------------

@pytest.mark.parametrize("which", ["hard", "empty"])
def test_pipeline_stages_on_hard_and_empty_tables(spark, hard, which):
    import corpus_pipeline
    from autopulse.llm.common import materialise

    docs = hard.withColumns({"label": F.lit("x"), "kept": F.lit(True), "item_id": F.lit(1), "text_hash": F.lit("t")})
    docs = docs.unionByName(docs.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    docs = materialise(docs if which == "hard" else docs.limit(0), "test-hard")
    n, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SF), f"test-{name}")
        if name == "best_fit_packing":
            pieces = out.groupBy("doc_id").count().count()
            assert pieces == docs.select("doc_id").distinct().count()
            break
        assert out.columns == columns and out.count() <= docs.count()
        assert out.exceptAll(docs).count() == 0     # rows are kept or dropped, never changed
        docs = out
    if which == "hard":
        assert 0.4 * n < docs.count() < n           # copies and near copies went
        texts = [r["text"] for r in docs.select("text").collect()]
        assert len(texts) == len(set(texts)) and sum(not (t or "").strip() for t in texts) == 1
    else:
        assert docs.count() == 0
