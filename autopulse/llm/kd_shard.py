"""Sharding by a k-d tree: recursive splits at distributed weighted medians of the widest dimension.

A node that shall yield k leaves is split at the weighted quantile floor(k/2)/k of its widest
dimension (spread relative to the whole table), so every leaf ends near total / shards bytes.
All nodes of a level are split together: a round counts bytes in at most ``BINS`` bins per
node, keeps the bin that holds the quantile and divides it again, down to one value or a
weight below the tolerance; rows of one value are divided by identifier the same way.  So a
source that holds a third of all rows is split like any other.  Only bin totals (at most
DRIVER_NODES x BINS rows, whatever the input) reach the driver; the tree is then one expression over
each row's own metadata, and placing rows needs no shuffle.

A shard count that follows from target bytes grows with the data.  The driver's tree stops at
``DRIVER_NODES`` nodes; each is split on in its own group, all groups of a level at once, at the row
where the running size passes the quantile (a sort by group, dimension and identifier, so a task
holds no group in memory).

Law: ``bytes``.  The identifier's slot in its shard comes from per-chunk counts and a running
sum over chunks, never from a window over a whole shard.

Defined cases: null metadata sorts first; a null text has size 16 and checksum 0; a very long text is
one row of its size; rows that agree in every dimension and the id stay together in the driver's
tree; with fewer rows than shards some shards stay
empty; an empty table gives an empty result; equal texts may lie in different shards, as bytes
near equality asks of a large group of copies.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from autopulse.llm.common import MIN_LONG, materialise

BINS = 1024
TOLERANCE = 0.0005
CHUNK_ROWS = 20_000
DRIVER_NODES = 64


@dataclass
class Node:
    first: int
    leaves: int
    dim: str | None = None
    cut: tuple[int, int] | None = None
    left: Node | None = None
    right: Node | None = None
    search: dict = field(default_factory=dict)

    def expr(self, leaf) -> Column:
        if self.cut is None:
            return leaf(self)
        value, tie = self.cut
        goes = (F.col(self.dim) < value) | ((F.col(self.dim) == value) & (F.col("tie") < tie))
        return F.when(goes, self.left.expr(leaf)).otherwise(self.right.expr(leaf))

    def frontier(self) -> list[Node]:
        if self.cut is None:
            return [self]
        return self.left.frontier() + self.right.frontier()


def metadata(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             categories: tuple[str, ...] = ("lang", "source"), numbers: tuple[str, ...] = ("n_chars",)) -> DataFrame:
    """One narrow row per document: id, size, checksum and integer dimensions ``d_*``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    dims = [F.crc32(F.col(c).cast("string").cast("binary")) for c in categories if c in docs.columns]
    dims += [F.col(c).cast("long") for c in numbers if c in docs.columns]
    dims += [F.octet_length(text).cast("long")]
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(MIN_LONG)).alias("tie"),
                       *[F.coalesce(d, F.lit(-1)).cast("long").alias(f"d_{i}") for i, d in enumerate(dims)])


def _bins(rows: DataFrame, nodes: list[Node]) -> dict[int, list]:
    """Bytes per bin of each searching node; at most ``BINS`` rows for a node."""
    def pick(node: Node) -> Column:
        s = node.search
        if not s or "done" in s:
            return F.lit(None).cast("struct<node:int,bin:int,v:bigint>")
        v = F.col("tie") if s["ties"] else F.col(node.dim)
        inside = v.between(s["lo"], s["hi"])
        if s["ties"]:
            inside = inside & (F.col(node.dim) == s["value"])
        span = float(s["hi"] - s["lo"]) + 1.0
        bin_ = F.least(F.floor((v.cast("double") - float(s["lo"])) / span * BINS), F.lit(BINS - 1)).cast("int")
        return F.when(inside, F.struct(F.lit(node.first).alias("node"), bin_.alias("bin"), v.alias("v")))
    root = nodes[0].search["root"]
    out: dict[int, list] = {}
    found = rows.select("size", root.expr(pick).alias("b")).where("b IS NOT NULL")
    for r in found.groupBy("b.node", "b.bin").agg(F.sum("size").alias("w"), F.min("b.v").alias("lo"),
                                                  F.max("b.v").alias("hi")).collect():
        out.setdefault(r["node"], []).append((r["bin"], r["w"], r["lo"], r["hi"]))
    return {k: sorted(v) for k, v in out.items()}


def _narrow(node: Node, bins: list, limit: float) -> None:
    """Keep the bin that holds the quantile, or settle the cut."""
    s = node.search
    below = s["below"]
    for _, w, lo, hi in bins:
        if below + w >= s["goal"]:
            break
        below += w
    s["below"] = below
    if lo == hi and not s["ties"] and w > limit:
        s.update(ties=True, value=lo, lo=MIN_LONG, hi=(1 << 63) - 1)
        s["fresh"] = True
    elif lo == hi or w <= limit:
        upper = below + w - s["goal"] < s["goal"] - below
        edge = hi + 1 if upper else lo
        s["done"] = (s["value"], min(edge, (1 << 63) - 1)) if s["ties"] else (edge, MIN_LONG)
    else:
        s.update(lo=lo, hi=hi)


def _dims(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c.startswith("d_")] + ["tie"]


def grow_tree(rows: DataFrame, shards: int, most: int = DRIVER_NODES) -> tuple[Node, dict[str, float]]:
    """The k-d tree over narrow metadata rows (``size``, ``tie``, ``d_*``) to ``most`` nodes, and the table's extent by dimension."""
    dims = _dims(rows)
    root = Node(0, shards)
    whole: dict[str, float] = {}
    limit = 0.0
    while True:
        frontier = root.frontier()
        nodes = [n for n in frontier if n.leaves > 1]
        if not nodes or len(frontier) >= most:
            return root, whole
        at = rows.withColumn("node", root.expr(lambda n: F.lit(n.first)))
        stats = {r["node"]: r for r in at.groupBy("node").agg(
            F.sum("size").alias("w"), *[f(c).alias(f"{f.__name__}_{c}") for c in dims for f in (F.min, F.max)]).collect()}
        if not whole:
            if not stats:
                return root, whole
            whole = {c: max(1.0, float(stats[0][f"max_{c}"]) - float(stats[0][f"min_{c}"])) for c in dims}
            limit = TOLERANCE * stats[0]["w"] / shards
        active = []
        for n in nodes:
            if n.first not in stats:  # no rows: an empty subtree
                n.leaves = 1
                continue
            r = stats[n.first]
            spread = {c: (float(r[f"max_{c}"]) - float(r[f"min_{c}"])) / whole[c] for c in dims}
            n.dim = max(dims, key=lambda c: (spread[c], -dims.index(c)))
            half = n.leaves // 2
            n.search = {"root": root, "goal": r["w"] * half / n.leaves, "below": 0, "ties": False, "value": None,
                        "lo": r[f"min_{n.dim}"], "hi": r[f"max_{n.dim}"]}
            active.append(n)
        if not active:
            return root, whole
        while pending := [n for n in active if "done" not in n.search]:
            got = _bins(rows, pending)
            for n in pending:
                _narrow(n, got[n.first], limit)
        for n in active:
            half = n.leaves // 2
            n.cut = n.search["done"]
            n.left, n.right, n.search = Node(n.first, half), Node(n.first + half, n.leaves - half), {}


def split_groups(rows: DataFrame, whole: dict[str, float]) -> DataFrame:
    """Split every node (``shard``: its first leaf, ``leaves``) down to single leaves, level by level."""
    dims, node = _dims(rows), Window.partitionBy("shard")
    while rows.where("leaves > 1").limit(1).count():
        spread = [(F.max(c).over(node).cast("double") - F.min(c).over(node).cast("double")) / whole[c] for c in dims]
        rows = rows.withColumns({f"_s{i}": x for i, x in enumerate(spread)})
        widest = F.greatest(*[F.col(f"_s{i}") for i in range(len(dims))])
        value = F.coalesce(*[F.when(F.col(f"_s{i}") == widest, F.col(c)) for i, c in enumerate(dims)])
        rows = rows.withColumn("_v", value)
        upto = F.sum("size").over(node.orderBy("_v", "tie", "text_crc32").rowsBetween(Window.unboundedPreceding, 0))
        half = F.floor(F.col("leaves") / 2).cast("int")
        # a row goes left if its middle does not lie beyond the quantile
        left = (upto - F.col("size") / 2) * F.col("leaves") <= F.sum("size").over(node) * half
        rows = rows.withColumns({"_left": left, "_half": half}).withColumns({
            "shard": F.when((F.col("leaves") > 1) & ~F.col("_left"), F.col("shard") + F.col("_half")).otherwise(F.col("shard")),
            "leaves": F.when(F.col("leaves") <= 1, F.col("leaves")).when(F.col("_left"), F.col("_half"))
            .otherwise(F.col("leaves") - F.col("_half"))})
        rows = materialise(rows.drop("_v", "_left", "_half", *[f"_s{i}" for i in range(len(dims))]), "kd-level")
    return rows


def number_rows(rows: DataFrame, chunks: int) -> DataFrame:
    """``slot`` within each shard, gapless from 0."""
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("tie"), F.lit(chunks)).cast("int"))
    counts = rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n")
    starts = counts.select("shard", "chunk", before.alias("start"))
    local = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("tie", "text_crc32"))
    return rows.join(starts, ["shard", "chunk"]).withColumn("slot", (F.col("start") + local - 1).cast("long"))


def kd_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
              target_bytes: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``; ``target_bytes`` derives the shard count."""
    rows = materialise(metadata(docs, id_col, text_col), "kd-metadata")
    total = rows.agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n")).first()
    if target_bytes:
        shards = max(1, -(-(total["w"] or 0) // target_bytes))
    tree, whole = grow_tree(rows, shards)
    placed = rows.withColumn("shard", tree.expr(lambda n: F.lit(n.first)).cast("int"))
    if any(n.leaves > 1 for n in tree.frontier()):
        leaves = tree.expr(lambda n: F.lit(n.leaves)).cast("int")
        placed = split_groups(materialise(placed.withColumn("leaves", leaves), "kd-nodes"), whole)
    chunks = max(1, -(-total["n"] // (shards * CHUNK_ROWS)))
    return number_rows(placed, chunks).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
