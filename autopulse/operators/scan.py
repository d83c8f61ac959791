"""Ordered per-key scans that stay parallel when one key holds a large share of the rows.

A running value per key (position, running sum, length of the current run) is
normally a window ``partitionBy(key).orderBy(seq)``, which puts every row of a key
in one task.  Here a key with many rows is cut into chunks of consecutive rows:

0. the input is written once to the shared scratch folder, so a costly parse runs once;
   everything below reads that copy;
1. rows are counted per key; a key above the bound is cut at approximate quantiles of its
   order (a mergeable sketch per key, partial in each task), and chunks that still hold too
   many rows are counted and cut again;
2. a local window per (key, chunk) computes chunk-local running values;
3. a per-chunk summary (row count, sum, last reset position) is aggregated;
4. a window over the chunk summaries of each key turns them into offsets carried in
   from earlier chunks;
5. the offsets join back on (key, chunk), already the partitioning of step 2.

Bounds, for any input: a key is cut above ``bound = max(chunk_size, rows / MAX_CHUNKS)`` rows
and no chunk keeps more than ``2 * bound``.  Cuts follow ranks, not values: one wrong stamp
far away, or times that cluster, change nothing.  Where all rows of a chunk share the first
order column, the next one cuts it.  At most ``MAX_CHUNKS`` keys are cut, at about
``2 * MAX_CHUNKS`` places (the one broadcast, of values fixed on the driver, so a task that
runs again cuts alike).  The carry table has at most keys + 2 * rows / chunk_size rows.

The order must be unique within a key (ties would make positions ambiguous, and rows that
share all order columns cannot be cut).  A NULL key is a key of its own; a NULL order value
comes before all others, NaN after them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, IntegralType, NumericType, TimestampNTZType, TimestampType

from autopulse.functions import wall_clock_micros
from autopulse.session import scratch_table

DEFAULT_CHUNK = 1 << 16
MAX_CHUNKS = 100_000
#: A chunk is cut into so many at once; the next round cuts further.
FAN = 64
ROUNDS = 9  # (FAN + 2) ** ROUNDS fits a long
#: Sketch entries over all cut keys of a task; a few hot keys get exact cuts from it.
SKETCH_ENTRIES = 100_000


def order_position(df: DataFrame, seq: str) -> Column:
    """The order column as a number, non-decreasing in it: the value of ids, microseconds of times."""
    dt = df.schema[seq].dataType
    c = F.col(seq)
    if isinstance(dt, (IntegralType, BooleanType)):
        return c.cast("bigint")
    if isinstance(dt, NumericType):
        return c.cast("double")
    if isinstance(dt, TimestampType):
        return F.unix_micros(c)
    if isinstance(dt, TimestampNTZType):
        return wall_clock_micros(c)
    raise TypeError(f"order column {seq} must be a number or a timestamp, got {dt}")


def _orderable(dt: DataType) -> bool:
    return isinstance(dt, (NumericType, BooleanType, TimestampType, TimestampNTZType))


def _side(pos: Column) -> Column:
    """0: NULL or -inf, 2: inf or NaN, which no quantile separates; 1: all between."""
    d = pos.cast("double")
    return F.when(pos.isNull() | (d == float("-inf")), 0).when(d >= float("inf"), 2).otherwise(1)


def _distance(pos: Column, low: Column) -> Column:
    """How far ``pos`` lies above ``low``: exact for whole numbers that are near, rounded for others."""
    return F.coalesce(F.try_subtract(pos, low).cast("double"), pos.cast("double") - low.cast("double"))


def _same(keys: Sequence[str]) -> Column:
    pairs = [F.col(k).eqNullSafe(F.col(f"_cut_{i}")) for i, k in enumerate(keys)]
    return reduce(Column.__and__, [*pairs, F.col("_chunk") == F.col("_cut_chunk")])


def _split(rows: DataFrame, keys: Sequence[str], wide: list, places: list[Column], bound: int) -> DataFrame | None:
    """Cut the chunks of ``wide`` (key, chunk, rows and extent of each) at quantiles; None if none can be cut."""
    spark = rows.sparkSession
    specs = []
    for r in wide:
        for i in range(len(places)):
            if r[f"side_lo_{i}"] < r[f"side_hi_{i}"] or r[f"lo_{i}"] is not None and r[f"lo_{i}"] < r[f"hi_{i}"]:
                lows = [r[f"lo_{j}"] if j == i else None for j in range(len(places))]
                specs.append((*[r[k] for k in keys], r["_chunk"], i, min(FAN, -(-r["n"] // bound)), *lows))
                break
    if not specs:
        return None
    kinds = rows.select(*[p.alias(f"_low_{i}") for i, p in enumerate(places)]).schema
    names = [f"_cut_{i} {rows.schema[k].dataType.simpleString()}" for i, k in enumerate(keys)]
    names += ["_cut_chunk long", "_by int", "_pieces int"]
    names += [f"{f.name} {f.dataType.simpleString()}" for f in kinds]
    wanted = spark.createDataFrame(specs, ", ".join(names))
    by = [f"_cut_{i}" for i in range(len(keys))] + ["_cut_chunk"]

    def chosen(make) -> Column:
        return F.coalesce(*[F.when(F.col("_by") == i, make(p, F.col(f"_low_{i}"))) for i, p in enumerate(places)])

    side, away = chosen(lambda p, low: _side(p)), chosen(_distance)
    inside = rows.join(F.broadcast(wanted), _same(keys)).withColumns({"_side": side, "_away": away}).where("_side = 1")
    accuracy = max(16 * FAN, SKETCH_ENTRIES // len(specs))
    sketches = [F.percentile_approx(F.when(F.col("_pieces") == p, F.col("_away")), [i / p for i in range(1, p)], accuracy)
                for p in sorted({s[len(keys) + 2] for s in specs})]
    cuts = inside.groupBy(*by).agg(F.coalesce(*sketches).alias("_cuts")).collect()
    found = {tuple(r[b] for b in by): sorted(set(r["_cuts"])) for r in cuts if r["_cuts"]}
    fixed = spark.createDataFrame([(*s, found.get(tuple(s[: len(by)]), [])) for s in specs],
                                  ", ".join([*names, "_cuts array<double>"]))
    piece = (F.when(F.col("_cut_chunk").isNull() | (side == 0), 0).when(side == 2, FAN + 1)
             .otherwise(1 + F.size(F.filter("_cuts", lambda c: c < away))))
    added = fixed.columns
    return (rows.join(F.broadcast(fixed), _same(keys), "left")
            .withColumn("_chunk", (F.col("_chunk") * (FAN + 2) + piece).cast("long")).drop(*added))


def with_chunks(df: DataFrame, keys: Sequence[str], seq: str | Sequence[str], chunk_size: int) -> DataFrame:
    """Add `_chunk`, non-decreasing in ``seq`` within a key: about ``chunk_size`` rows of a hot key each.

    Runs a count per key, and a sketch and a count per round over the hot keys' rows.
    """
    order = [seq] if isinstance(seq, str) else list(seq)
    order_position(df, order[0])  # the first column must be one that can be cut
    places = [order_position(df, c) for c in order if _orderable(df.schema[c].dataType)]
    rows = df.withColumn("_chunk", F.lit(0).cast("long"))
    extent = []
    for i, p in enumerate(places):
        finite = F.when(_side(p) == 1, p)
        extent += [F.min(_side(p)).alias(f"side_lo_{i}"), F.max(_side(p)).alias(f"side_hi_{i}"),
                   F.min(finite).alias(f"lo_{i}"), F.max(finite).alias(f"hi_{i}")]
    bound = max(chunk_size, -(-df.count() // MAX_CHUNKS))
    hot = None
    for step in range(ROUNDS):
        watched = rows
        if hot is not None:  # chunks of other keys are small: only rows of the keys cut so far are counted again
            same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)], F.lit(True))
            watched = rows.join(F.broadcast(hot), same, "left_semi")
        sizes = watched.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("n"), *extent)
        # at most MAX_CHUNKS rows: each stands for more than rows / MAX_CHUNKS
        wide = sizes.where(F.col("n") > (bound if step == 0 else 2 * bound)).collect()
        cut = _split(rows, keys, wide, places, bound) if wide else None
        if cut is None:
            break
        rows = cut
        if hot is None and keys:
            kinds = ", ".join(f"_hot_{i} {df.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
            hot = df.sparkSession.createDataFrame(list({tuple(r[k] for k in keys) for r in wide}), kinds)
    return rows


def ordered_scan(df: DataFrame, keys: Sequence[str], seq: str | Sequence[str], *, sum_of: Column | None = None,
                 reset_when: Column | None = None, chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """Add `_pos` (1-based position per key), and optionally `_sum` (running sum of ``sum_of``)
    and `_run` (rows since the last row where ``reset_when`` held; 0 on such rows).

    ``seq`` is the order: one column, or several (e.g. a time and a tie-breaking id).  The input
    runs once, when this is called: its columns are written to the shared scratch folder.
    """
    keys = list(keys)
    order = [seq] if isinstance(seq, str) else list(seq)
    base = with_chunks(scratch_table(df, "scan-input"), keys, order, chunk_size)
    if keys:
        # a struct equals another with the same NULL fields: NULL keys meet their carries below
        base = base.withColumn("_key", F.struct(*keys)).drop(*keys)
    by = ["_key"] if keys else []
    part = by + ["_chunk"]
    # one shuffle for the local windows and the summaries: what they need is derived above it, so
    # both read the same columns from it
    base = base.repartition(*part)
    if keys:
        base = base.withColumns({k: F.col("_key").getField(k) for k in keys})
    if sum_of is not None:
        base = base.withColumn("_x", sum_of)
    if reset_when is not None:
        base = base.withColumn("_reset", F.coalesce(reset_when, F.lit(False)))
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = base.withColumn("_lpos", F.count(F.lit(1)).over(w))
    if sum_of is not None:
        local = local.withColumn("_lsum", F.sum("_x").over(w))
    if reset_when is not None:
        local = local.withColumn("_lreset", F.max(F.when(F.col("_reset"), F.col("_lpos"))).over(w))

    summary_aggs = [F.count(F.lit(1)).alias("_n")]
    if sum_of is not None:
        summary_aggs.append(F.sum("_x").alias("_s"))
    if reset_when is not None:
        # the last reset position needs the local window
        summary_aggs.append(F.max("_lreset").alias("_r"))
        summary = local.groupBy(*part).agg(*summary_aggs)
    else:
        # counts and sums are plain aggregates of the input: no second sort, and the
        # input shuffle (same partitioning as the window's) is reused
        summary = base.groupBy(*part).agg(*summary_aggs)
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    cols = ["_off"]
    if sum_of is not None:
        carry = carry.withColumn("_soff", F.sum("_s").over(before))
        cols.append("_soff")
    if reset_when is not None:
        carry = carry.withColumn("_rprev", F.max(F.col("_off") + F.col("_r")).over(before))
        cols.append("_rprev")
    # Every (key, chunk) of `local` has its carry row.  A left join keeps the result and,
    # unlike an inner join, infers no extra filter on `local`, so both uses of `local`
    # stay identical plans and AQE shuffles the input once (ReusedExchange).
    out = local.join(carry.select(*part, *cols), part, "left")
    out = out.withColumn("_pos", F.col("_off") + F.col("_lpos"))
    if sum_of is not None:
        out = out.withColumn("_sum", F.coalesce(F.col("_soff"), F.lit(0)) + F.col("_lsum"))
    if reset_when is not None:
        last_reset = F.greatest(F.coalesce(F.col("_off") + F.col("_lreset"), F.lit(0)),
                                F.coalesce(F.col("_rprev"), F.lit(0)))
        out = out.withColumn("_run", F.when(F.col("_reset"), F.lit(0)).otherwise(F.col("_pos") - last_reset))
    added = ["_pos"] + (["_sum"] if sum_of is not None else []) + (["_run"] if reset_when is not None else [])
    return out.select(*df.columns, *added)
