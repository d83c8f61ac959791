"""Exact deduplication as a stateful stream: keyed state on disk, never expired, bytes checked on hits.

Every document becomes an arrival (digest of the normalised text, code points, identifier,
content locator) in an append-only Parquet log.  A Structured Streaming query groups the log
by digest; its state lives in RocksDB under the shared checkpoint folder, has no watermark
and so never forgets a digest, and keeps per digest the group's size and its best arrival:
most code points, then smallest id.  Partial aggregation before the shuffle makes a hot digest
one row per task.  On a hit the whole normalised texts are compared with the kept row's, in
salted groups of bounded size; texts that share a digest but not their bytes (never seen with
SHA-256, forced in the tests) are grouped again by their full text.

Defined cases: a null text counts as empty; empty texts are equal to each other; ties go to
the smallest id, a null id loses to any other; of repeated rows with one id and text, the first
arrival is kept, and rows with one id and different texts are judged apart; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from autopulse.llm.common import materialise, only_slots
from autopulse.session import scratch_dir

SPACES = " \t\n\x0b\x0c\r"
RESULT = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
SALT_ROWS = 1024
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # a store is open only while its task runs: native memory doesn't grow with the partitions
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalise(text: Column) -> Column:
    """The text without any character of ``[\\x20\\x09-\\x0D]`` (null: empty)."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def arrivals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The arrival log: narrow rows, no texts.  ``arrival`` numbers the rows; ``file`` locates the content."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = normalise(F.col(text_col))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), digest(norm).alias("digest"),
                       sha256(norm).alias("text_sha256"), F.length(text).cast("long").alias("points"),
                       F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("arrival"))


def retain(spark: SparkSession, log: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Run the stateful query over an arrival log to its end; one row per digest."""
    session = spark.newSession()
    width = "spark.sql.shuffle.partitions"  # a new session starts from the defaults
    for k, v in {**STATE, width: spark.conf.get(width)}.items():
        session.conf.set(k, v)
    out, checkpoint = scratch_dir(spark, "dedup-state"), scratch_dir(spark, "dedup-checkpoint")
    reader = session.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    order = F.struct("points", (-F.col("doc_id")).alias("neg_id"), (-F.col("arrival")).alias("neg_arrival"),
                     "file")
    state = reader.parquet(log).groupBy("digest").agg(F.max(order).alias("best"), F.count(F.lit(1)).alias("n"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    query = (state.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    empty = spark.createDataFrame([], state.schema)
    read = spark.read.schema(state.schema)
    written = spark._jvm.org.apache.hadoop.fs.Path(out)
    exists = written.getFileSystem(spark._jsc.hadoopConfiguration()).exists(written)
    updates = read.parquet(out).select("digest", "best", "n") if exists else empty
    last = updates.groupBy("digest").agg(F.max(F.struct("n", "best")).alias("s"))
    return last.select("digest", F.col("s.n").alias("n"), (-F.col("s.best.neg_id")).alias("keep_id"),
                       (-F.col("s.best.neg_arrival")).alias("keep_arrival"), F.col("s.best.file").alias("keep_file"))


def _hits(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str,
          digest: Callable[[Column], Column]) -> DataFrame:
    """Rows of digests that came more than once, with their texts; others are mostly not shuffled."""
    norm = normalise(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm"), digest(norm).alias("digest"),
                       F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("points"))
    return only_slots(rows, "digest", groups, "digest").join(groups.select("digest", "keep_id", "n"), "digest")


def _differing(hits: DataFrame) -> DataFrame:
    """Digests of which some text is not, byte for byte, the kept row's text."""
    salts = F.ceil(F.col("n") / SALT_ROWS).cast("int")
    keepers = (hits.where("doc_id <=> keep_id").groupBy("digest")
               .agg(F.min("norm").alias("kept_norm"), F.max(salts).alias("salts"))
               .select("digest", "kept_norm", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    salted = hits.withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts.cast("long")).cast("int"))
    return (salted.join(keepers, ["digest", "salt"]).where(F.col("norm") != F.col("kept_norm"))
            .select("digest").distinct())


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "llm-arrivals")
    frame = arrivals(docs, id_col, text_col, digest)
    frame.write.parquet(path)
    log = spark.read.schema(frame.schema).parquet(path)
    groups = materialise(retain(spark, path, frame.schema, files_per_batch), "dedup-groups")
    hits = materialise(_hits(docs, groups.where("n > 1"), id_col, text_col, digest), "dedup-hits")
    differing = materialise(_differing(hits), "dedup-differing")
    plain = log.join(groups, "digest").select(
        "doc_id", "keep_id", F.col("n").alias("group_size"),
        (F.col("arrival") == F.col("keep_arrival")).alias("kept"), "text_sha256", "digest")
    if differing.isEmpty():
        return plain.select(*RESULT)
    again = hits.join(differing, "digest", "left_semi")
    by_text = again.groupBy("digest", "norm").agg(
        F.max(F.struct("points", (-F.col("doc_id")).alias("neg_id"))).alias("best"),
        F.count(F.lit(1)).alias("group_size"))
    regrouped = (again.join(by_text, ["digest", "norm"])
                 .withColumn("keep_id", -F.col("best.neg_id"))
                 .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         sha256(F.col("norm")).alias("text_sha256")))
    return plain.join(differing, "digest", "left_anti").select(*RESULT).unionByName(regrouped)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct text, with all their columns.

    Kept rows are found again by identifier (null too) and text digest together, so rows that
    share an id but not their text are judged apart; of a kept row's repetitions the one with the
    most code points stays, then the first.
    """
    def key(ident: Column, sha: Column) -> Column:  # no number's text is empty, so a null id has a key of its own
        return F.concat_ws(":", sha, F.coalesce(ident.cast("long").cast("string"), F.lit("")))

    result = exact_dedup(docs, id_col, text_col).where("kept").select(
        key(F.col("doc_id"), F.col("text_sha256")).alias("_key"))
    rows = docs.select(
        key(F.col(id_col), sha256(normalise(F.col(text_col)))).alias("_key"), F.struct(*docs.columns).alias("_row"),
        F.struct(F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("points"),
                 (-F.monotonically_increasing_id()).alias("neg_arrival")).alias("_order"))
    kept = rows.join(result, "_key", "left_semi").groupBy("_key").agg(F.max_by("_row", "_order").alias("_row"))
    return kept.select("_row.*")
