"""Exact deduplication as a stateful stream, in DataFrame operations only.

The stream of arrivals (digest, stable id, place of the content) is folded into keyed state on disk
(RocksDB, in the shared folder, no watermark, so nothing expires). The state holds for each digest the
stable id and the place of the row that stays, and the number of rows. Where a digest was hit more than
once, the whole texts are read again and compared byte for byte; should two texts share a digest, they are
told apart by their bytes.

Defined results: null text counts as empty; of equal texts the largest id stays (nulls lowest), of rows
that repeat an id the one stored last (by file and position); exactly one row of a group stays. An empty
table gives an empty result. Other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crownframe.llm.shared import FILE, ROW, bounded, fresh_folder, located, whole_text, without
from crownframe.session import cut

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",     # and its memory
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "96",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",   # many small stores share a disk
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def arrivals(docs: DataFrame, digest: Callable[[Column], Column] = sha256, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One thin row per document of a located table: id, digest, file and position."""
    return docs.select(F.col(id_col).alias("doc_id"), digest(whole_text(text_col)).alias("digest"),
                       F.col(FILE).alias("file"), F.col(ROW).alias("row"))


def fold(stream: DataFrame) -> DataFrame:
    """Keyed state over a stream (or table) of arrivals: the row that stays, and the number of rows."""
    return stream.groupBy("digest").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))


def run_stream(spark: SparkSession, stream: DataFrame, state_dir: str) -> None:
    """Take in all that has arrived; a later call with the same folder goes on from there."""
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    try:
        for k, v in STATE_SETTINGS.items():
            spark.conf.set(k, v)
        query = (fold(stream).writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", state_dir).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_state(spark: SparkSession, state_dir: str) -> DataFrame:
    """The state as it stands: digest, keep (doc_id, file, row), n."""
    store = spark.read.format("statestore").load(state_dir)
    buffers = store.schema["value"].dataType.names
    return store.select(F.col("key.digest").alias("digest"), F.col(f"value.`{buffers[0]}`").alias("keep"),
                        F.col(f"value.`{buffers[1]}`").alias("n"))


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256, id_col: str = "doc_id",
                 text_col: str = "text", bytes_per_batch: int = 4 << 30) -> DataFrame:
    """One row per row of a located table: doc_id, file, row, digest, keep (doc_id, file, row), n."""
    spark = docs.sparkSession
    seen = cut(arrivals(docs, digest, id_col, text_col), "arrivals")
    state_dir = fresh_folder(spark, "dedup-state")
    stream = (spark.readStream.schema(seen.schema).option("maxBytesPerTrigger", str(bytes_per_batch))
              .parquet(_folder_of(seen))) if not seen.isEmpty() else None
    if stream is None:
        return seen.select("*", F.struct("doc_id", "file", "row").alias("keep"),
                           F.lit(0).cast("long").alias("n"))
    run_stream(spark, stream, state_dir)
    state = cut(read_state(spark, state_dir), "state")

    hits = state.filter("n > 1").select("digest")
    texts = docs.select(digest(whole_text(text_col)).alias("digest"), whole_text(text_col).alias("text"))
    hit_texts = texts.join(bounded(hits, 100), "digest", "left_semi")
    clashes = cut(hit_texts.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"))
                  .groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1"), "clashes")
    if clashes.isEmpty():
        return seen.join(state, "digest", "left").select(*seen.columns, "keep", "n")

    rows = docs.select(F.col(id_col).alias("doc_id"), digest(whole_text(text_col)).alias("digest"),
                       F.col(FILE).alias("file"), F.col(ROW).alias("row"),
                       whole_text(text_col).alias("text")).join(clashes, "digest", "left_semi")
    apart = rows.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))
    told = rows.join(apart, ["digest", "text"]).select(*seen.columns, "keep", "n")
    rest = seen.join(clashes, "digest", "left_anti").join(state, "digest", "left")
    return rest.select(*seen.columns, "keep", "n").unionByName(told)


def _folder_of(written: DataFrame) -> str:
    return written.inputFiles()[0].rpartition("/")[0]


def _kept() -> Column:
    return (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256."""
    groups = exact_groups(located(docs), id_col=id_col, text_col=text_col)
    return groups.select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                         _kept().alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    at = located(docs)
    gone = exact_groups(at, id_col=id_col, text_col=text_col).filter(~_kept())
    return without(at, gone.select(F.col("file").alias(FILE), F.col("row").alias(ROW)))
