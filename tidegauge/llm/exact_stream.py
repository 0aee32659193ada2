"""Exact duplicates by a stateful stream.

Every document is reduced to a digest of its normalised text, an identifier and a locator of
its content. A stream keeps one state row per digest, on disk (RocksDB), without expiry:
how many rows had it and which row stays, with the place of its content. Rows whose digest was
seen before are *hits*; their full bytes are compared before they count as copies, so two
texts that only share a digest are told apart.

Contract: null text is empty; null ids sort below all others; of equal texts the row with the
largest id stays, of repeated rows with that id exactly one; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.store import checkpointed, folder, lowered, written

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One store per shuffle partition: preallocated logs would outweigh what they hold.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def run_state(inbox: DataFrame, path: str, state: str, checkpoint: str) -> DataFrame:
    """Run the stream over all files of ``path`` that ``checkpoint`` has not seen yet.

    Calling it again after more files were added goes on from the kept state; ``state`` gets
    the changed rows of every micro-batch. Counts and the row that stays only grow, so the
    largest values are the current ones.
    """
    spark = inbox.sparkSession
    before = {key: spark.conf.get(key, None) for key in ROCKSDB}
    for key, value in ROCKSDB.items():
        spark.conf.set(key, value)
    try:
        changes = (
            spark.readStream.schema(inbox.schema)
            .parquet(path)
            .groupBy("digest")
            .agg(F.count("*").alias("n"), F.max(F.struct("doc", "row", "place")).alias("keep"))
        )
        query = (
            changes.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, _: batch.write.mode("append").parquet(state))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    schema = changes.schema
    return (
        spark.read.schema(schema)
        .parquet(state)
        .groupBy("digest")
        .agg(F.max("n").alias("n"), F.max("keep").alias("keep"))
    )


def copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """One row per row of ``docs``: doc, row, n (size of its group), keep (doc and row), digest."""
    spark = docs.sparkSession
    plain = lowered(F.col(text))
    # The staged rows name each row once and for all, so that repeated rows stay apart.
    numbered = docs.select(
        F.col(key).alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        F.input_file_name().alias("place"),
        digest(plain).alias("digest"),
    )
    path = folder(spark, "inbox")
    numbered.write.parquet(path)
    inbox = spark.read.schema(numbered.schema).parquet(path)
    if inbox.isEmpty():
        return inbox.select("doc", "row", F.lit(0).cast("long").alias("n"), F.struct("doc", "row").alias("keep"), "digest")
    state = written(run_state(inbox, path, folder(spark, "state"), folder(spark, "stream")), "seen")
    rows = inbox.select("doc", "row", "digest")
    single = state.filter("n = 1").select(
        F.col("keep.doc").alias("doc"), F.col("keep.row").alias("row"), "n", F.struct("keep.doc", "keep.row").alias("keep"), "digest"
    )
    return single.unionByName(_by_bytes(docs, rows, state.filter("n > 1").select("digest", "n", "keep"), key, plain, digest))


def _by_bytes(docs: DataFrame, rows: DataFrame, hits: DataFrame, key: str, plain: Column, digest) -> DataFrame:
    """Groups of the rows whose digest was hit, by their full texts.

    Grouping by the text compares whole texts. The rows of a digest that holds a third of all
    rows are joined in pieces and merged in each task before they meet.
    """
    texts = docs.select(F.col(key).alias("doc"), plain.alias("body"))
    texts = texts.withColumn("digest", digest(F.col("body"))).join(hits.select("digest"), "digest")
    texts = written(texts.groupBy("digest", "body").agg(F.count("*").alias("size")).select("digest"), "hits")
    mixed = checkpointed(texts.groupBy("digest").agg(F.count("*").alias("kinds")).filter("kinds > 1"))
    same = rows.join(hits, "digest").select("doc", "row", "n", F.struct("keep.doc", "keep.row").alias("keep"), "digest")
    if mixed.isEmpty():
        return same
    same = same.join(mixed, "digest", "left_anti").select(same.columns)
    # Texts that differ but share a digest: their rows are numbered anew with the text at hand.
    apart = docs.select(F.col(key).alias("doc"), plain.alias("body")).withColumn("digest", digest(F.col("body")))
    apart = apart.join(mixed.select("digest"), "digest", "left_semi").withColumn("row", F.monotonically_increasing_id())
    apart = written(apart.withColumn("row", -1 - F.col("row")), "apart")
    groups = apart.groupBy("digest", "body").agg(F.count("*").alias("n"), F.max(F.struct("doc", "row")).alias("keep"))
    return same.unionByName(apart.join(groups, ["digest", "body"]).select("doc", "row", "n", "keep", "digest"))


def kept(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the copies; the columns stay as they are."""
    found = copies(docs, key, text).groupBy(F.col("doc").alias("_doc"), F.col("digest").alias("_digest"))
    pairs = found.agg(F.count("*").alias("_rows"), F.max(F.col("row") == F.col("keep.row")).alias("_stays"))
    pairs = checkpointed(pairs.filter("_rows > 1 or not _stays"))
    # Rows travel as one struct, so that no name of theirs can clash.
    marked = docs.select(F.struct(*docs.columns).alias("_whole"), F.col(key).alias("_key"), sha256(lowered(F.col(text))).alias("_of"))
    marked = marked.join(pairs, F.col("_key").eqNullSafe(F.col("_doc")) & (F.col("_of") == F.col("_digest")), "left")
    once = marked.filter("_stays is null").select("_whole.*")
    if pairs.filter("_stays").isEmpty():
        return once
    # Rows repeated with their id: one of them stays. They merge before the shuffle.
    again = marked.filter("_stays").groupBy("_doc", "_digest").agg(F.first("_whole").alias("_whole"))
    return once.unionByName(again.select("_whole.*"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts in ``documents``: which row stays, for every row."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = copies(docs)
    return found.select(
        F.col("doc").alias("doc_id"),
        F.col("keep.doc").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


SQL = f"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', '{'abcdefghijklmnopqrstuvwxyz'}')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
