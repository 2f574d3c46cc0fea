"""Exact deduplication by a streaming query with keyed state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tarnkit.llm.keyfilter import key_bits, with_maybe
from tarnkit.session import scratch_folder

WHITE_SPACE = " \t\n\x0b\x0c\r"

#: State lives in RocksDB on the executors' disks, with a bounded share of memory, and is saved with the checkpoint.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # or every state partition would set aside several MB of disk before it holds anything
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """A text without its white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def digest(text: Column) -> Column:
    # never null, so that no join has it computed once more to filter nulls out
    return F.coalesce(F.sha2(normalised(text), 256), F.lit(""))


def _candidate(text: Column, doc_id: Column) -> Column:
    """Orders rows by which should stay: most code points, then smallest id, null ids last."""
    return F.struct(
        F.coalesce(F.length(text), F.lit(0)).alias("n_chars"),
        doc_id.isNotNull().alias("has_id"),
        (-doc_id).alias("minus_id"),
    )


def digest_state(
    spark: SparkSession,
    path: str,
    text: str = "text",
    doc_id: str = "doc_id",
    digest_of: Callable[[Column], Column] = digest,
    max_bytes_per_batch: int = 64 << 30,
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """Stream the table at ``path`` through keyed state; returns what the state holds at the end.

    Per digest: keep_id (of the row that stays), locator (file and row where its content is) and n (rows). State never expires, so a text is recognised however late it comes; it holds no
    text. Every micro-batch appends the digests it touched to a table in the shared folder, and the
    last entry of a digest counts. A lost executor's state is rebuilt from the checkpoint.
    """
    path = path.rstrip("/")
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    root = scratch_folder(spark, "exact-dedup")
    schema = spark.read.parquet(path).select(text, doc_id).schema
    reader = spark.readStream.schema(T.StructType(schema.fields))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_batch)
    content = F.col(text).cast("string")
    # as a pattern that matches just this path: a stream takes a plain path for a folder, and it may be one file
    rows = reader.parquet(f"{path[:-1]}[{path[-1]}]").select(
        digest_of(content).alias("digest"),
        F.struct(
            _candidate(content, F.col(doc_id).cast("bigint")).alias("rank"),
            _locator().alias("locator"),
        ).alias("entry"),
    )
    state = rows.groupBy("digest").agg(F.max("entry").alias("entry"), F.count(F.lit(1)).alias("n"))

    batches: list[int] = []

    def keep(batch: DataFrame, batch_id: int) -> None:
        batches.append(batch_id)
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{root}/state/{batch_id:08d}")

    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        query = (
            state.writeStream.outputMode("update").foreachBatch(keep).trigger(availableNow=True)
            .option("checkpointLocation", f"{root}/checkpoint").start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    kept = T.StructType([*state.schema.fields, T.StructField("batch", T.IntegerType())])
    if not batches:
        last = spark.createDataFrame([], kept)
    else:
        last = spark.read.schema(kept).parquet(f"{root}/state/*")
    if len(set(batches)) > 1:
        # stored, so that joins with it shuffle it plainly and adaptive execution can split their hot keys
        newest = last.groupBy("digest").agg(F.max_by(F.struct("entry", "n"), "batch").alias("last"))
        newest.select("digest", "last.entry", "last.n").write.parquet(f"{root}/last")
        last = spark.read.schema(state.schema).parquet(f"{root}/last")
    return last.select(
        "digest", (-F.col("entry.rank.minus_id")).alias("keep_id"), F.col("entry.locator").alias("locator"), "n"
    )


def exact_dedup(
    spark: SparkSession,
    path: str,
    text: str = "text",
    doc_id: str = "doc_id",
    digest_of: Callable[[Column], Column] = digest,
    **stream_options,
) -> DataFrame:
    """Groups of equal texts in the Parquet table at ``path``: doc_id, digest, keep_id, group_size, kept, one row per row.

    Texts are equal when the same without white space; null counts as empty. Of a group the row with the most code
    points stays, then the smallest doc_id (null last), then one of the repeated rows. State is keyed by
    digest (:func:`digest_state`). Wherever a digest has several rows their full bytes are compared with those of the
    row that stays, which the state's locator names; digests that different texts share are grouped anew by the
    texts themselves. An empty table gives no rows; further columns are not read.
    """
    state = digest_state(spark, path, text, doc_id, digest_of, **stream_options)
    content = F.col(f"`{text}`").cast("string")
    key = F.xxhash64("digest")
    rows = spark.read.parquet(path).select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        digest_of(content).alias("digest"),
        normalised(content).alias("content"),
        F.coalesce(F.length(content), F.lit(0)).alias("n_chars"),
        _locator().alias("row"),
    )
    # digests are computed once more here and kept, with the content of the rows that may share one: a bounded filter
    # of the digests with several rows leaves out most of the others
    flagged = with_maybe(rows, key, key_bits(state.filter("n > 1"), key), "hit")
    held = flagged.select("doc_id", "digest", "n_chars", "row", F.when(F.col("hit"), F.col("content")).alias("content"))
    folder = scratch_folder(spark, "digests")
    held.write.parquet(folder)
    held = spark.read.schema(held.schema).parquet(folder)
    shared = _shared_digests(spark, held.filter("content IS NOT NULL"), state)
    found = held.select("doc_id", "digest", "row").join(state, "digest")
    if shared is not None:
        found = found.join(shared, "digest", "left_anti")
    result = found.select("doc_id", "digest", "keep_id", F.col("n").alias("group_size"), F.expr("row <=> locator").alias("kept"))
    if shared is None:
        return result
    same = W.partitionBy("digest", "content")
    order = same.orderBy(F.desc("n_chars"), F.asc_nulls_last("doc_id"), "row")
    anew = held.join(shared, "digest", "left_semi").select(
        "doc_id",
        "digest",
        F.first("doc_id").over(order).alias("keep_id"),
        F.count(F.lit(1)).over(same).alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"),
    )
    return result.unionByName(anew)


def _shared_digests(spark: SparkSession, rows: DataFrame, state: DataFrame) -> DataFrame | None:
    """Digests under which there are different texts, or None: every hit's bytes are compared.

    A digest with more than a thousandth of all rows is spread over salts; there are fewer than a thousand such
    digests, so their list can be broadcast.
    """
    hits = state.filter("n > 1")
    total = state.agg(F.sum("n")).first()[0] or 0
    parts = F.expr(f"cast(n * 1000 div {max(total, 1)} as int)")
    salted = hits.withColumn("parts", parts)
    hot = F.broadcast(salted.filter("parts > 0").select("digest", "parts"))
    members = (
        rows.select("digest", "content", "row")
        .join(hot, "digest", "left")
        .withColumn("salt", F.coalesce(F.expr("cast(pmod(xxhash64(row), parts + 1) as int)"), F.lit(0)))
        .drop("parts")
    )
    entries = salted.select("digest", "locator", "parts", F.explode(F.expr("sequence(0, parts)")).alias("salt"))
    placed = members.join(entries, ["digest", "salt"])
    stays = placed.filter("row <=> locator").select(
        "digest", F.col("content").alias("kept_content"), F.explode(F.expr("sequence(0, parts)")).alias("salt")
    )
    differ = placed.join(stays, ["digest", "salt"]).filter("content != kept_content").select("digest").distinct()
    folder = scratch_folder(spark, "shared-digests")
    differ.write.parquet(folder)
    differ = spark.read.schema(differ.schema).parquet(folder)
    return None if differ.isEmpty() else differ


def _locator() -> Column:
    return F.struct("_metadata.file_path", "_metadata.row_index")
