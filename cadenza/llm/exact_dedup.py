"""Exact deduplication with a keyed streaming state that never expires.

Every document becomes one record: digest of its normalised text, length,
stable identifier and content locator.  The records flow through a Structured
Streaming aggregation whose state is kept on disk (RocksDB state store, shared
checkpoint folder): one entry per digest with the retained record and the
number of rows seen.  There is no watermark, so nothing expires and a later
batch meets the texts of all earlier ones.  Where a digest was hit more than
once the full bytes decide: rows of such digests are grouped by the normalised
text itself, copies collapsing before the shuffle.  Digests that turn out to
hold different texts are split by text.

Everything runs as DataFrame / SQL operations in the JVM.

Defined cases: a null text counts as empty; texts of white space alone are
equal to the empty text; of equal texts the row with the most code points,
then the smallest id (null last) stays; of wholly repeated rows one stays; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import anti, possibly, saved, semi, tables, work_path

#: State on disk; without preallocation, which takes megabytes of every small
#: state partition before it holds a row, and with a small write buffer, which
#: every partition's store has in memory.
STATE = {"spark.sql.streaming.stateStore.providerClass":
         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
         "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8"}
RECORD = "digest binary, n_points long, doc_id long, row_key long, locator string"


@contextmanager
def on_disk(spark: SparkSession):
    """The session's state settings while the state is written or read."""
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: str | Column) -> Column:
    """The text without ASCII white space.  Six plain replacements: each is one
    scan for a single byte, several times faster than a regular expression."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    for white in (" ", "\n", "\t", "\r", "\v", "\f"):
        c = F.replace(c, F.lit(white), F.lit(""))
    return c


def digest(text: str | Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def locator(docs: DataFrame) -> Column:
    """Where a row's content lies: its file; empty for rows of several sources."""
    try:
        docs.select(F.input_file_name())
    except AnalysisException:
        return F.lit("")
    return F.input_file_name()


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One small record per document; the text itself is not carried."""
    return tables(docs, doc_id=id_col, text=text_col).select(
        digest("text").alias("digest"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_points"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row_key"),
        locator(docs).alias("locator"))


def ingest(spark: SparkSession, feed: str, checkpoint: str, files_per_batch: int = 10_000) -> None:
    """Run all record files that are new in ``feed`` through the keyed state in
    ``checkpoint``.  Calling it again after more files arrived goes on from the
    retained state; a failed run is repeated from the checkpoint."""
    with on_disk(spark):
        seen = (spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files_per_batch).parquet(feed)
                .groupBy("digest").agg(
                    F.min(F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("no_id"),
                                   "doc_id", "row_key", "locator")).alias("best"),
                    F.count(F.lit(1)).alias("group_size")))
        query = (seen.writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()


def retained(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state as a table: digest, retained record, rows seen."""
    state = spark.read.format("statestore").load(checkpoint)
    best, seen = [F.col(f"value.`{f.name}`") for f in state.schema["value"].dataType.fields]
    return state.select(F.col("key.digest").alias("digest"), best["doc_id"].alias("keep_id"),
                        best["row_key"].alias("keep_row"), best["locator"].alias("keep_locator"),
                        seen.alias("group_size"))


def collisions(docs: DataFrame, hits: DataFrame, text_col: str = "text") -> DataFrame:
    """Digests, among those hit more than once, under which full texts differ.

    A bounded key filter keeps the texts of other digests from travelling."""
    both = possibly(tables(docs, text=text_col).select(digest("text").alias("digest"), normalised("text").alias("full")),
                    hits.select("digest"), "digest").filter("__maybe")
    return (both.groupBy("digest", "full").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256,
    n_points, keep_locator."""
    spark = docs.sparkSession
    feed, checkpoint = work_path(spark, "dedup-feed"), work_path(spark, "dedup-state")
    records(docs, id_col, text_col).write.parquet(feed)
    ingest(spark, feed, checkpoint)
    own = spark.read.schema(RECORD).parquet(feed)
    with on_disk(spark):
        hits = saved(retained(spark, checkpoint).filter("group_size > 1"), "dedup-hits")
    split = saved(collisions(docs, hits, text_col), "dedup-split")

    # a digest without a second row needs no partner: the left join leaves it
    # to itself, and only the groups' records travel
    plain = own.join(hits, "digest", "left").join(split, "digest", "left_anti").select(
        "digest", "n_points", "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | (F.col("row_key") == F.col("keep_row"))).alias("kept"),
        F.coalesce("keep_locator", "locator").alias("keep_locator"))

    # equal digests of different texts: the same decision per full text
    texts = tables(docs, doc_id=id_col, text=text_col).select(
        digest("text").alias("digest"), normalised("text").alias("full"),
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row_key"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_points"),
        locator(docs).alias("locator"))
    texts = semi(texts, split, "digest")
    best = texts.groupBy("digest", "full").agg(
        F.min(F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("no_id"),
                       "doc_id", "row_key", "locator")).alias("best"),
        F.count(F.lit(1)).cast("long").alias("group_size"))
    apart = texts.join(best, ["digest", "full"]).select(
        "digest", "n_points", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row_key") == F.col("best.row_key")).alias("kept"), F.col("best.locator").alias("keep_locator"))
    return plain.unionByName(apart).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"),
        "n_points", "keep_locator")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    found = saved(exact_dedup(docs, id_col, text_col), "dedup-found")
    key = ["__id", "__sha", "__n"]
    rows = docs.withColumns({
        "__id": F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")),
        "__sha": F.lower(F.hex(digest(F.col(f"`{text_col}`")))),
        "__n": F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("long")})
    marks = found.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("__id"),
                         F.col("text_sha256").alias("__sha"), F.col("n_points").alias("__n"), "kept")
    # only what goes is joined: rows dropped, and rows repeated under one id
    per = marks.groupBy(*key).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    odd = saved(per.filter("not kept or rows > 1"), "dedup-odd")
    rows = rows.withColumn("__key", F.concat_ws("/", *key))
    odd = odd.withColumn("__key", F.concat_ws("/", *key))
    stay = anti(rows, odd.select("__key"), "__key")
    repeated = semi(rows, odd.filter("kept").select("__key"), "__key").dropDuplicates(["__key"])
    return stay.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
             row_number() OVER w AS rn, length(t) AS n_points FROM d
      WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id))
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, rn = 1 AS kept, sha256(norm) AS text_sha256,
       CAST(n_points AS BIGINT) AS n_points FROM g
"""
