"""Driver-table queries through files: scans, label and seed lists, sinks
(A1-A5, A15-A19).  Each writes tables as files into the shared folder and reads
them back with the operator."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cadenza.plans.registry import register, t
from cadenza.session import ensure_checkpoint_dir
from cadenza.sources import commits, tracks

LINE_COLUMNS = [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_partkey", "bigint"), ("l_quantity", "double"),
                ("l_extendedprice", "double"), ("l_returnflag", "string"), ("l_linestatus", "string")]


def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("csv_scan", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice END AS l_extendedprice,
       CASE WHEN l_linenumber % 3 <> 0 THEN l_returnflag END AS l_returnflag, l_linestatus FROM lineitem
""")
def csv_scan(spark, sf):
    """Files of two layouts (turned order, a missing and a further column, empty
    first fields) in one scan."""
    li = t(spark, sf, "lineitem").withColumn("l_returnflag", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_returnflag")))
    names = ["l_returnflag", *[n for n, _ in LINE_COLUMNS if n != "l_returnflag"]]
    path = _folder(spark, "csv-scan")
    write = lambda df, cols: tracks.write_tracks(df, path, fmt="csv", mode="append", columns=cols)
    write(li.filter("l_linenumber % 2 = 0"), names)
    write(li.filter("l_linenumber % 2 = 1"), [*[n for n in reversed(names) if n != "l_extendedprice"], "l_tax"])
    return tracks.read_tracks(spark, path, columns=LINE_COLUMNS, drop_columns=()).drop("file_name", "row_ord")


@register("label_file", """
WITH x AS (SELECT lower(n_name) AS artist_key, r_name AS genre FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT artist_key, genre FROM x
""")
def label_file(spark, sf):
    """Label list written and read; of two rows of a name the last counts."""
    rows = t(spark, sf, "nation").join(t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_name", "r_name")
    both = rows.select(F.lower("n_name").alias("artist_name"), F.lit("N/A").alias("genre"), F.lit(0).alias("o")).unionByName(
        rows.select(F.col("n_name").alias("artist_name"), F.col("r_name").alias("genre"), F.lit(1).alias("o")))
    path = _folder(spark, "labels")
    both.repartition(1).sortWithinPartitions("o").drop("o").write.option("header", True).csv(path)  # 50 rows
    return tracks.label_lookup_table(spark, path).select("artist_key", "genre")


@register("first_artist_files", """
WITH f AS (SELECT o_custkey AS file, arg_min(o_orderpriority, o_orderkey) AS artist FROM orders GROUP BY 1),
w AS (SELECT artist, max(lpad(CAST(file AS VARCHAR), 12, '0')) AS file_name FROM f GROUP BY artist)
SELECT w.artist, w.file_name, o.o_orderkey FROM w JOIN orders o ON lpad(CAST(o.o_custkey AS VARCHAR), 12, '0') = w.file_name
""")
def first_artist_files(spark, sf):
    rows = t(spark, sf, "orders").select(F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("file_name"),
                                         F.col("o_orderpriority").alias("artist_name"), F.col("o_orderkey").alias("row_ord"))
    return tracks.tracks_by_first_artist(rows).select("artist", "file_name", F.col("row_ord").alias("o_orderkey"))


@register("seed_list", """
SELECT p_brand AS subgenre, 'x' || CAST(p_partkey AS VARCHAR) AS playlist_id FROM part
""")
def seed_list(spark, sf):
    path = _folder(spark, "seeds")
    t(spark, sf, "part").select(
        F.col("p_brand").alias("subgenre"),
        F.concat(F.lit(" https://open.example.com/playlist/x"), "p_partkey", F.lit("?si=1")).alias("playlist_url")
    ).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return tracks.read_seeds(spark, path)


@register("sink_modes", """
SELECT c_mktsegment AS genre, CAST(2 * count(*) AS BIGINT) AS n_appended, count(*) AS n_overwritten, 16 AS n_columns
FROM customer GROUP BY c_mktsegment
""")
def sink_modes(spark, sf):
    """Overwrite, append and the labelled sink with its fixed columns."""
    c = t(spark, sf, "customer").select(
        F.col("c_name").alias("track_name"), F.col("c_custkey").cast("string").alias("track_id"),
        F.lit("1991").alias("artist_name"), F.lit("al").alias("album_name"), F.col("c_mktsegment").alias("genre"),
        *[F.lit(1).cast(kind).alias(n) for n, kind in tracks.TRACK_COLUMNS[4:]])
    labelled, over, more = (_folder(spark, x) for x in ("labelled", "over", "append"))
    tracks.write_labelled(c, labelled)
    tracks.write_tracks(c, more, partition_by=["genre"])
    tracks.write_tracks(c, more, mode="append", partition_by=["genre"])
    tracks.write_tracks(c, over)
    tracks.write_tracks(c, over)
    assert not tracks.write_tracks(c.limit(0), over)
    back = tracks.read_tracks(spark, labelled, columns=tracks.LABELLED_COLUMNS, drop_columns=()).drop("file_name", "row_ord")
    n = len(back.columns)
    counts = [spark.read.parquet(more).groupBy("genre").agg(F.count(F.lit(1)).alias("n_appended")),
              spark.read.parquet(over).groupBy("genre").agg(F.count(F.lit(1)).alias("n_overwritten"))]
    return back.select("genre").distinct().join(counts[0], "genre").join(counts[1], "genre").withColumn("n_columns", F.lit(n))


@register("csv_breaks", """
SELECT doc_id, lang, length(text) AS n_chars, md5(text) AS digest FROM documents
""")
def csv_breaks(spark, sf):
    """Whole texts with their line breaks written as quoted CSV fields and read
    back split by split."""
    path = _folder(spark, "csv-breaks")
    (t(spark, sf, "documents").select("lang", "text", "doc_id").write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path))
    got = tracks.read_tracks(spark, path, columns=[("doc_id", "bigint"), ("lang", "string"), ("text", "string")], drop_columns=())
    return got.select("doc_id", "lang", F.length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest"))


@register("sink_commits", """
WITH x AS (SELECT 'appended' AS state, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'replaced', o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'P')
SELECT state, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM x GROUP BY ALL
""")
def sink_commits(spark, sf):
    """Committed writes: two appends, one of them repeated with its id, a write
    that stopped before its commit, and an overwrite of another table."""
    orders = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    one, two = _folder(spark, "commit-append"), _folder(spark, "commit-replace")
    for write_id, status in (("f", "F"), ("o", "O"), ("f", "F")):
        commits.write(orders.filter(F.col("o_orderstatus") == status), one, write_id)
    orders.write.parquet(f"{one}/data/stopped-before-its-commit")
    commits.write(orders, two, "all", partition_by=["o_orderstatus"])
    commits.write(orders.filter("o_orderstatus = 'P'"), two, "p", mode="overwrite")
    both = commits.read(spark, one).withColumn("state", F.lit("appended")).unionByName(
        commits.read(spark, two).withColumn("state", F.lit("replaced")))
    return both.groupBy("state", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
