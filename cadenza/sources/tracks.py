"""Track and label scans with explicit schemas; sinks.

Never infer schemas: an artist named ``1991`` would turn the name column of
its file into integers and silently lose its rows in the label join.

Files with different headers (15-column artist files, 16-column labelled
files with ``genre`` after ``album_name``, any other order or width) are
grouped by their header line; every group is scanned with its own explicit
schema and the groups are united by column name.  No row is told from a header
by its content, so every row of every file is kept.  Files with line breaks inside
quotes are cut into records first (``csv_records``), still split by split.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.vocab import LABEL_FILE
from cadenza.sources import csv_records

# FIXED VALUES: columns of the track files, in file order
TRACK_COLUMNS = [
    ("track_name", "string"), ("track_id", "string"), ("artist_name", "string"),
    ("album_name", "string"), ("danceability", "double"), ("energy", "double"),
    ("key", "int"), ("loudness", "double"), ("mode", "int"), ("speechiness", "double"),
    ("acousticness", "double"), ("instrumentalness", "double"), ("liveness", "double"),
    ("valence", "double"), ("tempo", "double"),
]
# labelled-track files: genre after album_name (16 columns)
LABELLED_COLUMNS = TRACK_COLUMNS[:4] + [("genre", "string")] + TRACK_COLUMNS[4:]
_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType()}
TRACK_SCHEMA = T.StructType([T.StructField(n, _TYPES[t]) for n, t in TRACK_COLUMNS])
LABEL_SCHEMA = T.StructType([T.StructField("artist_name", T.StringType()),
                             T.StructField("genre", T.StringType())])


def _ddl(names: Sequence[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """First line of every file: file_path, file_name, header.

    The lines are found in parallel by the text source (only lines of a file's
    first split are kept, one survives per file).
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("blk"))
    first = lines.filter(F.col("blk") == 0).withColumn("mid", F.monotonically_increasing_id())
    return first.groupBy("file_path", "file_name").agg(F.min_by("value", "mid").alias("header"))


def read_tracks(spark: SparkSession, paths: str | Sequence[str],
                exclude_files: Iterable[str] = (LABEL_FILE,),
                columns: Sequence[tuple[str, str]] = TRACK_COLUMNS,
                drop_columns: Iterable[str] = ("genre",)) -> DataFrame:
    """Multi-file fact scan, all files concatenated, columns matched by name.

    Adds ``file_name`` and ``row_ord`` (ordinal within the scan: file path,
    split start, position) so "first row of a file" stays well defined.
    Columns missing from a file are null, further ones are ignored (the first
    of two columns of one name counts); ``drop_columns`` are removed.  Rows with
    an empty first field stay.  The driver sees one row per file (it lists the
    files anyway) and one scan is planned per distinct header.
    """
    excl = set(exclude_files)
    torn = {r["file_path"] for r in csv_records.broken_files(spark, paths).collect()}    # files, a subset of those listed
    found = [r for r in file_headers(spark, paths).collect() if r["file_name"] not in excl]
    by_header: dict[tuple[str, bool], list[str]] = {}
    whole = None
    if any(r["file_path"] in torn for r in found):
        whole = csv_records.records(spark, [unquote(r["file_path"]) for r in found if r["file_path"] in torn])
        heads = whole.filter("blk = 0 and pos = 0").select("file_path", "record").collect()
        heads = {r["file_path"]: r["record"] for r in heads}
        found = [{**r.asDict(), "header": heads.get(r["file_path"], r["header"])} for r in found]
    for r in found:
        by_header.setdefault((r["header"].lstrip("\ufeff"), r["file_path"] in torn), []).append(r["file_path"])
    wanted = [(n, typ) for n, typ in columns if n not in set(drop_columns)]
    out = None
    for (header, tears), files in sorted(by_header.items()):
        names: list[str] = []
        for i, n in enumerate(next(csv.reader([header]))):
            names.append(n if n and n not in names else f"__c{i}")
        raw = T.StructType([T.StructField(n, T.StringType()) for n in names])
        if tears:
            # quoted fields with line breaks: whole records, parsed one by one
            rows = whole.filter(F.col("file_path").isin(files) & ~((F.col("blk") == 0) & (F.col("pos") == 0))).filter("record != ''").select(
                F.from_csv("record", _ddl(names),
                           {"escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}).alias("r"),
                "file_name", F.struct("file_path", F.col("blk").alias("__blk"), F.col("pos").alias("__mid")).alias("row_ord"))
            cols = [(F.lit(None).cast(typ) if n not in names else F.col(f"r.`{n}`") if typ == "string"
                     else F.col(f"r.`{n}`").try_cast(typ)).alias(n) for n, typ in wanted]
            part = rows.select(*cols, "file_name", "row_ord")
        else:
            rows = (spark.read.schema(raw).option("header", True).option("escape", '"').option("mode", "PERMISSIVE")
                    .csv(sorted(unquote(f) for f in files)))
            cols = [(F.lit(None).cast(typ) if n not in names else F.col(f"`{n}`") if typ == "string"
                     else F.col(f"`{n}`").try_cast(typ)).alias(n) for n, typ in wanted]
            part = rows.select(*cols, F.col("_metadata.file_name").alias("file_name"),
                               F.struct(F.col("_metadata.file_path").alias("file_path"),
                                        F.col("_metadata.file_block_start").alias("__blk"),
                                        F.monotonically_increasing_id().alias("__mid")).alias("row_ord"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        fields = ", ".join([f"{n} {typ}" for n, typ in wanted]
                           + ["file_name string, row_ord struct<file_path:string,__blk:bigint,__mid:bigint>"])
        return spark.createDataFrame([], fields)
    return out


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label file ``artist_name, genre`` as strings (``N/A`` stays text)."""
    return (spark.read.schema(LABEL_SCHEMA).option("header", True).option("escape", '"')
            .csv(path))


def label_lookup_table(spark: SparkSession, path: str) -> DataFrame:
    """lower(artist) -> raw genre, the last row of the file winning."""
    lab = read_labels(spark, path).select(
        "*", F.struct(F.col("_metadata.file_block_start"),
                      F.monotonically_increasing_id()).alias("__o"))
    return lab.groupBy(F.lower("artist_name").alias("artist_key")).agg(
        F.max_by("genre", "__o").alias("genre"))


def tracks_by_first_artist(tracks: DataFrame) -> DataFrame:
    """Key every file by the artist of its first row; skip files whose first
    artist is empty; when two files share that artist the later file name
    wins.  Returns the kept rows with an ``artist`` column."""
    first = tracks.groupBy("file_name").agg(F.min_by("artist_name", "row_ord").alias("artist"))
    first = first.filter(F.col("artist").isNotNull() & (F.col("artist") != ""))
    winner = first.groupBy("artist").agg(F.max("file_name").alias("file_name"))
    return tracks.join(winner, "file_name", "inner")


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Playlist seed list ``subgenre, playlist_url`` -> (subgenre, playlist_id)."""
    raw = (spark.read.schema("subgenre string, playlist_url string").option("header", True)
           .option("ignoreLeadingWhiteSpace", True).csv(path))
    return raw.select("subgenre", F.regexp_extract("playlist_url", r"playlist/([A-Za-z0-9]+)", 1)
                      .alias("playlist_id"))


def roster(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Roster source: (search name, file slug) pairs."""
    return spark.createDataFrame(list(pairs), "name string, slug string")


# ---------------------------------------------------------------- sinks

def write_tracks(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by: Sequence[str] | None = None,
                 columns: Sequence[str] | None = None) -> bool:
    """Write a track table; nothing is written when there are no rows.

    ``mode='append'`` adds files (CSV part files each carry their own header,
    which header-aware readers skip).  Returns whether anything was written.
    """
    if columns is not None:
        df = df.select(*columns)
    if df.isEmpty():
        return False
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)
    return True


def write_labelled(df: DataFrame, path: str, fmt: str = "csv") -> bool:
    """Labelled-track sink with the fixed 16-column order."""
    return write_tracks(df, path, fmt=fmt, columns=[n for n, _ in LABELLED_COLUMNS])
