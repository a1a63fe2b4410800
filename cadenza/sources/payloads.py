"""Landed API payloads -> rows.

A landed page is one row ``(request_key, page_no, status, body)`` where
``body`` is the JSON text of one response page.  HTTP fetching is not part
of this library: pages are landed first (by any fetcher) and then parsed in
parallel with ``from_json`` under explicit schemas, ``posexplode`` keeping
each item's position so "first" and "last" stay well defined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.exprs import last_segment
from cadenza.functions.vocab import AUDIO_FEATURES
from cadenza.operators.ingest import first_hit

S = T.StringType()
NAMED = T.StructType([T.StructField("name", S)])
ARTISTS = T.ArrayType(NAMED)

TRACK = T.StructType([
    T.StructField("id", S), T.StructField("name", S), T.StructField("artists", ARTISTS),
    T.StructField("album", T.StructType([T.StructField("id", S), T.StructField("name", S)])),
])
SEARCH_TRACKS = T.StructType([T.StructField("tracks", T.StructType([
    T.StructField("items", T.ArrayType(TRACK))]))])
ITEMS_PAGE = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([T.StructField("id", S),
                                                     T.StructField("name", S)]))),
    T.StructField("next", S)])
PLAYLIST_SEARCH = T.StructType([T.StructField("playlists", T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", S), T.StructField("name", S),
        T.StructField("owner", T.StructType([T.StructField("display_name", S)])),
        T.StructField("tracks", T.StructType([T.StructField("total", T.LongType())])),
    ])))]))])
PLAYLIST_TRACKS = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([T.StructField("track", TRACK)]))),
    T.StructField("next", S)])
ID_LOOKUP = T.StructType([T.StructField("content", T.ArrayType(T.StructType([
    T.StructField("id", S), T.StructField("href", S)])))])
FEATURES = T.StructType([T.StructField(f, T.DoubleType()) for f in AUDIO_FEATURES])
ALBUM_DETAIL = T.StructType([T.StructField("name", S), T.StructField("artists", ARTISTS)])
SEARCH_ALBUMS = T.StructType([T.StructField("albums", T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([T.StructField("id", S), T.StructField("name", S)])))]))])
TAG_ITEMS = T.ArrayType(T.StructType([T.StructField("name", S), T.StructField("count", S)]))
TAGS_RAW = T.StructType([T.StructField("toptags", T.StructType([T.StructField("tag", S)]))])


def _ok(landed: DataFrame) -> DataFrame:
    if "status" in landed.columns:
        return landed.filter(F.coalesce(F.col("status"), F.lit(200)) == 200)
    return landed


def _items(landed: DataFrame, schema: T.StructType, path: str, keep=("request_key", "page_no")):
    parsed = _ok(landed).select(*keep, F.from_json("body", schema).alias("j"))
    # null elements are kept (they still occupy a position); callers skip them
    return parsed.select(*keep, F.posexplode(F.col(f"j.{path}")).alias("pos", "it"))


def _artist_names(c: Column) -> Column:
    return F.transform(c, lambda a: a["name"])


def search_tracks(landed: DataFrame, page_size: int = 50) -> DataFrame:
    """Track-search pages -> rows (name, id, artists, album name/id with ''
    defaults) with the source ordinal ``page_no * page_size + pos``."""
    it = _items(landed, SEARCH_TRACKS, "tracks.items").filter(F.col("it").isNotNull())
    return it.select(
        "request_key", "page_no", "pos",
        (F.col("page_no") * page_size + F.col("pos")).alias("ordinal"),
        F.col("it.name").alias("name"), F.col("it.id").alias("id"),
        _artist_names(F.col("it.artists")).alias("artists"),
        F.coalesce(F.col("it.album.name"), F.lit("")).alias("album_name"),
        F.coalesce(F.col("it.album.id"), F.lit("")).alias("album_id"))


def credited(artists_col: str, query_col: str) -> Column:
    """Artist-membership predicate: the lowered query equals one of the
    lowered credited names."""
    return F.exists(F.col(artists_col), lambda a: F.lower(a) == F.lower(F.col(query_col)))


def list_items(landed: DataFrame) -> DataFrame:
    """``items[] {id, name}`` pages (album listings, album track pages)."""
    it = _items(landed, ITEMS_PAGE, "items").filter(F.col("it").isNotNull())
    return it.select("request_key", "page_no", "pos", F.col("it.id").alias("id"),
                     F.col("it.name").alias("name"))


def artist_album_tracks(album_pages: DataFrame, track_pages: DataFrame) -> DataFrame:
    """Albums of an artist joined to their track pages; every track carries
    its album name and id and the ordinal (album order, page, position)."""
    albums = list_items(album_pages).select(
        F.col("request_key").alias("artist_key"), F.col("id").alias("album_id"),
        F.col("name").alias("album_name"),
        F.struct(F.col("page_no").alias("ap"), F.col("pos").alias("apos")).alias("album_ord"))
    tracks = list_items(track_pages).select(
        F.col("request_key").alias("album_id"), F.col("page_no").alias("tp"),
        F.col("pos").alias("tpos"), "id", "name")
    j = albums.join(tracks, "album_id")
    return j.select("artist_key", "album_id", "album_name", "id", "name",
                    F.struct("album_ord", "tp", "tpos").alias("ordinal"))


def search_playlists(landed: DataFrame, limit: int | None = None,
                     page_size: int = 50) -> DataFrame:
    """Playlist-search pages -> (id, name, owner '', track_count 0); null
    items skipped; ``limit`` = results the request asked for, counted over all
    its pages (``page_no * page_size + pos``)."""
    if limit is not None:      # later pages are not even parsed
        landed = landed.filter(F.col("page_no") * page_size < limit)
    it = _items(landed, PLAYLIST_SEARCH, "playlists.items")
    if limit is not None:
        it = it.filter(F.col("page_no") * page_size + F.col("pos") < limit)
    return it.filter(F.col("it").isNotNull()).select(
        "request_key", "pos", F.col("it.id").alias("id"), F.col("it.name").alias("name"),
        F.coalesce(F.col("it.owner.display_name"), F.lit("")).alias("owner"),
        F.coalesce(F.col("it.tracks.total"), F.lit(0)).alias("track_count"))


def playlist_tracks(landed: DataFrame) -> DataFrame:
    """Playlist-track pages -> (name, id, artist_name joined ', ', album_name
    ''); items without a track or a track id are skipped."""
    it = _items(landed, PLAYLIST_TRACKS, "items")
    tr = F.col("it.track")
    return it.filter(tr.isNotNull() & tr["id"].isNotNull() & (tr["id"] != "")).select(
        "request_key", "page_no", "pos", tr["name"].alias("name"), tr["id"].alias("id"),
        F.array_join(_artist_names(tr["artists"]), ", ").alias("artist_name"),
        F.coalesce(tr["album"]["name"], F.lit("")).alias("album_name"))


def id_map(landed: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Id-lookup pages -> (ext_id, id): external id = last '/' segment of
    href; rows lacking id or href skipped; the last duplicate wins.  With
    ``wanted`` (ext_id) only those ids are looked for: the others are neither
    sorted nor compared."""
    it = _items(landed, ID_LOOKUP, "content")
    ok = it.filter(F.col("it.id").isNotNull() & (F.col("it.id") != "")
                   & F.col("it.href").isNotNull() & (F.col("it.href") != ""))
    keyed = ok.select(last_segment(F.col("it.href")).alias("ext_id"), F.col("it.id").alias("id"),
                      F.struct("request_key", "page_no", "pos").alias("__ord"))
    if wanted is not None:
        keyed = keyed.join(wanted.select("ext_id"), "ext_id", "left_semi")
    return keyed.groupBy("ext_id").agg(F.max_by("id", "__ord").alias("id"))


def audio_features(landed: DataFrame) -> DataFrame:
    """Feature payloads -> the 11 feature columns (missing keys -> null);
    non-200 responses and bodies that are no JSON object give no row."""
    return _features(_ok(landed), F.get_json_object("body", "$"), ["request_key"])


def features_of(rows: DataFrame, landed: DataFrame, key: str, own: str) -> DataFrame:
    """``rows`` joined to the features landed under ``key``.  Pages travel as they
    landed and only those that belong to a row are parsed.  ``own`` is a column of
    ``rows`` without nulls, besides ``key``: a test that names both sides stays
    behind the join."""
    pages = _ok(landed).select(F.col("request_key").alias(key), F.col("body").alias("__body"))
    joined = rows.join(pages, key).withColumnRenamed("__body", "body")
    return _features(joined, F.when(F.col(own).isNotNull(), F.get_json_object("body", "$")), rows.columns)


def _features(pages: DataFrame, json: Column, keep: list[str]) -> DataFrame:
    parsed = pages.filter(json.startswith("{")).select(*keep, F.from_json("body", FEATURES).alias("__f"))
    return parsed.select(*keep, *[F.col(f"__f.{c}").alias(c) for c in AUDIO_FEATURES])


def album_detail(landed: DataFrame) -> DataFrame:
    """Album payload -> album name and credited artists joined with ', '."""
    parsed = _ok(landed).select("request_key", F.from_json("body", ALBUM_DETAIL).alias("a"))
    return parsed.select("request_key", F.col("a.name").alias("album_name"),
                         F.array_join(_artist_names(F.col("a.artists")), ", ").alias("artist_name"))


def album_ids(landed: DataFrame) -> DataFrame:
    """Album-search pages -> (request_key, album_id): the first hit of each
    search; a search without hits gives no row."""
    it = _items(landed, SEARCH_ALBUMS, "albums.items").withColumn("ord", F.struct("page_no", "pos"))
    return first_hit(it, "request_key", "ord", F.col("it.id"), "album_id").filter("album_id is not null")


def album_tracks(detail_pages: DataFrame, track_pages: DataFrame) -> DataFrame:
    """Tracks of albums (request_key of both = album id) with the album's name
    and joined artists; tracks without an id are skipped."""
    detail = album_detail(detail_pages).withColumnRenamed("request_key", "album_id")
    tracks = list_items(track_pages).filter("id is not null and id != ''").withColumnRenamed("request_key", "album_id")
    return tracks.join(detail, "album_id")


def albums_without_tracks(detail_pages: DataFrame, track_pages: DataFrame) -> DataFrame:
    """Albums (album_id, album_name) whose track pages list nothing."""
    listed = list_items(track_pages).select(F.col("request_key").alias("album_id"))
    return (album_detail(detail_pages).select(F.col("request_key").alias("album_id"), "album_name")
            .join(listed, "album_id", "left_anti"))


def top_tags(landed: DataFrame) -> DataFrame:
    """Tag payloads -> ``array<struct<name, count int>>``.

    ``toptags.tag`` that is not a list gives ``[]``; one element without a
    name or with a count that is not an integer empties the whole list.
    """
    raw = _ok(landed).select("request_key", F.from_json("body", TAGS_RAW).alias("j"))
    txt = F.col("j.toptags.tag")
    is_list = F.ltrim(F.coalesce(txt, F.lit(""))).startswith("[")
    arr = F.from_json(F.when(is_list, txt), TAG_ITEMS)
    typed = F.transform(arr, lambda t: F.struct(t["name"].alias("name"),
                                                t["count"].try_cast("int").alias("count")))
    bad = F.exists(typed, lambda t: t["name"].isNull() | t["count"].isNull())
    empty = F.array().cast(T.ArrayType(T.StructType([T.StructField("name", S),
                                                     T.StructField("count", T.IntegerType())])))
    tags = F.when(~is_list | arr.isNull() | bad, empty).otherwise(typed)
    return raw.select("request_key", tags.alias("tags"))
