"""Fixtures: landed payload pages made (by Spark) from the driver tables.

Not part of the engine: the registered queries need pages to parse.

The driver tables carry no API payloads, so these functions pack table rows
into the JSON shapes the payload parsers read.  Pages are bounded: items are
grouped ``page_size`` at a time, so no group ever holds an unbounded list.
Some fields are removed on purpose (keyed on the row ids) so the parsers'
default and skip rules are exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _pages(rows: DataFrame, key: str, pos: str, item, page_size: int) -> DataFrame:
    """Group items into pages of ``page_size`` ordered by ``pos``."""
    paged = rows.withColumn("page_no", F.floor(F.col(pos) / page_size).cast("long"))
    grouped = paged.groupBy(key, "page_no").agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("__o"), item.alias("v")))).alias("__l"))
    return grouped.select(F.col(key).cast("string").alias("request_key"), "page_no",
                          F.transform("__l", lambda s: s["v"]).alias("items"))


def conversation_track_pages(conv: DataFrame, page_size: int = 50) -> DataFrame:
    """Playlist-track pages: one playlist per conversation, one track per turn.
    track is null when turn % 7 = 3, its id when turn % 11 = 5, its album
    when turn % 5 = 0."""
    turn = F.col("turn")
    track = F.when(turn % 7 == 3, F.lit(None)).otherwise(F.struct(
        F.when(turn % 11 == 5, F.lit(None)).otherwise(turn.cast("string")).alias("id"),
        F.col("text").alias("name"),
        F.array(F.struct(F.col("role").alias("name")),
                F.struct(F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("name"))
                ).alias("artists"),
        F.when(turn % 5 == 0, F.lit(None)).otherwise(F.struct(
            F.concat(F.lit("conv_"), F.col("conv_id").cast("string")).alias("name"))).alias("album")))
    pages = _pages(conv, "conv_id", "turn", F.struct(track.alias("track")), page_size)
    return pages.select("request_key", "page_no", F.lit(200).alias("status"),
                        F.to_json(F.struct("items")).alias("body"))


def conversation_playlist_search(conv: DataFrame, page_size: int = 50) -> DataFrame:
    """Playlist-search pages: item null when turn % 6 = 2, owner missing when
    turn % 4 = 1, track total missing when turn % 9 = 4."""
    turn = F.col("turn")
    item = F.when(turn % 6 == 2, F.lit(None)).otherwise(F.struct(
        F.concat(F.lit("pl_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string")).alias("id"),
        F.col("role").alias("name"),
        F.when(turn % 4 == 1, F.lit(None)).otherwise(
            F.struct(F.concat(F.lit("user_"), F.col("conv_id").cast("string")).alias("display_name"))
        ).alias("owner"),
        F.when(turn % 9 == 4, F.lit(None)).otherwise(
            F.struct(F.length("text").cast("long").alias("total"))).alias("tracks")))
    pages = _pages(conv, "conv_id", "turn", item, page_size)
    body = F.to_json(F.struct(F.struct(F.col("items").alias("items")).alias("playlists")))
    return pages.select("request_key", "page_no", F.lit(200).alias("status"), body.alias("body"))


def page_lookup_batches(pages: DataFrame, batch: int = 40) -> DataFrame:
    """Id-lookup responses, ``batch`` pages per request: id missing when
    page_id % 13 = 7, href missing when page_id % 17 = 3."""
    pid = F.col("page_id")
    item = F.struct(
        F.when(pid % 13 == 7, F.lit(None)).otherwise(
            F.concat(F.lit("rb_"), pid.cast("string"))).alias("id"),
        F.when(pid % 17 == 3, F.lit(None)).otherwise(F.col("url")).alias("href"))
    rows = pages.withColumn("__k", F.lit("lookup"))
    out = _pages(rows, "__k", "page_id", item, batch)
    return out.select("request_key", "page_no", F.lit(200).alias("status"),
                      F.to_json(F.struct(F.col("items").alias("content"))).alias("body"))


def event_feature_payloads(events: DataFrame) -> DataFrame:
    """Feature responses: 404 for error events; energy = value, tempo = user_id."""
    body = F.to_json(F.struct(F.col("value").alias("energy"),
                              F.col("user_id").cast("double").alias("tempo")))
    status = F.when(F.col("event_type") == "error", F.lit(404)).otherwise(F.lit(200))
    return events.select(F.col("event_id").cast("string").alias("request_key"),
                         F.lit(0).cast("long").alias("page_no"), status.alias("status"), body.alias("body"))


def event_tag_payloads(events: DataFrame) -> DataFrame:
    """Tag responses built from events: a single object instead of a list
    when event_id % 10 = 3, a non-numeric count when event_id % 10 = 7."""
    k = F.get_json_object("props", "$.k")
    eid = F.col("event_id")
    cnt = F.when(eid % 10 == 7, F.lit("x")).otherwise(k)
    tag = F.struct(F.col("event_type").alias("name"), cnt.alias("count"))
    second = F.struct(F.lit("club").alias("name"), F.lit("1").alias("count"))
    as_list = F.to_json(F.struct(F.struct(F.array(tag, second).alias("tag")).alias("toptags")))
    as_obj = F.to_json(F.struct(F.struct(tag.alias("tag")).alias("toptags")))
    body = F.when(eid % 10 == 3, as_obj).otherwise(as_list)
    return events.select(eid.cast("string").alias("request_key"), F.lit(0).cast("long").alias("page_no"),
                         F.lit(200).alias("status"), body.alias("body"))


def conversation_search_pages(conv: DataFrame, page_size: int = 50) -> DataFrame:
    """Track-search pages: the query is ``CONV_<id>``; a turn is credited to
    it unless turn % 3 = 1 (then another artist); album missing when
    turn % 4 = 0."""
    turn = F.col("turn")
    q = F.concat(F.lit("CONV_"), F.col("conv_id").cast("string"))
    artist = F.when(turn % 3 == 1, F.lit("someone else")).otherwise(F.lower(q))
    item = F.struct(
        turn.cast("string").alias("id"), F.col("text").alias("name"),
        F.array(F.struct(artist.alias("name"))).alias("artists"),
        F.when(turn % 4 == 0, F.lit(None)).otherwise(
            F.struct(F.concat(F.lit("al_"), turn.cast("string")).alias("id"),
                     F.lit("album").alias("name"))).alias("album"))
    rows = conv.withColumn("__q", q)
    pages = _pages(rows, "__q", "turn", item, page_size)
    body = F.to_json(F.struct(F.struct(F.col("items").alias("items")).alias("tracks")))
    return pages.select("request_key", "page_no", F.lit(200).alias("status"), body.alias("body"))


def document_album_pages(docs: DataFrame, page_size: int = 50):
    """Album listings (one artist per source, one album per language, albums
    listed in language order) and album track pages (documents by id)."""
    albums = docs.select("source", "lang").distinct().withColumn(
        "album_id", F.concat_ws("/", "source", "lang"))
    rank = F.dense_rank().over(Window.partitionBy("source").orderBy("lang")) - 1
    listing = _pages(albums.withColumn("__rank", rank),
        "source", "__rank", F.struct(F.col("album_id").alias("id"), F.col("lang").alias("name")),
        page_size)
    listing = listing.select("request_key", "page_no", F.lit(200).alias("status"),
                             F.to_json(F.struct("items")).alias("body"))
    tracks = docs.withColumn("album_id", F.concat_ws("/", "source", "lang"))
    tpages = _pages(tracks.withColumn("__pos", F.col("doc_id")), "album_id", "__pos",
                    F.struct(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("name")),
                    page_size)
    tpages = tpages.select("request_key", "page_no", F.lit(200).alias("status"),
                           F.to_json(F.struct("items")).alias("body"))
    return listing, tpages


def document_album_details(docs: DataFrame) -> DataFrame:
    """Album detail responses: name = language, credited artists = the
    source and a guest."""
    albums = docs.select("source", "lang").distinct()
    body = F.to_json(F.struct(F.col("lang").alias("name"), F.array(
        F.struct(F.col("source").alias("name")), F.struct(F.lit("guest").alias("name"))).alias("artists")))
    return albums.select(F.concat_ws("/", "source", "lang").alias("request_key"),
                         F.lit(0).cast("long").alias("page_no"), F.lit(200).alias("status"), body.alias("body"))


def document_album_searches(docs: DataFrame, page_size: int = 3) -> DataFrame:
    """Album searches, one per language: its albums in the order of the sources,
    over pages of ``page_size``; the search for ``xx`` has no hit."""
    albums = docs.select("source", "lang").distinct()
    rank = F.dense_rank().over(Window.partitionBy("lang").orderBy("source")) - 1
    hits = _pages(albums.withColumn("__rank", rank), "lang", "__rank",
                  F.struct(F.concat_ws("/", "source", "lang").alias("id"), F.col("lang").alias("name")), page_size)
    pages = hits.select("request_key", "page_no", F.to_json(F.struct(F.struct("items").alias("albums"))).alias("body"))
    none = docs.select(F.lit("xx").alias("request_key"), F.lit(0).cast("long").alias("page_no"),
                       F.lit('{"albums": {"items": []}}').alias("body")).distinct()
    return pages.unionByName(none).withColumn("status", F.lit(200))


# ---- label-driven collection pages from nation / region / customer ----------

def _track_number():
    """Two customers share a track id, 15 keys apart (other nations, mostly)."""
    return F.col("c_custkey") - F.when(F.col("c_custkey") % 30 >= 15, 15).otherwise(0)


def _track_key():
    return F.concat(F.lit("t"), _track_number().cast("string"))


def region_label_file(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Label file: every nation labelled with its region name."""
    return nation.join(region, nation.n_regionkey == region.r_regionkey) \
                 .select(F.col("n_name").alias("artist_name"), F.col("r_name").alias("genre"))


def region_playlist_searches(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Playlist search per region: its nations in key order, one playlist per
    nation; the item is null when n_nationkey % 7 = 3."""
    rows = nation.join(region, nation.n_regionkey == region.r_regionkey)
    item = F.when(F.col("n_nationkey") % 7 == 3, F.lit(None)).otherwise(F.struct(
        F.concat(F.lit("pl_"), F.col("n_nationkey").cast("string")).alias("id"),
        F.col("n_name").alias("name")))
    pages = _pages(rows, "r_name", "n_nationkey", item, 50)
    body = F.to_json(F.struct(F.struct(F.col("items").alias("items")).alias("playlists")))
    return pages.select("request_key", "page_no", F.lit(200).alias("status"), body.alias("body"))


def nation_playlist_pages(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Playlist pages: a nation's customers as tracks (two customers share
    one id, so a track appears in several playlists)."""
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey) \
                   .withColumn("__pl", F.concat(F.lit("pl_"), F.col("n_nationkey").cast("string")))
    item = F.struct(F.struct(_track_key().alias("id"), F.col("c_name").alias("name"),
                             F.array(F.struct(F.col("c_mktsegment").alias("name"))).alias("artists"),
                             F.struct(F.col("n_name").alias("name")).alias("album")).alias("track"))
    pages = _pages(rows, "__pl", "c_custkey", item, 50)
    return pages.select("request_key", "page_no", F.lit(200).alias("status"),
                        F.to_json(F.struct("items")).alias("body"))


def customer_track_lookups(customer: DataFrame) -> DataFrame:
    """Id lookups for every track id, 40 per request; no id when k % 11 = 4."""
    ids = customer.select(_track_number().alias("k")).distinct().withColumn("__q", F.lit("q"))
    item = F.struct(F.when(F.col("k") % 11 == 4, F.lit(None))
                    .otherwise(F.concat(F.lit("r"), F.col("k").cast("string"))).alias("id"),
                    F.concat(F.lit("https://x/track/t"), F.col("k").cast("string")).alias("href"))
    pages = _pages(ids, "__q", "k", item, 40)
    return pages.select("request_key", "page_no", F.lit(200).alias("status"),
                        F.to_json(F.struct(F.col("items").alias("content"))).alias("body"))


def customer_track_features(customer: DataFrame) -> DataFrame:
    """Feature responses per feature id r<k>: 404 when k % 13 = 5;
    energy = k / 300, tempo = k."""
    ids = customer.select(_track_number().alias("k")).distinct()
    body = F.to_json(F.struct((F.col("k") / 300.0).alias("energy"),
                              F.col("k").cast("double").alias("tempo")))
    return ids.select(F.concat(F.lit("r"), F.col("k").cast("string")).alias("request_key"),
                      F.lit(0).cast("long").alias("page_no"),
                      F.when(F.col("k") % 13 == 5, F.lit(404)).otherwise(F.lit(200)).alias("status"),
                      body.alias("body"))


# ---- roster-driven collection pages from supplier / lineitem ----------------

def _line_id(prefix: str):
    return F.concat(F.lit(prefix), F.col("l_orderkey").cast("string"), F.lit("_"),
                    F.col("l_linenumber").cast("string"))


SEARCH_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_quantity")


def supplier_roster(supplier: DataFrame) -> DataFrame:
    """Roster: search name = supplier name, slug = lower name with '#' -> '_'."""
    return supplier.select(F.col("s_name").alias("name"),
                           F.lower(F.regexp_replace("s_name", "#", "_")).alias("slug"))


def supplier_search_pages(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    """Track search per supplier: its line items in (order, line) order;
    track name p<partkey % 400> (repeats, so names dedupe), credited to the
    supplier except line 3 (another artist)."""
    from cadenza.operators.ingest import rank_in_group
    rows = lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey) \
                   .select("s_name", "l_orderkey", "l_linenumber", "l_partkey", "l_discount",
                           "l_quantity")
    # (order, line) repeats in this table: order on every column used, so
    # only fully identical rows tie
    rows = rank_in_group(rows, ["s_name"], list(SEARCH_ORDER), "__pos")
    artist = F.when(F.col("l_linenumber") == 3, F.lit("other")).otherwise(F.lower("s_name"))
    item = F.struct(_line_id("l").alias("id"),
                    F.concat(F.lit("p"), (F.col("l_partkey") % 400).cast("string")).alias("name"),
                    F.array(F.struct(artist.alias("name"))).alias("artists"),
                    F.struct(F.concat(F.lit("a"), F.col("l_orderkey").cast("string")).alias("id"),
                             F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("name")
                             ).alias("album"))
    pages = _pages(rows.withColumn("__pos", F.col("__pos") - 1), "s_name", "__pos", item, 50)
    body = F.to_json(F.struct(F.struct(F.col("items").alias("items")).alias("tracks")))
    return pages.select("request_key", "page_no", F.lit(200).alias("status"), body.alias("body"))


def line_lookups(lineitem: DataFrame) -> DataFrame:
    """Id lookups for every distinct track id, 40 per request; no id when
    l_orderkey % 11 = 4."""
    item = F.struct(F.when(F.col("l_orderkey") % 11 == 4, F.lit(None)).otherwise(_line_id("r")).alias("id"),
                    F.concat(F.lit("https://x/track/"), _line_id("l")).alias("href"))
    rows = lineitem.select("l_orderkey", "l_linenumber").distinct() \
        .withColumn("__q", F.lit("q")).withColumn(
            "__pos", F.col("l_orderkey").cast("long") * 8 + F.col("l_linenumber"))
    pages = _pages(rows, "__q", "__pos", item, 40)
    return pages.select("request_key", "page_no", F.lit(200).alias("status"),
                        F.to_json(F.struct(F.col("items").alias("content"))).alias("body"))


def line_features(lineitem: DataFrame) -> DataFrame:
    """One feature response per distinct track id r<order>_<line>: 404 when
    l_orderkey % 13 = 5; energy = smallest discount, tempo = smallest
    quantity of the id's rows."""
    per_id = lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_discount").alias("l_discount"), F.min("l_quantity").alias("l_quantity"))
    body = F.to_json(F.struct(F.col("l_discount").alias("energy"), F.col("l_quantity").alias("tempo")))
    return per_id.select(_line_id("r").alias("request_key"), F.lit(0).cast("long").alias("page_no"),
                           F.when(F.col("l_orderkey") % 13 == 5, F.lit(404)).otherwise(F.lit(200))
                           .alias("status"), body.alias("body"))
