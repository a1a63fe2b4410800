"""Driver-table queries: JSON payload parsing.

Payload pages are built by Spark from ``conversations``, ``pages`` and
``events`` (see ``fixtures``) and parsed back; the SQL oracle states the same
result directly over the original rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions.vocab import AUDIO_FEATURES
from cadenza.plans import fixtures
from cadenza.plans.registry import register, t
from cadenza.sources import payloads


@register("payload_items", """
SELECT conv_id, CAST(turn AS VARCHAR) AS id, text AS name,
       concat_ws(', ', role, 'conv_' || CAST(conv_id AS VARCHAR)) AS artist_name,
       CASE WHEN turn % 5 = 0 THEN '' ELSE 'conv_' || CAST(conv_id AS VARCHAR) END AS album_name
FROM conversations WHERE turn % 7 <> 3 AND turn % 11 <> 5
""")
def payload_items(spark, sf):
    pages = fixtures.conversation_track_pages(t(spark, sf, "conversations"), page_size=3)
    rows = payloads.playlist_tracks(pages)
    return rows.select(F.col("request_key").cast("long").alias("conv_id"), "id", "name",
                       "artist_name", "album_name")


_PLAYLIST_SQL = """
SELECT conv_id, 'pl_' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS id,
       role AS name,
       CASE WHEN turn % 4 = 1 THEN '' ELSE 'user_' || CAST(conv_id AS VARCHAR) END AS owner,
       CASE WHEN turn % 9 = 4 THEN 0 ELSE coalesce(length(text), 0) END AS track_count
FROM ({src}) WHERE turn % 6 <> 2
"""


@register("payload_defaults", _PLAYLIST_SQL.format(src="SELECT * FROM conversations"))
def payload_defaults(spark, sf):
    pages = fixtures.conversation_playlist_search(t(spark, sf, "conversations"), page_size=3)
    rows = payloads.search_playlists(pages, page_size=3)
    return rows.select(F.col("request_key").cast("long").alias("conv_id"), "id", "name",
                       "owner", "track_count")


@register("playlist_limit", _PLAYLIST_SQL.format(src="""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, floor(turn / 2) ORDER BY turn) - 1
               AS pos FROM conversations) WHERE floor(turn / 2) * 2 + pos < 5"""))
def playlist_limit(spark, sf):
    """A search asked for 5 playlists over pages of 2: the limit ends inside the
    third page; nulls skipped."""
    pages = fixtures.conversation_playlist_search(t(spark, sf, "conversations"), page_size=2)
    rows = payloads.search_playlists(pages, limit=5, page_size=2)
    return rows.select(F.col("request_key").cast("long").alias("conv_id"), "id", "name",
                       "owner", "track_count")


@register("payload_idmap", """
WITH x AS (SELECT page_id, 'rb_' || CAST(page_id AS VARCHAR) AS rid, url FROM pages
           WHERE page_id % 13 <> 7 AND page_id % 17 <> 3 AND url IS NOT NULL AND url <> '')
SELECT string_split(url, '/')[-1] AS ext_id, arg_max(rid, page_id) AS id FROM x GROUP BY 1
""")
def payload_idmap(spark, sf):
    pages = fixtures.page_lookup_batches(t(spark, sf, "pages").select("page_id", "url"))
    return payloads.id_map(pages).select("ext_id", "id")


@register("json_props", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def json_props(spark, sf):
    ev = t(spark, sf, "events")
    parsed = F.from_json("props", "k STRING")
    return ev.select("event_id", parsed["k"].try_cast("int").alias("k"))


@register("audio_features", "SELECT event_id, " + ", ".join(
    "value AS energy" if f == "energy" else "CAST(user_id AS DOUBLE) AS tempo" if f == "tempo"
    else f"CAST(NULL AS DOUBLE) AS {f}" for f in AUDIO_FEATURES)
    + " FROM events WHERE event_type IS DISTINCT FROM 'error'")
def audio_features(spark, sf):
    landed = fixtures.event_feature_payloads(t(spark, sf, "events"))
    feats = payloads.audio_features(landed)
    return feats.select(F.col("request_key").cast("long").alias("event_id"), *AUDIO_FEATURES)


@register("tag_parse", """
WITH x AS (SELECT event_id, event_type,
                  TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
y AS (SELECT *, (event_id % 10 = 3 OR event_id % 10 = 7 OR event_type IS NULL OR k IS NULL)
                AS empty FROM x)
SELECT event_id, CASE WHEN empty THEN 0 ELSE 2 END AS n_tags,
       CASE WHEN empty THEN NULL ELSE event_type END AS first_tag,
       CASE WHEN empty THEN NULL ELSE k END AS first_count
FROM y
""")
def tag_parse(spark, sf):
    landed = fixtures.event_tag_payloads(t(spark, sf, "events"))
    tags = payloads.top_tags(landed)
    first = F.try_element_at("tags", F.lit(1))
    return tags.select(F.col("request_key").cast("long").alias("event_id"),
                       F.size("tags").alias("n_tags"), first["name"].alias("first_tag"),
                       first["count"].alias("first_count"))


_URL_RE = "/([a-z]{2})/([0-9]+)"


@register("url_segment", f"""
SELECT page_id, regexp_extract(url, '{_URL_RE}', 1) AS lang_seg,
       regexp_extract(url, '{_URL_RE}', 2) AS path_id,
       string_split(url, '/')[-1] AS last_seg
FROM pages
""")
def url_segment(spark, sf):
    from cadenza.functions.exprs import last_segment
    p = t(spark, sf, "pages")
    return p.select("page_id", F.regexp_extract("url", _URL_RE, 1).alias("lang_seg"),
                    F.regexp_extract("url", _URL_RE, 2).alias("path_id"),
                    last_segment("url").alias("last_seg"))
