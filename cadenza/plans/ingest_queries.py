"""Driver-table queries: dedupe, caps, batches, first hit, first-label-wins,
lookup status, pending roster (B6, B12, C3-C6, D23, D24, E1-E4, E8, F6, G3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import ingest
from cadenza.plans.registry import register, sql_strip, t

_NORM_SQL = sql_strip("lower(text)")


def _docs(spark, sf):
    return t(spark, sf, "documents").select("doc_id", "source", "lang", "text")


def _deduped(spark, sf, order=("doc_id",)):
    return ingest.dedupe_by_name(_docs(spark, sf), ["source"], "text", list(order), keep_name=False)


_DEDUP_SQL = f"""SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source, {_NORM_SQL}"""


@register("dedupe_first", _DEDUP_SQL)
def dedupe_first(spark, sf):
    return _deduped(spark, sf).select("source", "doc_id")


@register("cap_per_group", f"""
WITH d AS ({_DEDUP_SQL}),
r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM d)
SELECT source, doc_id, rank FROM r WHERE rank <= 10
""")
def cap_per_group(spark, sf):
    capped = ingest.cap_per_group(_deduped(spark, sf), ["source"], ["doc_id"], cap=10)
    return capped.select("source", "doc_id", "rank")


_SOFT_CAP_SQL = f"""
WITH x AS (SELECT doc_id, source, lang,
                  row_number() OVER (PARTITION BY source, {_NORM_SQL} ORDER BY lang, doc_id) AS rn
           FROM documents),
d AS (SELECT doc_id, source, lang FROM x WHERE rn = 1),
u AS (SELECT source, lang, count(*) AS nu FROM d GROUP BY source, lang),
k AS (SELECT source, lang FROM (
        SELECT source, lang, coalesce(sum(nu) OVER (PARTITION BY source ORDER BY lang
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM u)
      WHERE before < 20)
SELECT d.source, d.lang, d.doc_id FROM d JOIN k ON d.source = k.source AND d.lang = k.lang
"""


@register("soft_cap", _SOFT_CAP_SQL)
def soft_cap(spark, sf):
    d = _deduped(spark, sf, order=("lang", "doc_id"))
    return ingest.soft_cap(d, ["source"], "lang", ["lang"], 20).select("source", "lang", "doc_id")


@register("batch_ids", f"""
WITH d AS ({_DEDUP_SQL}),
r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM d),
b AS (SELECT source, doc_id, rank, CAST(floor((rank - 1) / 40) AS BIGINT) AS batch_no
      FROM r)
SELECT source, batch_no, count(*) AS n_ids, arg_min(doc_id, rank) AS first_id,
       arg_max(doc_id, rank) AS last_id
FROM b GROUP BY source, batch_no
""")
def batch_ids(spark, sf):
    capped = ingest.cap_per_group(_deduped(spark, sf), ["source"], ["doc_id"], cap=None)
    b = ingest.batches(capped, ["source"], "doc_id", "rank", 40)
    return b.select("source", "batch_no", "n_ids", F.element_at("ids", 1).alias("first_id"),
                    F.element_at("ids", -1).alias("last_id"))


@register("rank_uncapped", """
SELECT flag AS g, l_orderkey, l_linenumber,
       row_number() OVER (PARTITION BY flag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rank
FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS flag FROM lineitem)
""")
def rank_uncapped(spark, sf):
    """Every row of three groups ranked (one group's key is null), whole rows in tow."""
    li = t(spark, sf, "lineitem").withColumn("g", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")))
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    return ingest.cap_per_group(li, ["g"], order, cap=None).select("g", "l_orderkey", "l_linenumber", "rank")


@register("first_hit", """
SELECT conv_id, min(turn) AS first_turn, CAST(arg_min(length(text), turn) AS BIGINT) AS n_chars
FROM conversations WHERE role = 'assistant' GROUP BY conv_id
""")
def first_hit(spark, sf):
    conv = t(spark, sf, "conversations").filter(F.col("role") == "assistant")
    hit = F.struct(F.col("turn").alias("first_turn"),
                   F.length("text").cast("long").alias("n_chars"))
    return ingest.first_hit(conv, "conv_id", "turn", hit).select("conv_id", "hit.*")


def _cohorts(spark, sf):
    o = t(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus",
                    F.date_format("o_orderdate", "yyyy-MM").alias("label"))


_COHORT_SQL = """SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus,
       strftime(o_orderdate, '%Y-%m') AS label FROM orders"""
_FIRST_WINS_SQL = f"""
WITH x AS ({_COHORT_SQL}),
f AS (SELECT o_custkey, min(label) AS fl FROM x GROUP BY o_custkey)
SELECT x.* FROM x JOIN f ON x.o_custkey = f.o_custkey AND x.label = f.fl"""


@register("first_label_wins", f"SELECT o_orderkey, o_custkey, label FROM ({_FIRST_WINS_SQL})")
def first_label_wins(spark, sf):
    return ingest.first_label_wins(_cohorts(spark, sf), "o_custkey", "label") \
        .select("o_orderkey", "o_custkey", "label")


@register("label_stats", f"""
WITH c AS ({_COHORT_SQL}), k AS ({_FIRST_WINS_SQL}),
l AS (SELECT DISTINCT label FROM c),
p AS (SELECT label, count(DISTINCT o_orderpriority) AS n_playlists FROM c GROUP BY label),
tr AS (SELECT label, count(*) AS n_tracks, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_with_features
       FROM k GROUP BY label)
SELECT l.label, coalesce(p.n_playlists, 0) AS n_playlists, coalesce(tr.n_tracks, 0) AS n_tracks,
       coalesce(tr.n_with_features, 0) AS n_with_features
FROM l LEFT JOIN p ON l.label = p.label LEFT JOIN tr ON l.label = tr.label
""")
def label_stats(spark, sf):
    c = _cohorts(spark, sf)
    kept = ingest.first_label_wins(c, "o_custkey", "label")
    return ingest.label_stats(c, kept, "label", "o_orderpriority", F.col("o_orderstatus") == "F") \
        .select("label", "n_playlists", "n_tracks", "n_with_features")


def _lookup(spark, sf):
    items = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    id_map = t(spark, sf, "supplier").filter(F.col("s_acctbal") > 0).select("s_suppkey", "s_nationkey")
    feats = t(spark, sf, "nation").filter(F.col("n_regionkey") != 4).select("n_nationkey")
    return ingest.lookup_status(items, id_map, "l_suppkey", "s_suppkey", feats, "n_nationkey",
                                "s_nationkey")


@register("lookup_status", """
WITH m AS (SELECT s_suppkey, s_nationkey FROM supplier WHERE s_acctbal > 0),
f AS (SELECT n_nationkey FROM nation WHERE n_regionkey <> 4),
j AS (SELECT CASE WHEN m.s_suppkey IS NULL THEN 'no_id'
                  WHEN f.n_nationkey IS NULL THEN 'no_features' ELSE 'collected' END AS status
      FROM lineitem l LEFT JOIN m ON l.l_suppkey = m.s_suppkey
      LEFT JOIN f ON m.s_nationkey = f.n_nationkey)
SELECT status, count(*) AS n FROM j GROUP BY status
""")
def lookup_status(spark, sf):
    return ingest.status_counts(_lookup(spark, sf))


@register("lookup_join", """
SELECT l.l_orderkey, l.l_linenumber, n.n_name
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE s.s_acctbal > 0 AND n.n_regionkey <> 4
""")
def lookup_join(spark, sf):
    """Inner lookup chain item -> external id -> features (misses dropped)."""
    items = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    id_map = t(spark, sf, "supplier").filter(F.col("s_acctbal") > 0) \
        .select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    feats = t(spark, sf, "nation").filter(F.col("n_regionkey") != 4) \
        .select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return items.join(id_map, "l_suppkey").join(feats, "s_nationkey") \
        .select("l_orderkey", "l_linenumber", "n_name")


def _roster(spark, sf):
    c = t(spark, sf, "customer")
    return c.select("c_custkey", F.lower(F.regexp_replace("c_name", "#", "_")).alias("slug"))


def _done(spark, sf):
    o = t(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return o.select(F.col("o_custkey").alias("c_custkey")).distinct()


@register("pending_roster", """
SELECT c_custkey, lower(replace(c_name, '#', '_')) AS slug FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
                        AND o_custkey IS NOT NULL)
""")
def pending_roster(spark, sf):
    return ingest.pending(_roster(spark, sf), _done(spark, sf), "c_custkey")


@register("roster_status", """
WITH d AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'),
y AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'),
s AS (SELECT CASE WHEN c.c_custkey IN (SELECT o_custkey FROM d) THEN 'skipped'
                  WHEN c.c_custkey IN (SELECT o_custkey FROM y) THEN 'collected'
                  ELSE 'empty' END AS status FROM customer c)
SELECT status, count(*) AS n FROM s GROUP BY status
""")
def roster_status(spark, sf):
    """Run counters: skipped (already collected), collected (yielded rows),
    empty (ran, wrote nothing: stays pending for the next run)."""
    roster = _roster(spark, sf)
    done = _done(spark, sf).withColumn("__done", F.lit(True))
    yielded = t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F") \
        .select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("__y", F.lit(True))
    j = roster.join(done, "c_custkey", "left").join(yielded, "c_custkey", "left")
    st = (F.when(F.col("__done"), F.lit("skipped")).when(F.col("__y"), F.lit("collected"))
          .otherwise(F.lit("empty")))
    return ingest.status_counts(j.withColumn("status", st))


@register("search_collect", f"""
WITH x AS (SELECT conv_id, turn, text,
                  CASE WHEN turn % 4 = 0 THEN '' ELSE 'al_' || CAST(turn AS VARCHAR) END AS album_id
           FROM conversations WHERE turn % 3 <> 1 AND turn < 6),
d AS (SELECT *, row_number() OVER (PARTITION BY conv_id, {sql_strip("lower(text)")} ORDER BY turn) AS rn
      FROM x),
r AS (SELECT conv_id, turn, album_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rank
      FROM d WHERE rn = 1)
SELECT conv_id, CAST(turn AS VARCHAR) AS id, album_id, rank FROM r WHERE rank <= 2
""")
def search_collect(spark, sf):
    """Artist search over pages of 3: keep results the source serves (here the
    first 6) credited to the artist, first occurrence per normalised name, here
    the first 2 per artist, so that pages, offset and cap all bind."""
    from cadenza.plans import fixtures
    from cadenza.sources import payloads
    pages = fixtures.conversation_search_pages(t(spark, sf, "conversations"), page_size=3)
    rows = payloads.search_tracks(pages, page_size=3).filter(F.col("ordinal") < 6)
    rows = rows.filter(payloads.credited("artists", "request_key"))
    first = ingest.dedupe_by_name(rows, ["request_key"], "name", ["ordinal"], keep_name=False)
    capped = ingest.cap_per_group(first, ["request_key"], ["ordinal"], cap=2)
    return capped.select(F.substring("request_key", 6, 20).cast("long").alias("conv_id"),
                         "id", "album_id", "rank")


@register("album_collect", _SOFT_CAP_SQL)
def album_collect(spark, sf):
    """Artist albums: album listing and album track pages parsed and joined,
    first occurrence per normalised track name in album order, whole albums
    while fewer than 20 tracks were taken before them."""
    from cadenza.plans import fixtures
    from cadenza.sources import payloads
    listing, tpages = fixtures.document_album_pages(t(spark, sf, "documents")
                                                   .select("doc_id", "source", "lang", "text"))
    rows = payloads.artist_album_tracks(listing, tpages) \
        .withColumn("album_ord", F.col("ordinal.album_ord"))
    first = ingest.dedupe_by_name(rows, ["artist_key"], "name", ["ordinal"], keep_name=False)
    kept = ingest.soft_cap(first, ["artist_key"], "album_id", ["album_ord"], 20)
    return kept.select(F.col("artist_key").alias("source"), F.col("album_name").alias("lang"),
                       F.col("id").cast("long").alias("doc_id"))


@register("album_detail", """
SELECT doc_id, lang AS album_name, concat_ws(', ', source, 'guest') AS artist_name FROM documents
""")
def album_detail(spark, sf):
    """Album detail (name, credited artists joined) attached to every track
    of the album's track pages."""
    from cadenza.plans import fixtures
    from cadenza.sources import payloads
    docs = t(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    _, tpages = fixtures.document_album_pages(docs)
    tracks = payloads.album_tracks(fixtures.document_album_details(docs), tpages)
    return tracks.select(F.col("id").cast("long").alias("doc_id"), "album_name", "artist_name")


_COLLECT_SQL = """
WITH nr AS (SELECT n.n_nationkey, n.n_name, r.r_name,
                   row_number() OVER (PARTITION BY r.r_name, floor(n.n_nationkey / 50)
                                      ORDER BY n.n_nationkey) - 1 AS pos
            FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
pl AS (SELECT r_name AS genre, n_nationkey, n_name FROM nr
       WHERE floor(n_nationkey / 50) = 0 AND pos < 2 AND n_nationkey % 7 <> 3),
cand AS (SELECT pl.genre, c.c_name AS track_name, 't' || CAST((c.c_custkey - CASE WHEN c.c_custkey % 30 >= 15 THEN 15 ELSE 0 END) AS VARCHAR) AS track_id,
                (c.c_custkey - CASE WHEN c.c_custkey % 30 >= 15 THEN 15 ELSE 0 END) AS k, c.c_mktsegment AS artist_name, pl.n_name AS album_name
         FROM pl JOIN customer c ON c.c_nationkey = pl.n_nationkey),
kept AS (SELECT * FROM cand WHERE genre = (SELECT min(genre) FROM cand c2 WHERE c2.track_id = cand.track_id))
SELECT track_name, track_id, artist_name, album_name, genre,
       CAST(NULL AS DOUBLE) AS danceability, k / 300.0 AS energy, CAST(NULL AS INTEGER) AS key,
       CAST(NULL AS DOUBLE) AS loudness, CAST(NULL AS INTEGER) AS mode,
       CAST(NULL AS DOUBLE) AS speechiness, CAST(NULL AS DOUBLE) AS acousticness,
       CAST(NULL AS DOUBLE) AS instrumentalness, CAST(NULL AS DOUBLE) AS liveness,
       CAST(NULL AS DOUBLE) AS valence, CAST(k AS DOUBLE) AS tempo
FROM kept WHERE k % 11 <> 4 AND k % 13 <> 5
"""


@register("label_collection", _COLLECT_SQL)
def label_collection(spark, sf):
    """Label-driven collection end to end (searches, playlists, first label
    wins, id lookups, features) over pages built from nation/region/customer."""
    from cadenza.plans import fixtures
    from cadenza.plans.collection import label_driven_collection
    nation, region, cust = t(spark, sf, "nation"), t(spark, sf, "region"), t(spark, sf, "customer")
    out = label_driven_collection(
        fixtures.region_label_file(nation, region),
        fixtures.region_playlist_searches(nation, region),
        fixtures.nation_playlist_pages(cust, nation),
        fixtures.customer_track_lookups(cust),
        fixtures.customer_track_features(cust))
    return out["tracks"]


_ARTIST_SQL = """
WITH s AS (SELECT s_suppkey, s_name, lower(replace(s_name, '#', '_')) AS slug FROM supplier),
todo AS (SELECT * FROM s WHERE s_suppkey % 10 <> 0),
x AS (SELECT t.s_name, t.slug, l.l_orderkey, l.l_linenumber, l.l_partkey,
             row_number() OVER (PARTITION BY t.s_name ORDER BY l.l_orderkey, l.l_linenumber,
                                l.l_partkey, l.l_discount, l.l_quantity) - 1 AS ordinal
      FROM lineitem l JOIN todo t ON l.l_suppkey = t.s_suppkey),
f AS (SELECT l_orderkey AS fo, l_linenumber AS fl, min(l_discount) AS energy,
             min(l_quantity) AS tempo FROM lineitem GROUP BY l_orderkey, l_linenumber),
c AS (SELECT * FROM x WHERE l_linenumber <> 3 AND ordinal < 300),
d AS (SELECT *, row_number() OVER (PARTITION BY slug, l_partkey % 400 ORDER BY ordinal) AS rn FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY ordinal) AS rank FROM d WHERE rn = 1)
SELECT 'p' || CAST(l_partkey % 400 AS VARCHAR) AS track_name,
       'l' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS track_id,
       s_name AS artist_name, 'o' || CAST(l_orderkey AS VARCHAR) AS album_name,
       CAST(NULL AS DOUBLE) AS danceability, energy, CAST(NULL AS INTEGER) AS key,
       CAST(NULL AS DOUBLE) AS loudness, CAST(NULL AS INTEGER) AS mode,
       CAST(NULL AS DOUBLE) AS speechiness, CAST(NULL AS DOUBLE) AS acousticness,
       CAST(NULL AS DOUBLE) AS instrumentalness, CAST(NULL AS DOUBLE) AS liveness,
       CAST(NULL AS DOUBLE) AS valence, tempo, slug
FROM r JOIN f ON r.l_orderkey = f.fo AND r.l_linenumber = f.fl
WHERE rank <= 100 AND l_orderkey % 11 <> 4 AND l_orderkey % 13 <> 5
"""


def _artist_run(spark, sf):
    from cadenza.plans import fixtures
    from cadenza.plans.collection import artist_collection
    sup, li = t(spark, sf, "supplier"), t(spark, sf, "lineitem")
    roster = fixtures.supplier_roster(sup)
    done = fixtures.supplier_roster(sup.filter(F.col("s_suppkey") % 10 == 0)).select("slug")
    return artist_collection(roster, done, fixtures.supplier_search_pages(li, sup),
                             fixtures.line_lookups(li), fixtures.line_features(li),
                             cap=100, offset_limit=300)


@register("artist_collect", _ARTIST_SQL)
def artist_collect(spark, sf):
    """Roster-driven collection end to end: pending artists, search pages,
    credited + first per name + cap 100 within the first 300 results, lookups,
    features."""
    return _artist_run(spark, sf)["tracks"]


@register("album_lookup", """
SELECT 'resolved' AS kind, lang AS name, min(source) || '/' || lang AS album_id FROM documents GROUP BY lang
UNION ALL SELECT DISTINCT 'empty', lang, source || '/' || lang FROM documents WHERE lang = 'de'
""")
def album_lookup(spark, sf):
    """Album names resolved to the first hit of their search over all its pages,
    and the albums whose track pages list nothing (here those of one language)."""
    from cadenza.plans import fixtures
    from cadenza.sources import payloads
    docs = t(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    ids = payloads.album_ids(fixtures.document_album_searches(docs)).select(
        F.lit("resolved").alias("kind"), F.col("request_key").alias("name"), "album_id")
    _, tpages = fixtures.document_album_pages(docs.filter("lang <> 'de'"))
    empty = payloads.albums_without_tracks(fixtures.document_album_details(docs), tpages)
    return ids.unionByName(empty.select(F.lit("empty").alias("kind"), F.col("album_name").alias("name"), "album_id"))
