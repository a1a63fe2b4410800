"""Label-driven collection as one Spark plan.

For every label token (sorted), the landed playlist searches give up to
``playlists_per_label`` playlists; their landed track pages give candidate
tracks.  A track belongs to the first label (in sorted order) under which it
was found, with or without features.  The surviving tracks are looked up
(external id -> feature id) and joined to their feature payloads; tracks
without an id or without features are reported, not kept.  Output: the
labelled 16-column track table and per-label counts (zero for labels that
got nothing).

All inputs are landed pages ``(request_key, page_no, status, body)``:

* playlist searches keyed by label,
* playlist track pages keyed by playlist id,
* id-lookup pages (any key),
* feature payloads keyed by feature id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.vocab import SEARCH_CAP, SEARCH_OFFSET_LIMIT
from cadenza.operators import ingest, labels
from cadenza.sources import payloads
from cadenza.sources.tracks import LABELLED_COLUMNS


def label_driven_collection(label_file: DataFrame, playlist_searches: DataFrame,
                            playlist_pages: DataFrame, lookup_pages: DataFrame,
                            feature_pages: DataFrame, playlists_per_label: int = 2) -> dict:
    """Returns ``{"tracks": labelled rows, "stats": per-label counts,
    "status": per-track lookup status}``."""
    tokens = labels.unique_label_tokens(label_file, "genre")           # sorted labels
    found = payloads.search_playlists(playlist_searches, limit=playlists_per_label) \
        .join(tokens, F.col("request_key") == F.col("genre"), "left_semi") \
        .select(F.col("request_key").alias("genre"), F.col("id").alias("playlist_id"))
    tracks = payloads.playlist_tracks(playlist_pages).select(
        F.col("request_key").alias("playlist_id"), F.col("id").alias("track_id"),
        F.col("name").alias("track_name"), "artist_name", "album_name")
    candidates = found.join(tracks, "playlist_id")
    kept = ingest.first_label_wins(candidates, "track_id", "genre")

    idmap = payloads.id_map(lookup_pages)                               # ext_id -> id
    feats = payloads.audio_features(feature_pages).withColumnRenamed("request_key", "feature_id")
    status = ingest.lookup_status(kept, idmap, "track_id", "ext_id", feats, "feature_id", "id")
    with_ids = kept.join(idmap.withColumnRenamed("ext_id", "track_id")
                         .withColumnRenamed("id", "feature_id"), "track_id")
    labelled = with_ids.join(feats, "feature_id").select(
        *[F.col(n).cast(t) for n, t in LABELLED_COLUMNS])

    stats = ingest.label_stats(
        found, status.withColumn("__feat", F.col("status") == "collected"),
        "genre", "playlist_id", "__feat", all_labels=tokens)
    return {"tracks": labelled, "stats": stats.orderBy("genre"), "status": status}


def artist_collection(roster: DataFrame, done: DataFrame, search_pages: DataFrame,
                      lookup_pages: DataFrame, feature_pages: DataFrame,
                      cap: int | None = SEARCH_CAP,
                      offset_limit: int | None = SEARCH_OFFSET_LIMIT, page_size: int = 50) -> dict:
    """Roster-driven collection: artists whose output exists are skipped;
    for the others the landed search pages (keyed by the artist's search
    name) give credited tracks, first per normalised name, at most ``cap``
    within the first ``offset_limit`` results (None: unlimited); tracks are
    looked up in batches and joined to their features.  Pages of artists that
    are not pending, and pages beyond the offset, are not parsed.

    Returns ``{"tracks": rows (15 columns + slug), "batches": lookup batches,
    "status": one row per roster entry with collected / empty / skipped /
    failed}``.  'failed' = a landed search page for the artist is not 200;
    'empty' = searched but no row with features (stays pending next run).
    """
    from cadenza.sources.tracks import TRACK_COLUMNS
    todo = ingest.pending(roster, done, "slug").select(F.col("name").alias("request_key"), "slug")
    wanted = search_pages.join(todo.select("request_key").distinct(), "request_key", "left_semi")
    if offset_limit is not None:
        wanted = wanted.filter(F.col("page_no") * page_size < offset_limit)
    found = payloads.search_tracks(wanted, page_size)
    if offset_limit is not None:
        found = found.filter(F.col("ordinal") < offset_limit)
    found = found.join(todo, "request_key")
    found = found.filter(payloads.credited("artists", "request_key"))
    first = ingest.dedupe_by_name(found, ["slug"], "name", ["ordinal"])
    capped = ingest.cap_per_group(first, ["slug"], ["ordinal"], cap=cap)
    batches = ingest.batches(capped, ["slug"], "id", "rank")

    idmap = payloads.id_map(lookup_pages, capped.select(F.col("id").alias("ext_id"))).select(
        F.col("ext_id").alias("id"), F.col("id").alias("feature_id"))
    rows = payloads.features_of(capped.join(idmap, "id"), feature_pages, "feature_id", "id")
    tracks = rows.select(F.col("name").alias("track_name"), F.col("id").alias("track_id"),
                         F.col("request_key").alias("artist_name"), "album_name",
                         *[F.col(n).cast(t) for n, t in TRACK_COLUMNS[4:]], "slug")

    failed = (search_pages.filter(F.coalesce(F.col("status"), F.lit(200)) != 200)
              .select(F.col("request_key").alias("name")).distinct().withColumn("__failed", F.lit(True)))
    produced = tracks.groupBy("slug").agg(F.count(F.lit(1)).alias("n_tracks"))
    skipped = done.select("slug").distinct().withColumn("__skip", F.lit(True))
    st = (roster.join(skipped, "slug", "left").join(failed, "name", "left")
          .join(produced, "slug", "left"))
    status = st.select("name", "slug", F.coalesce("n_tracks", F.lit(0)).alias("n_tracks"),
                       F.when(F.col("__skip"), F.lit("skipped"))
                       .when(F.col("__failed"), F.lit("failed"))
                       .when(F.col("n_tracks") > 0, F.lit("collected"))
                       .otherwise(F.lit("empty")).alias("status"))
    return {"tracks": tracks, "batches": batches, "status": status}


def tag_coverage_run(tracks: DataFrame, label_table: DataFrame, tag_pages: DataFrame,
                     target: int = 100, per_artist: int = 2, seed: int | None = None) -> dict:
    """Tag coverage of a spread sample of tracks.

    ``tracks`` come from ``sources.tracks.read_tracks`` (files keyed by the
    artist of their first row), ``label_table`` from ``label_lookup_table``
    (lower(artist) -> genre, 'N/A' when absent), ``tag_pages`` are landed tag
    payloads keyed ``track_name|artist_name``.  Unlabelled artists are not
    sampled; classes come in shuffled order, at most ``per_artist`` tracks per
    artist, ``target`` tracks in all.  Tracks without a tag payload count as
    untagged.
    """
    from cadenza.functions.exprs import first_token
    from cadenza.functions.vocab import SEED
    from cadenza.operators import sampling
    from cadenza.plans.experiments import coverage_report
    from cadenza.sources.tracks import tracks_by_first_artist
    seed = SEED if seed is None else seed
    keyed = tracks_by_first_artist(tracks)
    looked = labels.lookup_with_default(keyed, label_table, "artist", "artist_key", "genre", "genre")
    labelled = looked.filter(F.col("genre") != "N/A").withColumn("primary", first_token("genre")) \
        .withColumn("__key", F.concat_ws("|", "track_name", "artist_name"))
    sample = sampling.spread_sample(labelled, "primary", "artist", "__key", target, per_artist, seed)
    tags = payloads.top_tags(tag_pages).withColumnRenamed("request_key", "__key")
    empty = F.array().cast("array<struct<name:string,count:int>>")
    joined = sample.join(tags, "__key", "left").withColumn("tags", F.coalesce("tags", empty))
    rep = coverage_report(joined, "tags", "genre")
    rep["sample"] = joined.select("track_name", "artist_name", "genre", "tags")
    rep["examples"] = sampling.example_rows(joined, "__key", 10, seed).select(
        "track_name", "artist_name", "genre", F.slice("tags", 1, 15).alias("tags"))
    return rep
