"""Payload parsers and sources on hand-made JSON / CSV fixtures."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from cadenza.sources import payloads, tracks


def landed(spark, rows):
    return spark.createDataFrame(
        [(k, p, s, json.dumps(b) if not isinstance(b, str) else b) for k, p, s, b in rows],
        "request_key string, page_no int, status int, body string")


def test_search_tracks_defaults_membership_and_dedupe(spark):
    from cadenza.operators import ingest
    body0 = {"tracks": {"items": [
        {"id": "t1", "name": "Song", "artists": [{"name": "DJ X"}], "album": {"id": "a1", "name": "A"}},
        {"id": "t2", "name": "song ", "artists": [{"name": "dj x"}]},
        {"id": "t3", "name": "Other", "artists": [{"name": "Someone"}]},
    ]}}
    body1 = {"tracks": {"items": [{"id": "t4", "name": "New", "artists": [{"name": "DJ X"}, {"name": "Y"}]}]}}
    df = payloads.search_tracks(landed(spark, [("DJ X", 0, 200, body0), ("DJ X", 1, 200, body1)]))
    rows = {r["id"]: r for r in df.collect()}
    assert rows["t2"]["album_name"] == "" and rows["t2"]["album_id"] == ""
    assert rows["t4"]["ordinal"] == 50
    mine = df.filter(payloads.credited("artists", "request_key"))
    assert sorted(r["id"] for r in mine.collect()) == ["t1", "t2", "t4"]
    first = ingest.dedupe_by_name(mine, ["request_key"], "name", ["ordinal"])
    assert sorted(r["id"] for r in first.collect()) == ["t1", "t4"]


def test_playlists_nulls_limit_and_tracks(spark):
    search = {"playlists": {"items": [None, {"id": "p1", "name": "P1"},
                                      {"id": "p2", "name": "P2", "owner": {"display_name": "o"},
                                       "tracks": {"total": 7}}]}}
    pl = payloads.search_playlists(landed(spark, [("techno", 0, 200, search)]))
    got = sorted((r["id"], r["owner"], r["track_count"]) for r in pl.collect())
    assert got == [("p1", "", 0), ("p2", "o", 7)]
    lim = payloads.search_playlists(landed(spark, [("techno", 0, 200, search)]), limit=2)
    assert [r["id"] for r in lim.collect()] == ["p1"]
    tr = {"items": [{"track": None}, {"track": {"name": "n"}},
                    {"track": {"id": "x", "name": "n", "artists": [{"name": "A"}, {"name": "B"}]}}]}
    rows = payloads.playlist_tracks(landed(spark, [("p1", 0, 200, tr)])).collect()
    assert [(r["id"], r["artist_name"], r["album_name"]) for r in rows] == [("x", "A, B", "")]


def test_id_map_last_wins_and_features(spark):
    p0 = {"content": [{"id": "r1", "href": "https://x/track/S1"}, {"id": "r2"},
                      {"href": "https://x/track/S3"}, {"id": "r9", "href": "https://x/track/S1"}]}
    p1 = {"content": [{"id": "r5", "href": "https://x/track/S1"}]}
    m = payloads.id_map(landed(spark, [("b", 0, 200, p0), ("b", 1, 200, p1)]))
    assert {r["ext_id"]: r["id"] for r in m.collect()} == {"S1": "r5"}
    feats = payloads.audio_features(landed(spark, [("r1", 0, 200, {"energy": 0.5, "tempo": 120}),
                                                   ("r2", 0, 404, "")]))
    rows = feats.collect()
    assert len(rows) == 1 and rows[0]["energy"] == 0.5 and rows[0]["key"] is None


def test_album_detail_and_tags(spark):
    alb = payloads.album_detail(landed(spark, [("a", 0, 200, {"name": "LP", "artists": [{"name": "A"}, {"name": "B"}]})]))
    assert alb.first()["artist_name"] == "A, B"
    good = {"toptags": {"tag": [{"name": "techno", "count": "100"}, {"name": "seen live", "count": 3}]}}
    single = {"toptags": {"tag": {"name": "techno", "count": "1"}}}
    bad = {"toptags": {"tag": [{"name": "techno", "count": "many"}]}}
    t = payloads.top_tags(landed(spark, [("g", 0, 200, good), ("s", 0, 200, single),
                                         ("b", 0, 200, bad), ("m", 0, 200, {})]))
    got = {r["request_key"]: [(x["name"], x["count"]) for x in r["tags"]] for r in t.collect()}
    assert got == {"g": [("techno", 100), ("seen live", 3)], "s": [], "b": [], "m": []}


def test_album_tracks_without_ids_empty_albums_and_names(spark):
    detail = landed(spark, [(k, 0, 200, {"name": n, "artists": [{"name": "A"}, {"name": "B"}]}) for k, n in (("a1", "LP"), ("a2", "EP"), ("a3", "No ids"))])
    pages = landed(spark, [("a1", 0, 200, {"items": [{"id": "t1", "name": "x"}, {"id": None, "name": "y"}, {"id": "", "name": "z"}]}),
                           ("a1", 1, 200, {"items": [{"id": "t2", "name": "w"}]}), ("a2", 0, 200, {"items": []}),
                           ("a3", 0, 200, {"items": [{"name": "only"}]})])
    got = payloads.album_tracks(detail, pages).select("album_id", "id", "album_name", "artist_name").collect()
    assert sorted(map(tuple, got)) == [("a1", "t1", "LP", "A, B"), ("a1", "t2", "LP", "A, B")]
    assert [tuple(r) for r in payloads.albums_without_tracks(detail, pages).collect()] == [("a2", "EP")]
    hits = landed(spark, [("lp", 1, 200, {"albums": {"items": [{"id": "a9"}]}}), ("lp", 0, 200, {"albums": {"items": [{"id": "a1"}, {"id": "a2"}]}}),
                          ("none", 0, 200, {"albums": {"items": []}})])
    assert [tuple(r) for r in payloads.album_ids(hits).collect()] == [("lp", "a1")]


def test_album_tracks_join(spark):
    albums = {"items": [{"id": "A1", "name": "First"}, {"id": "A2", "name": "Second"}], "next": None}
    t1 = {"items": [{"id": "t1", "name": "x"}, {"id": "t2", "name": "y"}]}
    t2 = {"items": [{"id": "t3", "name": "x"}]}
    rows = payloads.artist_album_tracks(landed(spark, [("art", 0, 200, albums)]),
                                        landed(spark, [("A1", 0, 200, t1), ("A2", 0, 200, t2)]))
    got = sorted((r["album_name"], r["id"]) for r in rows.collect())
    assert got == [("First", "t1"), ("First", "t2"), ("Second", "t3")]


def test_seeds_sinks_and_first_artist(spark):
    d = tempfile.mkdtemp(prefix="cadenza-src-")
    with open(os.path.join(d, "seeds.txt"), "w") as f:
        f.write("subgenre, playlist_id\ntechno, https://open.example/playlist/AbC123?si=z\n"
                "trap, https://open.example/playlist/Zz9")
    seeds = tracks.read_seeds(spark, os.path.join(d, "seeds.txt")).collect()
    assert [(r["subgenre"], r["playlist_id"]) for r in seeds] == [("techno", "AbC123"), ("trap", "Zz9")]
    empty = spark.createDataFrame([], tracks.TRACK_SCHEMA)
    assert tracks.write_tracks(empty, os.path.join(d, "none")) is False
    assert not os.path.exists(os.path.join(d, "none"))
    lab = spark.createDataFrame([("n", "i", "A", "al", "techno") + (0.1,) * 2 + (1, -5.0, 1) + (0.1,) * 6],
                                ",".join(f"{n} {t}" for n, t in tracks.LABELLED_COLUMNS))
    out = os.path.join(d, "lab")
    assert tracks.write_labelled(lab.select(*reversed(lab.columns)), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == [n for n, _ in tracks.LABELLED_COLUMNS]
    hdr = ",".join(n for n, _ in tracks.TRACK_COLUMNS)
    for name, artist in (("b.csv", "Zed"), ("a.csv", "Zed"), ("c.csv", "")):
        with open(os.path.join(d, name), "w") as f:
            f.write(hdr + "\n" + f"t,{name},{artist},al,0.1,0.1,1,-5,1,0.1,0.1,0.1,0.1,0.1,120\n")
    t = tracks.read_tracks(spark, [os.path.join(d, n) for n in ("a.csv", "b.csv", "c.csv")])
    kept = tracks.tracks_by_first_artist(t).collect()
    assert [(r["artist"], r["file_name"]) for r in kept] == [("Zed", "b.csv")]


def test_label_lookup_last_row_wins_and_append_sink(spark, tmp_path):
    p = tmp_path / "labels.csv"
    p.write_text('artist_name,genre\nDJ X,techno\nother,house\ndj x,"dubstep, riddim"\n')
    lut = {r["artist_key"]: r["genre"] for r in tracks.label_lookup_table(spark, str(p)).collect()}
    assert lut == {"dj x": "dubstep, riddim", "other": "house"}
    out = str(tmp_path / "sink")
    row = ("n", "i", "A", "al") + (0.1,) * 2 + (1, -5.0, 1) + (0.1,) * 6
    one = spark.createDataFrame([row], tracks.TRACK_SCHEMA)
    assert tracks.write_tracks(one, out, fmt="csv")
    assert tracks.write_tracks(one, out, fmt="csv", mode="append")
    back = tracks.read_tracks(spark, out, exclude_files=())
    assert back.count() == 2 and back.first()["artist_name"] == "A"


def test_only_wanted_lookups_and_features_of_rows_are_parsed(spark):
    look = landed(spark, [("b", 0, 200, {"content": [{"id": f"r{i}", "href": f"t/s{i}"} for i in range(6)]}),
                          ("b", 1, 200, {"content": [{"id": "late", "href": "t/s2"}]})])
    wanted = spark.createDataFrame([("s2",), ("s2",), ("s9",), (None,)], "ext_id string")
    assert [tuple(r) for r in payloads.id_map(look, wanted).collect()] == [("s2", "late")]
    rows = spark.createDataFrame([("a", "f1"), ("b", "f1"), ("c", "f2"), ("d", "f3"), ("e", None)], "id string, feature_id string")
    feats = landed(spark, [("f1", 0, 200, {"energy": 0.5}), ("f1", 1, 200, {"energy": 0.7}), ("f2", 0, 404, {"energy": 1.0}),
                           ("f3", 0, 200, "[1]"), ("f9", 0, 200, {"energy": 2.0})])
    got = payloads.features_of(rows, feats, "feature_id", "id")
    plain = rows.join(payloads.audio_features(feats).withColumnRenamed("request_key", "feature_id"), "feature_id")
    pick = lambda df: sorted((r["id"], r["energy"]) for r in df.collect())
    assert pick(got) == pick(plain) == [("a", 0.5), ("a", 0.7), ("b", 0.5), ("b", 0.7)]
    # parsed behind the join, not in a filter of all landed pages
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("get_json_object" in x for x in plan if "Join Inner" in x)
    assert not any("get_json_object" in x for x in plan if "Filter" in x)
