"""Label-driven collection on hand-made landed pages."""

import json

from cadenza.plans.collection import label_driven_collection


def pages(spark, rows):
    return spark.createDataFrame([(k, p, s, json.dumps(b)) for k, p, s, b in rows],
                                 "request_key string, page_no int, status int, body string")


def track(i, artist="A"):
    return {"track": {"id": f"s{i}", "name": f"t{i}", "artists": [{"name": artist}],
                      "album": {"name": "al"}}}


def test_label_driven_collection(spark):
    labels = spark.createDataFrame([("a1", "techno, dubstep"), ("a2", "N/A"), ("a3", "acid techno")],
                                   "artist_name string, genre string")
    searches = pages(spark, [
        ("dubstep", 0, 200, {"playlists": {"items": [{"id": "p1", "name": "x"}, None,
                                                    {"id": "p9", "name": "beyond limit"}]}}),
        ("techno", 0, 200, {"playlists": {"items": [{"id": "p2", "name": "y"}, {"id": "p3", "name": "z"}]}}),
        ("acid techno", 0, 200, {"playlists": {"items": []}}),
    ])
    plist = pages(spark, [
        ("p1", 0, 200, {"items": [track(1), track(2), {"track": None}]}),
        ("p2", 0, 200, {"items": [track(2), track(3), track(4)]}),   # s2 already under dubstep
        ("p3", 0, 200, {"items": [track(3)]}),                       # s3 twice inside techno
        ("p9", 0, 200, {"items": [track(8)]}),                       # not asked for (limit 2)
    ])
    lookup = pages(spark, [("b", 0, 200, {"content": [
        {"id": "r1", "href": "x/track/s1"}, {"id": "r3", "href": "x/track/s3"},
        {"id": "r4", "href": "x/track/s4"}]})])
    feats = pages(spark, [("r1", 0, 200, {"energy": 0.9, "key": 5}), ("r3", 0, 200, {"energy": 0.5}),
                          ("r4", 0, 404, {})])
    out = label_driven_collection(labels, searches, plist, lookup, feats)
    rows = sorted((r["track_id"], r["genre"], r["energy"], r["key"]) for r in out["tracks"].collect())
    assert rows == [("s1", "dubstep", 0.9, 5), ("s3", "techno", 0.5, None), ("s3", "techno", 0.5, None)]
    assert out["tracks"].columns[4] == "genre" and len(out["tracks"].columns) == 16
    stats = {r["genre"]: (r["n_playlists"], r["n_tracks"], r["n_with_features"])
             for r in out["stats"].collect()}
    assert stats == {"acid techno": (0, 0, 0), "dubstep": (1, 2, 1), "techno": (2, 3, 2)}
    st = {(r["track_id"], r["status"]) for r in out["status"].collect()}
    assert ("s2", "no_id") in st and ("s4", "no_features") in st


def test_artist_collection(spark):
    from cadenza.plans.collection import artist_collection
    roster = spark.createDataFrame([("DJ X", "dj_x"), ("Old", "old"), ("Gone", "gone"), ("Quiet", "quiet")],
                                   "name string, slug string")
    done = spark.createDataFrame([("old",)], "slug string")
    items0 = [{"id": f"s{i}", "name": f"Song {i % 5}" if i < 10 else f"n{i}",
               "artists": [{"name": "dj x" if i % 4 else "someone"}]} for i in range(50)]
    items1 = [{"id": f"s{50 + i}", "name": f"late {i}", "artists": [{"name": "DJ X"}]} for i in range(5)]
    search = pages(spark, [("DJ X", 0, 200, {"tracks": {"items": items0}}),
                           ("DJ X", 1, 200, {"tracks": {"items": items1}}),
                           ("Gone", 0, 500, {}),
                           ("Quiet", 0, 200, {"tracks": {"items": [{"id": "q1", "name": "x",
                                                                   "artists": [{"name": "Quiet"}]}]}})])
    lookup = pages(spark, [("b", 0, 200, {"content": [{"id": f"r{i}", "href": f"t/s{i}"}
                                                      for i in range(60)]})])
    feats = pages(spark, [(f"r{i}", 0, 200, {"energy": i / 100, "tempo": 120.0}) for i in range(60)])
    out = artist_collection(roster, done, search, lookup, feats, cap=20, offset_limit=52)
    ids = sorted(int(r["track_id"][1:]) for r in out["tracks"].collect())
    # credited (i % 4 != 0), first per normalised name ("song k" repeats), ordinal < 52, cap 20
    expect, seen = [], set()
    for i in range(55):
        if i >= 52:
            break
        name = (f"Song {i % 5}" if i < 10 else f"n{i}") if i < 50 else f"late {i - 50}"
        credited = (i % 4 != 0) if i < 50 else True
        if credited and name.lower() not in seen:
            seen.add(name.lower())
            expect.append(i)
    assert ids == expect[:20]
    st = {r["slug"]: r["status"] for r in out["status"].collect()}
    assert st == {"dj_x": "collected", "old": "skipped", "gone": "failed", "quiet": "empty"}
    b = {r["batch_no"]: r["n_ids"] for r in out["batches"].filter("slug = 'dj_x'").collect()}
    assert sum(b.values()) == 20 and max(b.values()) <= 40


def test_tag_coverage_run(spark, tmp_path):
    from cadenza.plans.collection import tag_coverage_run
    from cadenza.sources import tracks
    hdr = ",".join(n for n, _ in tracks.TRACK_COLUMNS)
    d = tmp_path
    for artist, n in (("Alpha", 5), ("Beta", 3), ("Gamma", 2)):
        lines = [hdr] + [f"song{i},{artist[0]}{i},{artist},al,0.1,0.1,1,-5,1,0.1,0.1,0.1,0.1,0.1,120"
                         for i in range(n)]
        (d / f"{artist.lower()}.csv").write_text("\n".join(lines) + "\n")
    (d / "genres.csv").write_text('artist_name,genre\nalpha,"techno, house"\nBETA,dubstep\ngamma,N/A\n')
    tr = tracks.read_tracks(spark, str(d))
    lab = tracks.label_lookup_table(spark, str(d / "genres.csv"))
    tags = pages(spark, [("song0|Alpha", 0, 200, {"toptags": {"tag": [{"name": "Techno", "count": "9"},
                                                                      {"name": "seen live", "count": 1}]}}),
                         ("song1|Beta", 0, 200, {"toptags": {"tag": [{"name": "love", "count": 3}]}})])
    rep = tag_coverage_run(tr, lab, tags, target=100, per_artist=2)
    sample = rep["sample"].collect()
    assert len(sample) == 4                                  # 2 per labelled artist, gamma excluded
    assert {r["artist_name"] for r in sample} == {"Alpha", "Beta"}
    c = rep["coverage"].first()
    assert c["n_items"] == 4 and c["n_with_relevant"] <= c["n_with_tags"] <= 2
    assert rep["examples"].count() == 4
