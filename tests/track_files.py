"""A small folder of track CSVs, made by rule, for the end-to-end experiments."""

import csv
import os

import numpy as np

FEATURES = ["danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness", "instrumentalness",
            "liveness", "valence", "tempo"]
GENRES = ["house", "techno", "trance, house", "dubstep", "techno, house", "N/A", "", "drum and bass"]


def write_folder(folder: str, artists: int = 64, tracks: int = 24) -> tuple[list[dict], dict[str, str]]:
    """Write one file per artist and the label list; return all rows and labels."""
    rng = np.random.default_rng(12)
    rows, labels = [], {}
    for a in range(artists):
        name = "1991" if a == 3 else f"Artist, \"{a}\"" if a == 5 else f"Artist {a}"
        genre = GENRES[a % len(GENRES)]
        if a % 16 != 15:                                 # the others have no label row
            labels[name.lower()] = genre
        own = []
        for i in range(tracks + a % 5):
            r = {"track_name": "" if i == 0 and a == 7 else f"Track {a}-{i}", "track_id": f"id{a}_{i}", "artist_name": name, "album_name": f"Al {i % 3}"}
            centre = (a % len(GENRES)) / len(GENRES)
            for f in FEATURES:
                v = centre * 0.3 + rng.normal(0.4, 0.08) if f != "tempo" else 110 + 40 * centre + rng.normal(0, 6)
                if rng.random() < 0.01:
                    v *= 3
                r[f] = int(rng.integers(0, 12)) if f == "key" else int(rng.integers(0, 2)) if f == "mode" else round(float(v), 4)
            own.append(r)
        names = list(own[0])
        if a % 4 == 1:                                   # another column order
            names = names[::-1]
        with open(os.path.join(folder, f"artist_{a}.csv"), "w", newline="", encoding="utf-8") as f:
            w = csv.DictWriter(f, names)
            w.writeheader()
            w.writerows(own)
        rows += own
    with open(os.path.join(folder, "genres.csv"), "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(["artist_name", "genre"])
        w.writerows([(k.title() if k != "1991" else k, v) for k, v in labels.items()])
    return rows, labels
