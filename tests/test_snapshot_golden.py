"""Golden counts of the track-CSV snapshot, string-schema column."""

import pytest
from pyspark.sql import functions as F

from conftest import SNAPSHOT


@pytest.fixture(scope="module")
def prep(spark):
    from cadenza.plans.experiments import prepare_training_data
    return prepare_training_data(spark, SNAPSHOT)


def test_stage_counts(prep):
    r = prep["report"].first()
    assert prep["raw"].count() == 6307
    assert (r["n_total"], r["n_labelled"], r["n_dropped"]) == (6307, 6085, 222)
    assert (r["n_before"], r["n_after"]) == (50, 34)
    assert r["n_outliers"] == 6085 - 4868
    assert prep["df"].count() == 4868


def test_all_digit_artists_kept(prep):
    raw = prep["raw"]
    n = raw.filter(F.col("artist_name").isin("1991", "999999999")).count()
    assert n == 90


def test_features_and_fences(prep):
    assert prep["features"] == ["danceability", "energy", "speechiness",
                                "instrumentalness", "valence", "tempo"]
    lo, hi = prep["fences"]["tempo"]
    assert round(lo, 4) == 95.019 and round(hi, 4) == 175.019
    lo, hi = prep["fences"]["danceability"]
    assert round(lo, 4) == 0.2 and round(hi, 4) == 1.072


def test_scaler_stats(prep):
    mu, sd = prep["stats"]["tempo"]
    assert round(mu, 6) == 135.390065 and round(sd, 6) == 14.825349
    mu, sd = prep["stats"]["energy"]
    assert round(mu, 6) == 0.843224 and round(sd, 6) == 0.133866


def test_classes_and_balance(spark, prep):
    from cadenza.operators import sampling
    df = prep["df"]
    s = sampling.class_summary(df, "primary_genre").first()
    assert (s["n_classes"], s["cap"]) == (20, 86)
    top = [tuple(r) for r in sampling.class_counts(df, "primary_genre").limit(3).collect()]
    assert top == [("house", 1245), ("bass music", 768), ("techno", 653)]
    df = df.withColumn("k", F.concat_ws("|", "artist_name", "track_id"))
    assert sampling.balance_classes(df, "primary_genre", "k").count() == 1354
    kept = sampling.support_filter(df, "primary_genre", 30)
    assert kept.count() == 4803
    assert kept.select("primary_genre").distinct().count() == 17
