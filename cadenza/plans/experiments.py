"""End-to-end experiments over a folder of track CSVs and a label file.

``prepare_training_data`` -> ``unsupervised_experiment`` /
``supervised_experiment``; ``coverage_report`` for tag payloads.  Results are
small DataFrames / dicts; nothing large is collected.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.vocab import (
    DROP_FEATURES, GENRE_CONSOLIDATION, IQR_THRESHOLD, LABEL_FILE, MIN_CLASS_SUPPORT, SEED,
    TEST_FRACTION,
)
from cadenza.operators import (
    classify, clean, clusters, coverage, labels, metrics, sampling,
)
from cadenza.session import materialize
from cadenza.sources import tracks


def prepare_training_data(spark: SparkSession, data_dir: str, label_file: str = LABEL_FILE,
                          threshold: float = IQR_THRESHOLD) -> dict:
    """Raw CSVs -> labelled, consolidated, outlier-free, standardised tracks.

    Returns ``df`` (cleaned rows with ``genres``, ``genres_consolidated``,
    ``primary_genre`` and standardised ``z_<feature>`` columns), ``features``,
    ``stats`` (mean, population std per feature), ``fences`` and a one-row
    ``report`` of the counts of every stage.
    """
    raw = tracks.read_tracks(spark, data_dir, exclude_files=(label_file,))
    lab = tracks.read_labels(spark, os.path.join(data_dir, label_file))
    # label work runs once per artist on the dimension, not once per track
    lab = labels.consolidate_labels(lab, "genre", GENRE_CONSOLIDATION, "genres_consolidated")
    lab = labels.primary_label(lab, "genres_consolidated", "primary_genre")
    joined = labels.attach_labels(raw, lab, extra_cols=("genres_consolidated", "primary_genre"))
    kept = labels.keep_labelled(joined, "genres")
    consolidated = clean.drop_features(kept, DROP_FEATURES)
    features = clean.numeric_columns(consolidated)
    base = materialize(consolidated)
    fences = clean.collect_fences(clean.iqr_fences(base, features, threshold))
    filtered = clean.remove_outliers(base, features, threshold, fences=fences)
    scaled, stats = clean.scale(filtered, features, suffix="__z")
    for f in features:
        scaled = scaled.withColumnRenamed(f + "__z", "z_" + f)
    drop = labels.label_drop_report(joined, "genres")
    toks = labels.token_counts(base, "genres", "genres_consolidated")
    out_n = clean.outlier_report(base, features, threshold, fences=fences)
    merged = {**drop.first().asDict(), **toks.first().asDict(),
              **out_n.select("n_outliers", "pct_outliers").first().asDict()}
    report = spark.createDataFrame([tuple(merged.values())], list(merged))   # one row
    return {"df": scaled, "features": features, "stats": stats, "fences": fences,
            "report": report, "raw": raw, "base": base, "threshold": threshold}


def unsupervised_experiment(spark: SparkSession, prep: dict, k_values=range(2, 16),
                            n_init: int = 10, seed: int = SEED) -> dict:
    """Balance by primary genre, sweep k, compare {2, best, 10, 15}."""
    df = prep["df"]
    zf = ["z_" + f for f in prep["features"]]
    df = df.withColumn("track_key", F.concat_ws("|", "artist_name", "track_id"))
    balanced = sampling.balance_classes(df, "primary_genre", "track_key", seed)
    vec = balanced.withColumn("vec", F.array(*[F.col(c) for c in zf]))
    sweep, models = clusters.kmeans_sweep(vec, "track_key", "vec", k_values, n_init, seed)
    best = clusters.best_k(sweep)
    ks = sorted({2, best, 10, 15} & set(k_values)) or [best]
    data = clusters.to_vector(vec, "vec")
    rows, profiles, crosstabs = [], {}, {}
    for k in ks:
        pred = models[k].transform(data)
        ag = metrics.cluster_agreement(pred, "cluster", "primary_genre").first()
        rows.append((k, float(ag["ari"]), float(ag["nmi"])))
        profiles[k] = clusters.cluster_profiles_cols(pred, "cluster", prep["features"])
        crosstabs[k] = metrics.contingency(pred, "cluster", "primary_genre")
    agree = spark.createDataFrame(rows, "k int, ari double, nmi double")
    summary = sweep.join(agree, "k")
    best_nmi = summary.orderBy(F.desc("nmi"), F.asc("k")).first()["k"]
    return {"sweep": sweep, "summary": summary, "best_k": best, "best_nmi_k": best_nmi,
            "profiles": profiles, "crosstabs": crosstabs, "balanced": balanced}


def _fit_on_train(prep: dict, min_support: int, test_fraction: float, seed: int):
    """Split first, then fit fences and scaler on the training rows only and
    apply them to both splits (no test information reaches the cleaning)."""
    feats = prep["features"]
    base = prep["base"].withColumn("track_key", F.concat_ws("|", "artist_name", "track_id"))
    kept = sampling.support_filter(base, "primary_genre", min_support)
    split = materialize(sampling.stratified_split(kept, "primary_genre", "track_key",
                                                  test_fraction, seed))
    train = split.filter(F.col("split") == "train")
    fences = clean.collect_fences(clean.iqr_fences(train, feats, prep["threshold"]))
    filtered = clean.remove_outliers(split, feats, fences=fences)
    stats = clean.collect_stats(clean.feature_stats(
        filtered.filter(F.col("split") == "train"), feats))
    scaled, _ = clean.scale(filtered, feats, stats=stats, suffix="__z")
    for f in feats:
        scaled = scaled.withColumnRenamed(f + "__z", "z_" + f)
    return kept, scaled


def supervised_experiment(spark: SparkSession, prep: dict, min_support: int = MIN_CLASS_SUPPORT,
                          test_fraction: float = TEST_FRACTION, seed: int = SEED,
                          presets=classify.PRESETS, fit_on: str = "all") -> dict:
    """Support filter, stratified split, balanced weights, three models.

    ``fit_on='all'`` keeps the studied order (fences and scaler fitted on all
    rows before the split); ``fit_on='train'`` fits them on the training
    split only.
    """
    zf = ["z_" + f for f in prep["features"]]
    if fit_on == "all":
        df = prep["df"].withColumn("track_key", F.concat_ws("|", "artist_name", "track_id"))
        kept = sampling.support_filter(df, "primary_genre", min_support)
        split = sampling.stratified_split(kept, "primary_genre", "track_key", test_fraction, seed)
    elif fit_on == "train":
        kept, split = _fit_on_train(prep, min_support, test_fraction, seed)
        df = prep["base"]
    else:
        raise ValueError("fit_on must be 'all' or 'train'")
    data = materialize(clusters.to_vector(split, zf))
    train = sampling.class_weights(data.filter(F.col("split") == "train"), "primary_genre")
    test = data.filter(F.col("split") == "test")
    comp, models, indexer = classify.compare_models(train, test, "primary_genre",
                                                    prep["features"], presets, seed=seed)
    best = classify.best_model_name(comp)
    imp = classify.importance_table(spark, models[best], prep["features"])
    enc_test = indexer.transform(test)
    reports = {name: metrics.classification_report(
                   classify.decode_labels(m.transform(enc_test), indexer), "primary_genre",
                   "pred_label")
               for name, m in models.items()}
    return {"comparison": comp, "best_model": best, "importances": imp, "reports": reports,
            "dropped": sampling.dropped_classes(df, "primary_genre", min_support),
            "summary": sampling.class_summary(kept, "primary_genre")}


def coverage_report(sample: DataFrame, tags_col: str = "tags", genre_col: str = "genre") -> dict:
    """Tag coverage of a sample whose ``tags`` are ``array<struct<name,count>>``."""
    items = coverage.item_tag_counts(sample, [genre_col], tags_col, name_field="name")
    return {"tagged": coverage.split_tags(sample, tags_col, name_field="name"),
            "coverage": coverage.coverage(items),
            "top": coverage.top_tags(sample, tags_col, name_field="name"),
            "by_class": coverage.coverage_by_class(items, genre_col)}
