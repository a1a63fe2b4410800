"""Driver-table queries: label join, lookup, consolidation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import clean, labels
from cadenza.plans.registry import (
    r6, register, sql_consolidate, sql_missing, sql_strip, t,
)

# Consolidation map for the part-name token lists (our fixture, not fixed values).
PART_FAMILIES = {
    "small": "compact", "ring": "compact", "economy": "compact",
    "large": "bulky", "anvil": "bulky", "promo": "bulky",
    "red": "color", "blue": "color",
    "hot": "temperature", "cold": "temperature",
}
# Families for the document quality labels of the flagship slice.
DOC_FAMILIES = {"prose": "text", "clean": "text", "junk": "noise"}

_DOC_GENRE_SQL = ("CASE WHEN toxic = 1 THEN 'N/A' WHEN quality = 1 THEN 'prose, clean' "
                  "ELSE 'junk, clean' END")


def _doc_label_dim(spark, sf):
    lab = t(spark, sf, "labels")
    genre = (F.when(F.col("toxic") == 1, F.lit("N/A"))
             .when(F.col("quality") == 1, F.lit("prose, clean"))
             .otherwise(F.lit("junk, clean")))
    return lab.select(F.concat(F.lit("DOC_"), F.col("doc_id").cast("string")).alias("artist_name"),
                      genre.alias("genre"))


def flagship(spark, sf):
    """Label join -> keep labelled -> consolidate -> primary label -> IQR
    filter on n_chars -> per (class, lang) size and mean length."""
    docs = t(spark, sf, "documents").select(
        "doc_id", "lang", "n_chars",
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("artist_name"))
    # consolidation and the primary label are computed once per label row
    dim = labels.consolidate_labels(_doc_label_dim(spark, sf), "genre", DOC_FAMILIES)
    dim = labels.primary_label(dim, "genres_consolidated", "primary_genre")
    df = labels.attach_labels(docs, dim, extra_cols=("primary_genre",))
    df = labels.keep_labelled(df, "genres")
    df = clean.remove_outliers(df, ["n_chars"])
    return df.groupBy("primary_genre", "lang").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("n_chars")).alias("mean_n_chars"))


FLAGSHIP_SQL = f"""
WITH f AS (SELECT doc_id, lang, n_chars, 'doc_' || CAST(doc_id AS VARCHAR) AS artist_name
           FROM documents),
d AS (SELECT 'DOC_' || CAST(doc_id AS VARCHAR) AS artist_name, {_DOC_GENRE_SQL} AS genre
      FROM labels),
j AS (SELECT f.*, d.genre AS genres FROM f LEFT JOIN d ON lower(f.artist_name) = lower(d.artist_name)),
l AS (SELECT * FROM j WHERE NOT {sql_missing('genres')}),
c AS (SELECT *, {sql_consolidate('genres', DOC_FAMILIES)} AS gc FROM l),
p AS (SELECT *, {sql_strip("split_part(gc, ',', 1)")} AS primary_genre FROM c),
fe AS (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM p),
k AS (SELECT p.* FROM p, fe WHERE p.n_chars IS NULL OR
      (p.n_chars >= fe.q1 - 1.5 * (fe.q3 - fe.q1) AND p.n_chars <= fe.q3 + 1.5 * (fe.q3 - fe.q1)))
SELECT primary_genre, lang, count(*) AS n, round(avg(n_chars), 6) AS mean_n_chars
FROM k GROUP BY primary_genre, lang
"""
register("flagship", FLAGSHIP_SQL)(flagship)


def _region_dim(spark, sf):
    nation = t(spark, sf, "nation").filter(F.col("n_regionkey").isin(0, 1, 2))
    region = t(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey) \
        .select(F.col("n_name").alias("artist_name"), F.col("r_name").alias("genre"))


def _customer_facts(spark, sf):
    return t(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string")).alias("artist_key"))


@register("label_join", f"""
WITH dim AS (SELECT n.n_name AS artist_name, r.r_name AS genre
             FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
             WHERE n.n_regionkey IN (0, 1, 2)),
f AS (SELECT c_custkey, 'Nation_' || CAST(c_nationkey AS VARCHAR) AS artist_key FROM customer)
SELECT f.c_custkey, f.artist_key, d.genre AS genres
FROM f LEFT JOIN dim d ON lower(f.artist_key) = lower(d.artist_name)
WHERE NOT {sql_missing('d.genre')}
""")
def label_join(spark, sf):
    df = labels.attach_labels(_customer_facts(spark, sf), _region_dim(spark, sf),
                              fact_key="artist_key")
    return labels.keep_labelled(df, "genres").select("c_custkey", "artist_key", "genres")


@register("label_drop_report", f"""
WITH dim AS (SELECT n.n_name AS artist_name, r.r_name AS genre
             FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
             WHERE n.n_regionkey IN (0, 1, 2)),
f AS (SELECT c_custkey, 'Nation_' || CAST(c_nationkey AS VARCHAR) AS artist_key FROM customer),
j AS (SELECT d.genre AS genres FROM f LEFT JOIN dim d ON lower(f.artist_key) = lower(d.artist_name))
SELECT count(*) AS n_total,
       count(*) FILTER (WHERE NOT {sql_missing('genres')}) AS n_labelled,
       count(*) FILTER (WHERE {sql_missing('genres')}) AS n_dropped
FROM j
""")
def label_drop_report(spark, sf):
    df = labels.attach_labels(_customer_facts(spark, sf), _region_dim(spark, sf),
                              fact_key="artist_key")
    return labels.label_drop_report(df, "genres")


def _doc_lookup(spark, sf):
    docs = t(spark, sf, "documents").select(
        "doc_id", "lang", F.col("doc_id").cast("string").alias("k"))
    dim = t(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("k"),
                                        F.col("quality").cast("string").alias("q"))
    return labels.lookup_with_default(docs, dim, "k", "k", "q", "quality_label").drop("k")


@register("label_lookup", """
SELECT d.doc_id, d.lang, coalesce(CAST(l.quality AS VARCHAR), 'N/A') AS quality_label
FROM documents d LEFT JOIN labels l ON lower(CAST(d.doc_id AS VARCHAR)) = lower(CAST(l.doc_id AS VARCHAR))
""")
def label_lookup(spark, sf):
    return _doc_lookup(spark, sf)


@register("lookup_coverage", """
WITH j AS (SELECT d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT lang, count(*) AS n_total, count(quality) AS n_found,
       round(100.0 * count(quality) / count(*), 6) AS pct_found
FROM j GROUP BY lang
""")
def lookup_coverage(spark, sf):
    df = _doc_lookup(spark, sf)
    found = F.col("quality_label") != F.lit("N/A")
    return df.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(found).alias("n_found"),
        r6(F.count_if(found) * 100.0 / F.count(F.lit(1))).alias("pct_found"))


def _part_labels(spark, sf):
    part = t(spark, sf, "part")
    words = F.split(F.col("p_name"), " ")
    genres = F.concat_ws(", ", words.getItem(0), words.getItem(1), F.lower(F.col("p_type")))
    return part.select("p_partkey", genres.alias("genres"))


_PART_GENRES_SQL = ("split_part(p_name, ' ', 1) || ', ' || split_part(p_name, ' ', 2) "
                    "|| ', ' || lower(p_type)")


@register("consolidate_tokens", f"""
WITH p AS (SELECT p_partkey, {_PART_GENRES_SQL} AS genres FROM part),
c AS (SELECT p_partkey, genres, {sql_consolidate('genres', PART_FAMILIES)} AS genres_consolidated FROM p)
SELECT p_partkey, genres, genres_consolidated,
       {sql_strip("split_part(genres_consolidated, ',', 1)")} AS primary_genre
FROM c
""")
def consolidate_tokens(spark, sf):
    df = labels.consolidate_labels(_part_labels(spark, sf), "genres", PART_FAMILIES)
    return labels.primary_label(df, "genres_consolidated", "primary_genre")


@register("token_counts", f"""
WITH p AS (SELECT p_partkey, {_PART_GENRES_SQL} AS genres FROM part),
c AS (SELECT genres, {sql_consolidate('genres', PART_FAMILIES)} AS gc FROM p),
b AS (SELECT DISTINCT {sql_strip('x')} AS tok FROM (SELECT unnest(string_split(genres, ',')) AS x FROM c)),
a AS (SELECT DISTINCT {sql_strip('x')} AS tok FROM (SELECT unnest(string_split(gc, ',')) AS x FROM c))
SELECT (SELECT count(*) FROM b WHERE tok <> '') AS n_before,
       (SELECT count(*) FROM a WHERE tok <> '') AS n_after
""")
def token_counts(spark, sf):
    df = labels.consolidate_labels(_part_labels(spark, sf), "genres", PART_FAMILIES)
    return labels.token_counts(df, "genres", "genres_consolidated")


@register("unique_tokens", f"""
SELECT DISTINCT tok AS genre FROM (
  SELECT {sql_strip('x')} AS tok FROM (
    SELECT unnest(string_split({_PART_GENRES_SQL}, ', ')) AS x FROM part))
WHERE tok <> ''
""")
def unique_tokens(spark, sf):
    return labels.unique_label_tokens(_part_labels(spark, sf), "genres")
