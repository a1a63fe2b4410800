"""Driver-table queries: tag relevance and coverage.

Tags are the words of each whole document (lower-cased letter/digit runs);
the class is the document language.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions.vocab import GENRE_KEYWORDS, NOISE_TAGS, SEED
from cadenza.operators import coverage, sampling
from cadenza.plans.registry import r6, register, sql_hash, t

WORD_RE = r"[\p{L}\p{N}]+"


def _docs_tags(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "lang", "text")
    tags = F.regexp_extract_all(F.lower("text"), F.lit(WORD_RE), F.lit(0))
    return d.select("doc_id", "lang", tags.alias("tags"))


def _items(spark, sf):
    return coverage.item_tag_counts(_docs_tags(spark, sf), ["doc_id", "lang"], "tags")


def _sql_relevant(x: str) -> str:
    noise = ", ".join("'" + n.replace("'", "''") + "'" for n in NOISE_TAGS)
    kws = " OR ".join(f"contains(lower({x}), '{k.replace(chr(39), chr(39) * 2)}')" for k in GENRE_KEYWORDS)
    return f"(NOT (lower({x}) IN ({noise})) AND ({kws}))"


_TAGGED_SQL = f"""
d AS (SELECT doc_id, lang, regexp_extract_all(lower(text), '{WORD_RE}') AS tags FROM documents),
r AS (SELECT doc_id, lang, tags, list_filter(tags, lambda x: {_sql_relevant('x')}) AS g FROM d)"""


@register("tag_coverage", f"""
WITH {_TAGGED_SQL.strip()},
a AS (SELECT count(*) AS n_items, count(*) FILTER (WHERE len(tags) > 0) AS n_with_tags,
             count(*) FILTER (WHERE len(g) > 0) AS n_with_relevant FROM r)
SELECT n_items, n_with_tags, n_with_relevant, round(n_with_tags * 100.0 / n_items, 6) AS pct_any,
       round(n_with_relevant * 100.0 / n_items, 6) AS pct_relevant,
       CASE WHEN n_with_relevant / n_items >= 0.6 THEN 'proceed' ELSE 'pivot' END AS decision
FROM a
""")
def tag_coverage(spark, sf):
    c = coverage.coverage(_items(spark, sf))
    return c.select("n_items", "n_with_tags", "n_with_relevant", r6("pct_any").alias("pct_any"),
                    r6("pct_relevant").alias("pct_relevant"), "decision")


@register("top_tags", f"""
WITH {_TAGGED_SQL.strip()},
x AS (SELECT unnest(tags) AS tag FROM r),
k AS (SELECT CASE WHEN {_sql_relevant('tag')} THEN 'genre' ELSE 'noise' END AS kind,
             lower(tag) AS tag FROM x),
c AS (SELECT kind, tag, count(*) AS n FROM k GROUP BY kind, tag),
rk AS (SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY n DESC, tag) AS rank, tag, n FROM c)
SELECT kind, rank, tag, n FROM rk WHERE rank <= 20
""")
def top_tags(spark, sf):
    tt = coverage.top_tags(_docs_tags(spark, sf), "tags", k=20)
    return tt.select("kind", F.col("rank").cast("long").alias("rank"), "tag", "n")


@register("coverage_by_class", f"""
WITH {_TAGGED_SQL.strip()}
SELECT lang AS "primary", count(*) AS n, count(*) FILTER (WHERE len(g) > 0) AS covered,
       round(CASE WHEN count(*) = 0 THEN 0.0
                  ELSE count(*) FILTER (WHERE len(g) > 0) * 100.0 / count(*) END, 6) AS pct
FROM r GROUP BY lang
""")
def coverage_by_class(spark, sf):
    c = coverage.coverage_by_class(_items(spark, sf), "lang")
    return c.select("primary", "n", "covered", r6("pct").alias("pct"))


@register("example_rows", f"""
WITH {_TAGGED_SQL.strip()}
SELECT doc_id, lang, coalesce(len(tags), 0) AS n_tags,
       array_to_string(list_slice(tags, 1, 15), ' ') AS tags_15
FROM r ORDER BY {sql_hash(SEED, 'doc_id')}, doc_id LIMIT 10
""")
def example_rows(spark, sf):
    ex = sampling.example_rows(_docs_tags(spark, sf), "doc_id", 10, SEED)
    return ex.select("doc_id", "lang", F.coalesce(F.size("tags"), F.lit(0)).alias("n_tags"),
                     F.array_join(F.slice("tags", 1, 15), " ").alias("tags_15"))


@register("tag_split", f"""
WITH {_TAGGED_SQL.strip()}
SELECT doc_id, len(tags) AS n_tags, len(g) AS n_genre, len(tags) - len(g) AS n_noise, g[1] AS first_genre,
       list_filter(tags, lambda x: NOT {_sql_relevant('x')})[1] AS first_noise FROM r
""")
def tag_split(spark, sf):
    """Relevant and noise arrays of each whole document."""
    s = coverage.split_tags(_docs_tags(spark, sf), "tags")
    size = lambda c: F.size(c).cast("long")
    return s.select("doc_id", size("tags").alias("n_tags"), size("genre_tags").alias("n_genre"), size("noise_tags").alias("n_noise"),
                    F.get("genre_tags", F.lit(0)).alias("first_genre"), F.get("noise_tags", F.lit(0)).alias("first_noise"))
