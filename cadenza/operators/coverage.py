"""Tag relevance and coverage: which items carry genre-relevant tags.

Relevance is ``lower(tag) NOT IN (noise)`` and one alternation of the keywords.
Per-item coverage is decided on each row's own array, without a shuffle; tag
frequencies are counted first and relevance is then decided once per distinct
tag, not once per occurrence.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.exprs import first_token
from cadenza.functions.vocab import GENRE_KEYWORDS, NOISE_TAGS, RELEVANT_RATE_TO_PROCEED


def any_of(words: Iterable[str]) -> str:
    """A pattern that finds any of ``words``, common beginnings once (a trie), so
    that a place of the text is tried against its first letter's branch only.
    Words that contain another one add nothing and are left out."""
    own = set(words)
    own = {w for w in own if not any(v != w and v in w for v in own)}

    def branch(rest: set[str]) -> str:
        if "" in rest:
            return ""
        heads: dict[str, set[str]] = {}
        for w in rest:
            heads.setdefault(w[0], set()).add(w[1:])
        parts = [re.escape(h) + branch(heads[h]) for h in sorted(heads)]
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"
    if not own:
        return ""
    heads = "".join(re.escape(h) for h in sorted({w[0] for w in own if w}))
    return (f"(?=[{heads}])" if heads and "" not in own else "") + branch(own)


def is_relevant(tag: Column, keywords: Iterable[str] = GENRE_KEYWORDS,
                noise: Iterable[str] = NOISE_TAGS) -> Column:
    """Lowered tag not in the noise set and containing any keyword."""
    low = F.lower(tag)
    either = any_of(keywords)
    return ~low.isin(list(noise)) & (low.rlike(either) if either else F.lit(False))


def _name(c: Column, name_field: str | None) -> Column:
    return c[name_field] if name_field else c


def split_tags(df: DataFrame, tags: str = "tags", name_field: str | None = None,
               keywords: Iterable[str] = GENRE_KEYWORDS,
               noise: Iterable[str] = NOISE_TAGS) -> DataFrame:
    """Add ``genre_tags`` / ``noise_tags`` arrays (order kept).  For small
    samples and display; the aggregates below do not need the arrays."""
    kw, ns = list(keywords), list(noise)
    # relevance is decided once per tag; both arrays only read the mark
    marked = df.withColumn("__marked", F.transform(tags, lambda t: F.struct(t.alias("t"), is_relevant(_name(t, name_field), kw, ns).alias("ok"))))
    return (marked.withColumn("genre_tags", F.transform(F.filter("__marked", lambda m: m["ok"]), lambda m: m["t"]))
            .withColumn("noise_tags", F.transform(F.filter("__marked", lambda m: ~m["ok"]), lambda m: m["t"])).drop("__marked"))


def item_tag_counts(df: DataFrame, keys: Sequence[str], tags: str = "tags",
                    name_field: str | None = None, keywords: Iterable[str] = GENRE_KEYWORDS,
                    noise: Iterable[str] = NOISE_TAGS) -> DataFrame:
    """Per item (row; ``keys`` are carried along): number of tags and of relevant
    tags.  A null array has none; null tags do not count."""
    names = F.filter(F.transform(F.coalesce(F.col(tags), F.array()), lambda t: _name(t, name_field)), lambda n: n.isNotNull())
    return df.select(*keys, F.size(names).cast("long").alias("n_tags"),
                     F.size(F.filter(names, lambda n: is_relevant(n, keywords, noise))).cast("long").alias("n_relevant"))


def coverage(items: DataFrame, threshold: float = RELEVANT_RATE_TO_PROCEED) -> DataFrame:
    """One row from per-item counts: items, items with any tag / with a
    relevant tag, their shares in % and the decision ('proceed' when the
    relevant share >= threshold, else 'pivot')."""
    agg = items.agg(F.count(F.lit(1)).alias("n_items"),
                    F.count_if(F.col("n_tags") > 0).alias("n_with_tags"),
                    F.count_if(F.col("n_relevant") > 0).alias("n_with_relevant"))
    rate = F.try_divide(F.col("n_with_relevant"), F.col("n_items"))
    return agg.select(
        "n_items", "n_with_tags", "n_with_relevant",
        F.try_divide(F.col("n_with_tags") * 100.0, F.col("n_items")).alias("pct_any"),
        (rate * 100.0).alias("pct_relevant"),
        F.when(rate >= threshold, F.lit("proceed")).otherwise(F.lit("pivot")).alias("decision"))


def tag_frequency(df: DataFrame, tags: str = "tags", name_field: str | None = None) -> DataFrame:
    """Occurrences of each lowered tag (every occurrence counts), with its kind."""
    x = df.select(F.explode(tags).alias("__t"))
    freq = x.groupBy(F.lower(_name(F.col("__t"), name_field)).alias("tag")) \
            .agg(F.count(F.lit(1)).alias("n"))
    return freq.withColumn("kind", F.when(is_relevant(F.col("tag")), F.lit("genre"))
                           .otherwise(F.lit("noise")))


def top_tags(df: DataFrame, tags: str = "tags", name_field: str | None = None,
             k: int = 20) -> DataFrame:
    """Top-k relevant and top-k noise tags by count (ties by tag).

    One frequency pass; ``row_number() <= k`` per kind is planned with a
    partial window-group limit, so only k rows per kind and map task reach
    the final sort.
    """
    freq = tag_frequency(df, tags, name_field)
    w = Window.partitionBy("kind").orderBy(F.desc("n"), F.asc("tag"))
    return (freq.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("kind", "rank", "tag", "n"))


def coverage_by_class(items: DataFrame, label: str) -> DataFrame:
    """Per primary label: covered / n and the share in % (0 when n = 0)."""
    prim = items.withColumn("primary", first_token(label))
    return prim.groupBy("primary").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("n_relevant") > 0).alias("covered")
    ).withColumn("pct", F.coalesce(F.try_divide(F.col("covered") * 100.0, F.col("n")), F.lit(0.0)))
