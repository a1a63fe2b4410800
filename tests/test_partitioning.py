"""Results (except model fits) do not depend on the number of shuffle partitions."""

import pytest

import __spark_entry__ as entry
from conftest import SF01

NAMES = ["balance_classes", "stratified_split", "dedupe_first", "soft_cap", "first_label_wins",
         "spread_sample", "example_rows", "top_tags", "payload_idmap", "search_collect",
         "cap_per_group", "batch_ids", "iqr_filter", "silhouette", "artist_collect",
         "label_collection", "album_collect"]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", NAMES)
def test_same_result_any_partitioning(spark, name):
    fn = entry.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = _rows(fn(spark, SF01))
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        b = _rows(fn(spark, SF01))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b
