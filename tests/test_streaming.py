"""Incremental landing: new files once, re-landed keys skipped, batch rerun idempotent."""

import tempfile

import pytest

from pyspark.sql import functions as F

from conftest import SF001


@pytest.mark.parametrize("mode", ["state", "sink"])
def test_incremental_landing(spark, mode):
    from cadenza.plans import fixtures
    from cadenza.sources import payloads
    from cadenza.streaming import incremental_landing, land_pages, read_sink

    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    pages = fixtures.conversation_track_pages(conv)
    root = tempfile.mkdtemp(prefix="cadenza-stream-")
    land, sink, ck = f"{root}/landing", f"{root}/sink", f"{root}/ck"
    first = pages.filter(F.col("request_key").cast("long") % 2 == 0)
    second = pages.filter(F.col("request_key").cast("long") % 2 == 1)
    keys = ["request_key", "id"]
    land_pages(first, land)
    incremental_landing(spark, land, sink, payloads.playlist_tracks, keys, checkpoint=ck, dedupe=mode)
    n1 = read_sink(spark, sink).count()
    # second run: new conversations plus a re-landed copy of the first ones
    land_pages(second.unionByName(first), land)
    incremental_landing(spark, land, sink, payloads.playlist_tracks, keys, checkpoint=ck, dedupe=mode)
    out = read_sink(spark, sink)
    expected = payloads.playlist_tracks(pages).count()
    assert n1 == payloads.playlist_tracks(first).count()
    assert out.count() == expected
    assert out.select(*keys).distinct().count() == expected
