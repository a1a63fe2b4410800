"""Exact dedup and resharding against SQL and brute force."""

import pytest
from helpers import LONG, awkward, empty

from cadenza.llm import exact_dedup, queries, reshard
from pyspark.sql import functions as F

SF001 = "/root/testdata/sf0.001"


def test_exact_dedup_equals_sql(spark, duck):
    got = queries.op3_exact_dedup(spark, SF001).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = duck.execute(exact_dedup.SQL).df().sort_values("doc_id").reset_index(drop=True)
    assert (got[sorted(got)].astype(str) == want[sorted(got)].astype(str)).all().all()


def test_exact_dedup_awkward_rows(spark):
    got = exact_dedup.exact_dedup(awkward(spark)).collect()
    assert len(got) == 11
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert {r["keep_id"] for r in by[1] + by[2]} == {2} and by[1][0]["group_size"] == 3
    assert sorted(r["kept"] for r in by[2]) == [False, True]  # of wholly repeated rows one stays
    assert {r["keep_id"] for i in (3, 4, 5) for r in by[i]} == {5}  # white space alone equals empty; longest stays
    assert by[None][0]["kept"] and by[None][0]["keep_id"] is None
    kept = exact_dedup.drop_copies(awkward(spark))
    assert kept.columns == awkward(spark).columns
    ids = sorted(r["doc_id"] or 0 for r in kept.collect())
    assert ids == [0, 2, 5, 6, 7, 8, 9]


def test_documents_of_several_sources(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    more = docs.join(spark.read.parquet(f"{SF001}/labels.parquet").select("doc_id"), "doc_id")
    assert exact_dedup.exact_dedup(docs.union(more)).filter("kept").count() == exact_dedup.exact_dedup(docs).filter("kept").count()


def test_exact_dedup_empty(spark):
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0
    assert exact_dedup.drop_copies(empty(spark)).count() == 0


def test_state_goes_on_between_batches(spark, tmp_path):
    feed, state = str(tmp_path / "feed"), str(tmp_path / "state")
    rows = exact_dedup.records(awkward(spark)).cache()
    rows.filter("doc_id = 1").write.mode("append").parquet(feed)
    exact_dedup.ingest(spark, feed, state)
    assert [r["group_size"] for r in exact_dedup.retained(spark, state).collect()] == [1]
    rows.filter("doc_id = 2").write.mode("append").parquet(feed)
    exact_dedup.ingest(spark, feed, state)
    kept = exact_dedup.retained(spark, state).collect()
    assert [(r["keep_id"], r["group_size"]) for r in kept] == [(2, 3)]


def test_equal_digests_of_different_texts_are_split(spark, monkeypatch):
    # a digest of the first letter makes every pair of such texts collide
    monkeypatch.setattr(exact_dedup, "digest", lambda c: F.unhex(F.sha2(F.substring(exact_dedup.normalised(c), 1, 1), 256)))
    docs = spark.createDataFrame([(1, "a x"), (2, "ax"), (3, "a y"), (4, "b")], "doc_id long, text string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {1: (1, 2, True), 2: (1, 2, False), 3: (3, 1, True), 4: (4, 1, True)}


def test_flow_is_least():
    flow = reshard.min_cost_flow([10, 2, 0], [4, 4, 4], [[int(i != j) for j in range(3)] for i in range(3)])
    assert flow[0][0] == 4 and flow[1][1] == 2 and sum(map(sum, flow)) == 12
    assert sum(flow[i][j] for i in range(3) for j in range(3) if i != j) == 6
    assert [sum(r[j] for r in flow) for j in range(3)] == [4, 4, 4]
    with pytest.raises(ValueError):
        reshard.min_cost_flow([5], [4], [[0]])


def test_flow_reroutes_along_the_residual_graph():
    # the cheap first choice must be taken back for the total to be least
    flow = reshard.min_cost_flow([1, 1], [1, 1], [[1, 2], [1, 9]])
    assert flow == [[0, 1], [1, 0]]


def test_reshard_law_and_slots(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = queries.op10_reshard(spark, SF001).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 2 * got["size"].max()
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    want = {r["doc_id"]: len((r["text"] or "").encode()) + 1 for r in docs.collect()}
    assert dict(zip(got["doc_id"], got["size"])) == want
    # no more bytes move than the surplus of the old shards
    old = got.groupby("old_shard")["size"].sum()
    share = got["size"].sum() / 8
    moved = got[got["shard"] != got["old_shard"]]["size"].sum()
    assert moved <= sum(max(0, x - share) for x in old) + 16 * got["size"].max()


def test_reshard_awkward_and_empty(spark, tmp_path):
    old = F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(2))
    got = reshard.reshard(awkward(spark), old, 2, 3).collect()
    assert len(got) == 11
    for s in {r["shard"] for r in got}:
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))
    assert {r["size"] for r in got if r["doc_id"] == 3} == {1}
    assert max(r["size"] for r in got) == len(LONG) + 4
    assert reshard.reshard(empty(spark), old, 2, 3).count() == 0


def test_rewrite_touches_only_changed_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * 99, i % 2) for i in range(40)] + [(40, "x" * 99, 2), (41, "x" * 99, 2)],
                                 "doc_id long, text string, old int")
    placed = reshard.reshard(docs, F.col("old"), 3, 3, capacities=[2000, 2000, 200])
    assert reshard.rewrite(docs, placed, str(tmp_path / "none")) == []
    placed = reshard.reshard(docs, F.col("old"), 3, 3, capacities=[1000, 2000, 1200])
    assert reshard.rewrite(docs, placed, str(tmp_path / "out")) == [0, 2]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 22


def test_rewrite_of_a_table_and_of_a_folder_with_shards(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").dropDuplicates(["doc_id"])
    sizes = {r["old"]: r["b"] for r in reshard.row_sizes(docs, F.pmod("doc_id", F.lit(4))).groupBy(
        F.col("old_shard").alias("old")).agg(F.sum("size").alias("b")).collect()}
    more = max(sizes[1], sizes[0] + sizes[1] // 2)  # rows go from shard 1 to shard 0; 2 and 3 stay
    placed = reshard.reshard(docs, F.pmod("doc_id", F.lit(4)), 4, 4,
                             capacities=[more, sizes[0] + sizes[1] - more, sizes[2], sizes[3]]).checkpoint()
    path = str(tmp_path / "new")
    touched = reshard.rewrite(docs, placed, path)
    assert touched == [0, 1]
    got = {(r["doc_id"], r["shard"], r["text"]) for r in spark.read.parquet(path).collect()}
    want = {(r["doc_id"], r["shard"], r["text"]) for r in placed.join(docs.select("doc_id", "text"), "doc_id").filter("shard < 2").collect()}
    assert got == want and len(got) > 100
    old = str(tmp_path / "old")
    docs.withColumn("shard", F.pmod("doc_id", F.lit(4))).write.partitionBy("shard").parquet(old)
    try:
        reshard.rewrite(docs, placed, old)
        refused = False
    except Exception as ex:
        refused = "PATH_ALREADY_EXISTS" in str(ex)
    assert refused and spark.read.parquet(old).count() == docs.count()
