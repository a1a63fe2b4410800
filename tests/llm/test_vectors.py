"""Vector codes and centroid clustering against SQL and full searches."""

import numpy as np
import pytest

from cadenza.llm import centroids, compress, queries, vectors

SF001 = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, code string, cluster int, sums int"


def odd_rows(spark, width=64):
    rng = np.random.default_rng(2)
    v = rng.normal(0, 0.2, (40, width)).astype(np.float32)
    rows = [(i, [float(x) for x in v[i]], i % 3 if i % 5 else None, "c", 1, 2) for i in range(40)]
    bad = [float("nan"), float("inf"), float("-inf"), None]
    rows += [(100 + i, [b] + [0.5] * (width - 1), 1, "c", 1, 2) for i, b in enumerate(bad)]
    rows += [(200, None, 1, "c", 1, 2), (201, [], 1, "c", 1, 2), (202, [0.5] * (width - 1), 1, None, None, None)]
    rows += [(None, [0.25] * width, 2, "c", 1, 2), rows[3], rows[3]]
    return spark.createDataFrame(rows, SCHEMA)


def kept_rows(df, width=64):
    return [r for r in df.collect() if r["embedding"] is not None and len(r["embedding"]) == width
            and all(x is not None and np.isfinite(x) for x in r["embedding"])]


def full_search(x, c):
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


@pytest.mark.parametrize("seed", range(8))
def test_searches_equal_full_search(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 12))
    x = rng.integers(-6, 7, (500, d)) * int(rng.choice([1, 1000, 1 << 20]))  # many ties
    c = x[rng.integers(0, 500, 16)].copy()
    c[5] = c[3]
    want, far = full_search(x, c)
    for guess in (np.zeros(500, np.int64), rng.integers(0, 16, 500), want):
        code, own, looked = compress.ball_search(x, c, guess)
        assert (code == want).all() and (own == far).all()
    assert looked <= 15 * 500
    number, best, looked = centroids.nearest(x, c)
    assert (number == want).all() and (best == far).all() and looked <= 16 * 500


def test_searches_skip_distances():
    rng = np.random.default_rng(1)
    c = rng.integers(-2000, 2000, (16, 8))
    x = c[rng.integers(0, 16, 4000)] + rng.integers(-40, 41, (4000, 8))
    want, _ = full_search(x, c)
    code, _, looked = compress.ball_search(x, c, want)
    assert (code == want).all() and looked < 4000
    number, _, looked = centroids.nearest(x, c)
    assert (number == want).all() and looked < 0.3 * 16 * 4000


def test_unmoved_balls_are_skipped():
    rng = np.random.default_rng(3)
    c = rng.integers(-50, 50, (8, 4))
    x = rng.integers(-60, 60, (3000, 4))
    code, _, most = compress.ball_search(x, c, np.zeros(3000, np.int64))
    same, _, looked = compress.ball_search(x, c, code, np.zeros(8, bool))
    assert looked == 0 and (same == code).all() and most > 0
    new = c.copy()
    new[2] += 7
    moved = (new != c).any(1)
    got, _, _ = compress.ball_search(x, new, code, moved)
    assert (got == full_search(x, new)[0]).all()


@pytest.mark.parametrize("name", ["op12_compress", "op13_centroids"])
def test_equals_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF001).toPandas().sort_values("vec_id").reset_index(drop=True)
    want = duck.execute(queries.SQL[name]).df().sort_values("vec_id").reset_index(drop=True)
    assert sorted(got) == sorted(want) and (got.astype(str) == want[list(got)].astype(str)).all().all()


@pytest.mark.parametrize("parts", [1, 7])
def test_codes_do_not_depend_on_blocks(spark, monkeypatch, parts):
    df = odd_rows(spark)
    want = sorted((r["vec_id"] or -1, r["code"], r["error"], r["label_error"]) for r in compress.compress(df).collect())
    monkeypatch.setattr(vectors, "BLOCK", 5)
    got = sorted((r["vec_id"] or -1, r["code"], r["error"], r["label_error"]) for r in compress.compress(df.repartition(parts)).collect())
    assert got == want


def test_codes_of_odd_rows_equal_plain_rounds(spark):
    rows = sorted(kept_rows(odd_rows(spark)), key=lambda r: (r["vec_id"] is None, r["vec_id"]))
    x = np.floor(np.array([r["embedding"] for r in rows]) * 4096.0).astype(np.int64).reshape(len(rows), 8, 8)
    books = x[:16].transpose(1, 0, 2).copy()
    for _ in range(6):
        for p in range(8):
            code, _ = full_search(x[:, p], books[p])
            for k in range(16):
                if (code == k).any():
                    books[p][k] = x[code == k, p].sum(0) // (code == k).sum()
    found = [full_search(x[:, p], books[p]) for p in range(8)]
    want = sorted((r["vec_id"] or -1, "".join(f"{found[p][0][i]:02x}" for p in range(8)), int(sum(found[p][1][i] for p in range(8))))
                  for i, r in enumerate(rows))
    out = compress.compress(odd_rows(spark)).collect()
    assert sorted((r["vec_id"] or -1, r["code"], r["error"]) for r in out) == want
    label = {(r["vec_id"], r["label"]) for r in rows}
    total = {}
    for r in out:
        for i, lab in label:
            if i == r["vec_id"]:
                total.setdefault(lab, set()).add(r["label_error"])
    assert all(len(v) == 1 for v in total.values()) and sum(next(iter(v)) for v in total.values()) == sum(r["error"] for r in out)


def test_clusters_of_odd_rows(spark):
    out = centroids.cluster(odd_rows(spark)).collect()
    assert len(out) == len(kept_rows(odd_rows(spark)))
    assert {r["inertia"] for r in out} == {sum(r["distance"] for r in out)}
    again = centroids.cluster(odd_rows(spark).repartition(9)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_few_and_no_vectors(spark):
    df = odd_rows(spark)
    few = df.filter("vec_id in (1, 2, 201, 100)")
    assert sorted(r["code"] for r in compress.compress(few).collect()) == ["00" * 8, "01" * 8]
    assert {r["distance"] for r in centroids.cluster(few).collect()} == {0}
    for none in (df.filter("vec_id < 0"), df.filter("vec_id in (200, 201, 101)")):
        assert compress.compress(none).collect() == [] and centroids.cluster(none).collect() == []
        assert compress.compress(none).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_too_large_components_are_named(spark):
    df = spark.createDataFrame([(1, [1e9] * 64, 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(df).count()
