"""Key filters, span hashes, chunks."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import common


def test_semi_and_anti_equal_the_plain_joins(spark):
    rows = spark.createDataFrame([(i if i % 11 else None, f"k{i % 97}", i) for i in range(3000)], "id long, k string, maybe int")
    for n in (0, 1, 50, 2500):
        keys = spark.createDataFrame([(i,) for i in range(0, 2 * n, 2)] + [(None,)], "id long")
        for mine, plain in ((common.semi, "left_semi"), (common.anti, "left_anti")):
            got = mine(rows, keys, "id")
            assert got.columns == rows.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(keys, "id", plain).collect()))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=12), min_size=1, max_size=40))
def test_span_hashes_tell_bytes_apart(words):
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    got = common.byte_hashes(data).spans(ends - [len(w) for w in words], ends)
    by = {}
    for w, h in zip(words, got):
        by.setdefault(w, set()).add(int(h))
    assert all(len(h) == 1 for h in by.values()) and len({next(iter(h)) for h in by.values()}) == len(by)


@given(st.lists(st.integers(0, 50), max_size=60), st.integers(1, 80))
def test_chunks_cover_all_rows_in_bounds(sizes, most):
    parts = list(common.row_chunks(sizes, most))
    assert [i for p in parts for i in range(p.start, p.stop)] == list(range(len(sizes)))
    assert all(sum(sizes[p]) <= most or p.stop - p.start == 1 for p in parts)


def test_task_functions_travel_by_value():
    import pickle

    from pyspark import cloudpickle

    from cadenza.llm import secrets
    assert b"AKIA" in cloudpickle.dumps(secrets.spans_in) and pickle.loads(cloudpickle.dumps(secrets.alphabet))(b"ab1") == 16
