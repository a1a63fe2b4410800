"""Every SQL-checkable registered query equals its DuckDB oracle (sf0.001)."""

import os
import sys

import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare  # noqa: E402

NAMES = sorted(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    info = compare(spark, SF001, name, entry.queries()[name], entry.oracle_sql()[name], duck)
    assert info["schema"], info
    assert info["values"], info


def test_contract():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
    # model fits are the only queries without an oracle, besides text operators
    text, _ = entry._text_queries()
    assert set(q) - set(o) - set(text) == {"kmeans_sweep", "kmeans_compare", "model_compare", "pca"}


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["primary_genre", "lang", "n", "mean_n_chars"]
