"""Plan regression: the scale properties the design relies on stay in place."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from conftest import SF001

SKIP = {"kmeans_sweep", "kmeans_compare", "model_compare"}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SKIP))
def test_no_cartesian_products(spark, name):
    p = plan(entry.queries()[name](spark, SF001))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_outlier_filter_reaches_parquet(spark):
    p = plan(entry.queries()["iqr_filter"](spark, SF001))
    assert "PushedFilters: [Or(IsNull(value),GreaterThanOrEqual(value," in p
    assert "Or(IsNull(user_id),And(GreaterThanOrEqual(user_id," in p


@pytest.mark.parametrize("name", ["spread_sample", "cap_per_group", "top_tags"])
def test_partial_group_limit_before_shuffle(spark, name):
    p = plan(entry.queries()[name](spark, SF001))
    tree = p.split("\n\n")[0]
    lines = [ln for ln in tree.splitlines() if "WindowGroupLimit" in ln or "Exchange" in ln]
    # a partial WindowGroupLimit directly below the window's Exchange
    assert any("Exchange" in a and "WindowGroupLimit" in b for a, b in zip(lines, lines[1:]))


def test_column_pruning_on_wide_scan(spark):
    p = plan(entry.queries()["dedupe_first"](spark, SF001))
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in p or \
        "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>" in p
    p = plan(entry.queries()["scale_stats"](spark, SF001))
    assert "l_returnflag" not in p.split("ReadSchema")[1].split("\n")[0]
