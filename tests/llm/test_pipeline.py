"""The pipeline's stages against their operators and brute force."""

import importlib
import sys

import corpus_pipeline
from helpers import awkward, empty
from test_bpe import expected
from test_decontaminate import plain
from test_near_dedup import brute

from cadenza.llm import quality
from cadenza.llm.common import read_table, saved

SF001 = "/root/testdata/sf0.001"


def white_free(t):
    return "".join(c for c in t or "" if c not in " \t\n\v\f\r")


def test_stages_on_the_driver_table(spark):
    docs = read_table(spark, SF001, "documents")
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, SF001), name)
        assert docs.columns == columns
        got = docs.collect()
        assert all(rows[r["doc_id"]] == r for r in got)
        kept.append({r["doc_id"]: r["text"] for r in got})
    good, exact, near, clean = kept
    table = read_table(spark, SF001, "documents")
    want = {r["doc_id"] for r in quality.score(table, *quality.train(table, read_table(spark, SF001, "labels"))).collect() if r["predicted"]}
    assert set(good) == want
    best = {}
    for d, t in sorted(good.items(), key=lambda x: (-len(x[1] or ""), x[0])):
        best.setdefault(white_free(t), d)
    assert set(exact) == set(best.values())
    assert set(near) == {d for d, _, _, k in brute(exact.items()) if k}
    items = [plain(r["text"]) for r in read_table(spark, SF001, "benchmark").collect()]
    assert set(clean) <= set(near)
    assert {d for d in near if any(i in plain(near[d] or "") for i in items)} <= set(near) - set(clean)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in last} == {d: expected(t) for d, t in clean.items()}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF001).collect()} == set(clean)


def test_awkward_and_empty_rows(spark):
    for docs in (awkward(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = saved(stage(spark, docs, SF001), name)
    assert docs.count() == 0


def test_entry_without_the_folder(monkeypatch):
    import __spark_entry__ as entry

    assert {"pipeline", *(f"op{n}" for n in range(1, 11))} <= {q.split("_")[0] for q in entry.queries()}
    for gone in ("cadenza.llm", "corpus_pipeline"):
        with monkeypatch.context() as m:
            for name in [x for x in sys.modules if x.startswith(("cadenza.llm", "corpus_pipeline"))]:
                m.delitem(sys.modules, name)
            m.setitem(sys.modules, gone, None)
            importlib.reload(entry)
            assert "flagship" in entry.queries() and "pipeline" not in entry.queries()
    importlib.reload(entry)
