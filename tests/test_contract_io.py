"""Driver-facing contracts: entry module loadable from a path; bench prints one JSON line."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF001


def test_entry_loads_from_file_path(tmp_path):
    code = ("import importlib.util\n"
            f"spec = importlib.util.spec_from_file_location('m', {os.path.join(ROOT, '__spark_entry__.py')!r})\n"
            "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
            "print(len(m.queries()), len(m.oracle_sql()))\n")
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), capture_output=True,
                         text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    n_q, n_o = map(int, out.stdout.split())
    assert n_q >= 70 and n_o >= 66


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2",
               BENCH_QUERIES="label_join,class_counts", BENCH_RUNS="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd=str(tmp_path),
                         capture_output=True, text=True, timeout=600, env=env)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"label_join", "class_counts"}
    assert d["value"] > 0 and "errors" not in d


def test_cli_prepare(tmp_path, track_folder):
    env = dict(os.environ, PYTHONPATH=ROOT + os.pathsep + os.environ.get("PYTHONPATH", ""))
    out = subprocess.run([sys.executable, "-m", "cadenza", "prepare", track_folder[0]], cwd=str(tmp_path),
                         capture_output=True, text=True, timeout=600, env=env)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "rows after cleaning: " in out.stdout
