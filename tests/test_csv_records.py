"""CSV files with line breaks inside quotes, cut into any splits."""

import csv
import io
import random

import pytest

from cadenza.sources import csv_records, tracks

NAMES = [n for n, _ in tracks.TRACK_COLUMNS]


def write(path, rows, end="\n", head=NAMES, last=True):
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator=end)
    w.writerow(head)
    w.writerows(rows)
    text = buf.getvalue()
    path.write_bytes((text if last else text[: -len(end)]).encode())
    return text


def odd_rows(seed, n):
    rng = random.Random(seed)
    parts = ["a", "x y", "\n", "\n\n", ',', '""', '"', "ü", "long " * 30, "", " end", 'say "hi"\nthere']
    return [["".join(rng.choices(parts, k=rng.randint(0, 5))) or "t", f"id{i}", "artist", rng.choice(["al\nbum", "plain", 'q"', ""]),
             *[str(i / 8)] * 11] for i in range(n)]


@pytest.mark.parametrize("size", [64, 300, 5000, 1 << 27])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_records_in_any_split_read_as_written(spark, tmp_path, size, seed):
    text = write(tmp_path / "a.csv", odd_rows(seed, 60), last=seed != 2)
    want = list(csv.reader(io.StringIO(text)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = csv_records.records(spark, str(tmp_path)).orderBy("blk", "pos").collect()
        states = csv_records.split_states(csv_records.lines(spark, str(tmp_path)).select("value", "file_path", "blk")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [next(csv.reader(io.StringIO(r["record"]))) for r in got] == want
    if size < 1000:
        assert len(states) > 5 and any(r["inside"] for r in states)


def test_scan_reads_files_with_and_without_breaks(spark, tmp_path):
    rows = [['one\nline "two"', "t1", "art", "al", *["0.5"] * 11], ["plain", "t2", "art", 'q "x"', *["0.25"] * 11]]
    write(tmp_path / "torn.csv", rows)
    write(tmp_path / "crlf.csv", [["c\r\nd", "t4", "art", "al", *["0.5"] * 11]], end="\r\n")
    write(tmp_path / "flat.csv", [["flat, still", "t3", "art", "al", *["1"] * 11]])
    write(tmp_path / "other.csv", [["g", "t5\nx", "name"]], head=["genre", "track_id", "track_name"])
    got = {r["track_id"]: r for r in tracks.read_tracks(spark, str(tmp_path)).collect()}
    assert set(got) == {"t1", "t2", "t3", "t4", "t5\nx"}
    assert got["t1"]["track_name"] == 'one\nline "two"' and got["t1"]["tempo"] == 0.5 and got["t2"]["album_name"] == 'q "x"'
    assert got["t3"]["track_name"] == "flat, still" and got["t5\nx"]["track_name"] == "name" and got["t5\nx"]["tempo"] is None
    assert got["t4"]["track_name"].replace("\r", "") == "c\nd"


def test_closed_lines_and_stray_quotes(spark):
    lines = ['a,b', '"a",b', '"a"",b', 'a"b,c', '"a""b",c"d', ',"x', '"', '""', 'a,"b\r', '']
    want = [True, True, False, True, True, False, False, True, False, True]
    got = spark.createDataFrame(list(enumerate(lines)), "i int, line string").select("i", csv_records.closed("line").alias("c")).orderBy("i").collect()
    assert [r["c"] for r in got] == want
    assert [not csv_records.ends_inside(x, False) for x in lines] == want
    assert csv_records.ends_inside('still""open', True) and not csv_records.ends_inside('end",b', True)
    assert csv_records.ends_inside('end","next', True) and csv_records.ends_inside("no quote", True)
