"""Delimited files read as wholes: code pages, heads, headers and broken records differ from file to file."""

import pytest

from sparkdesk.sources import delimited
from sparkdesk.sources import readers as R
from sparkdesk.sources import writers as W


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def folder(tmp_path):
    def put(name, text, encoding="utf-8"):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode(encoding))

    put.path = str(tmp_path / "in")
    return put


def test_mixed_code_pages_and_headers_in_one_folder(spark, folder, monkeypatch):
    monkeypatch.setattr(delimited, "CHUNK", 7)  # letters are cut in the middle
    folder("a.csv", "district,n\n강남구,1\n")
    folder("deep/b.csv", "district,n\n중구,2\n", "cp949")
    folder("c.csv", "n,district\n3,서초구\n", "utf-8-sig")  # other order
    folder("d.csv", "구,수\n종로구,4\n", "cp949")  # foreign names
    folder("_ignored.csv", "x")
    folder("empty.csv", "")
    got = rows(R.read_csv_any(spark, folder.path, "district string, n int"))
    assert got == sorted([("강남구", 1), ("중구", 2), ("서초구", 3), ("종로구", 4)], key=repr)


def test_sixty_files_with_heads_of_their_own(spark, folder):
    want = []
    for i in range(60):
        years = [2010 + i % 7 + k for k in range(3)][:: -1 if i % 2 else 1]
        head = [["h", "name"] + [str(y) for y in years for _ in range(2)], ["h", "name"] + ["all", "part"] * 3, ["h", "name"] + ["area (m2)", "rate"] * 3]
        body = ["h", f" gu{i} "] + [f'"1,{y}"' if k == 0 else "9" for y in years for k in range(2)]
        folder(f"f{i}.csv", "\n".join(",".join(r) for r in [*head, body, ["h", "none"] + ["-"] * 6]) + "\n", "cp949" if i % 3 else "utf-8")
        want += [(f"gu{i}", y, 10000.0 + y) for y in years]
    assert rows(R.read_block_table(spark, folder.path, "all", "area", "v")) == sorted(want, key=repr)
    body = rows(R.read_headless(spark, folder.path, 2, 3).select("_c1"))
    assert len(body) == 120 and not any(r[0] == "name" for r in body)


def test_records_that_do_not_fit(spark, folder):
    folder("x.csv", 'n,t\n1,a\n2,"two\nlines"\nx,b\n3\n4,d,e\n5,\n')
    good, bad = R.read_tolerant_csv(spark, folder.path, "n int, t string")
    assert rows(good) == sorted([(1, "a"), (2, "two\nlines"), (5, None)], key=repr)
    assert sorted(r.line for r in bad.collect()) == ["3", "4,d,e", "x,b"] and {r.row_no for r in bad.collect()} == {3, 4, 5}


def test_many_small_files_share_tasks_and_a_file_stands_for_itself(spark, folder, monkeypatch):
    for i in range(40):
        folder(f"{i:02d}.csv", f"{i}\n" * 3)
    assert delimited.records(spark, folder.path).rdd.getNumPartitions() == 1
    assert rows(delimited.records(spark, f"{folder.path}/07.csv").selectExpr("row_no", "cells[0]")) == [(0, "7"), (1, "7"), (2, "7")]
    reader = delimited.DelimitedReader({"path": folder.path})
    monkeypatch.setattr(delimited, "PACK_BYTES", 40)
    assert 3 < len(reader.partitions()) < 40


def test_export_check_sees_a_lost_column(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q"\nb'), (2, None)], "k int, v string")
    assert W.export_csv(df, f"{tmp_path}/a").first().same
    df.drop("v").write.csv(f"{tmp_path}/b", header=True)
    assert not W.compare_export(df, f"{tmp_path}/b").first().same


def test_latest_record_survives_runs_that_come_late(spark, tmp_path):
    make = lambda *r: spark.createDataFrame(list(r), "k int, at int, v string")
    for runs in (make((1, 5, "new"), (2, 1, "x")), make((1, 3, "old"), (2, 1, "y"), (3, 1, "z"))):
        W.save_two_track(spark, runs, f"{tmp_path}/latest", f"{tmp_path}/history", "k", "at")
    assert rows(W.read_version(spark, f"{tmp_path}/latest")) == [(1, 5, "new"), (2, 1, "y"), (3, 1, "z")]
    assert spark.read.parquet(f"{tmp_path}/history").count() == 5
