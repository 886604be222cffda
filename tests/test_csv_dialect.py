import csv
import glob

import duckdb
import pandas as pd
import pytest

from fitframe.sources import files

ROWS = [(1, 'said "hi", to me'), (2, "line\nbreak\r\nand more"), (3, ""), (4, None), (5, "  blanks "), (6, 'back\\slash "q"'), (7, '"'), (8, "a,b"),
        (9, "é\t1"), (10, "\\"), (11, '""'), (12, "\n")]


def written(spark, tmp_path):
    path = f"{tmp_path}/scored"
    files.write_scored_csv(spark.createDataFrame(ROWS, "id long, t string").coalesce(1), path)
    return path


def test_round_trip(spark, tmp_path):
    path = written(spark, tmp_path)
    assert [tuple(r) for r in files.read_csv(spark, path, "id long, t string").orderBy("id").collect()] == ROWS
    assert [tuple(r) for r in files.read_csv(spark, path).orderBy("id").collect()] == ROWS


def test_other_readers_agree(spark, tmp_path):
    path = written(spark, tmp_path)
    got = duckdb.sql(f"select id::bigint, t from read_csv('{path}/*.csv', header=true, all_varchar=true, delim=',', quote='\"', escape='\"', "
                     "nullstr='', allow_quoted_nulls=false) order by 1").fetchall()
    assert got == ROWS
    frame = pd.concat(pd.read_csv(p) for p in glob.glob(f"{path}/*.csv")).sort_values("id")
    assert [None if pd.isna(t) else t for t in frame.t] == [t or None for _, t in ROWS]   # pandas reads both kinds of empty as missing


def test_files_of_other_writers(spark, tmp_path):
    with open(f"{tmp_path}/a.csv", "w", newline="") as f:
        csv.writer(f).writerows([("id", "t"), *ROWS[:2], *ROWS[4:]])
    pd.DataFrame(ROWS, columns=["id", "t"]).to_csv(f"{tmp_path}/b.csv", index=False)
    duckdb.sql("create or replace table t(id bigint, t varchar)")
    for r in ROWS:
        duckdb.execute("insert into t values (?, ?)", r)
    duckdb.sql(f"copy t to '{tmp_path}/c.csv' (header true)")
    read = lambda name: [tuple(r) for r in files.read_csv(spark, f"{tmp_path}/{name}.csv", "id long, t string").orderBy("id").collect()]
    unix = [(i, t.replace("\r\n", "\n")) for i, t in ROWS[:2] + ROWS[4:]]
    assert read("a") == unix and read("c") == ROWS
    assert read("b") == [(i, t or None) for i, t in ROWS]   # pandas writes an empty text as an empty cell


def test_rows_that_do_not_fit(spark, tmp_path):
    with open(f"{tmp_path}/bad.csv", "w") as f:
        f.write("id,t\n1,a\nx,b\n3,c,d\n4\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, f"{tmp_path}/bad.csv", "id long, t string").collect()
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, f"{tmp_path}/bad.csv", "key long, t string").collect()
    kept = [tuple(r) for r in files.read_csv(spark, f"{tmp_path}/bad.csv", "id long, t string", bad_rows="keep").collect()]
    assert kept == [(1, "a", None), (None, "b", "x,b"), (3, "c", "3,c,d"), (4, None, "4")]
    with pytest.raises(ValueError):
        files.read_csv(spark, f"{tmp_path}/bad.csv", bad_rows="drop")
    with open(f"{tmp_path}/odd.csv", "w") as f:
        f.write("a.b,c`d\n,\"\"\nx,y\n")
    assert [tuple(r) for r in files.read_csv(spark, f"{tmp_path}/odd.csv").collect()] == [(None, ""), ("x", "y")]
