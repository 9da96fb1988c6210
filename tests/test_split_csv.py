"""Reading CSV in ranges: equal to the whole-file reader wherever the ranges are cut."""

import csv
import os
import random
import tempfile

import pytest

from recordforge.sources.csv import read_csv
from recordforge.sources.split_csv import ranges

NAMES = ["id", "name", "note"]
CELLS = ["", "a", "b c", "line\nbreak", 'say "x"', "a,b", '"', "\n", "x\r\ny", "\n\n\n", "é\nü", " blank ", "l" * 90, "q\n" * 40, '","', '"\n"']


def write(folder, rows, end="\n", header=NAMES, name="a.csv"):
    path = os.path.join(folder, name)
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(header)
        w.writerows(rows)
    return path


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_whole_file_reader(spark, small_ranges, end):
    rng = random.Random(end)
    folder = tempfile.mkdtemp(prefix="rf-split-")
    rows = [[str(i), rng.choice(CELLS), rng.choice(CELLS)] for i in range(200)]
    path = write(folder, rows, end)
    marks = ranges(spark, path).collect()
    assert len(marks) > 20 and any(m.inside for m in marks) and any(not m.inside for m in marks)
    got = read_csv(spark, path, columns=NAMES, numeric=(), split=True, position="p")
    assert rows_of(got.drop("p")) == sorted((tuple(c or None for c in r) for r in rows), key=repr)
    if end == "\n":  # the whole-file reader turns CR LF inside cells of CR LF files into LF
        assert rows_of(got.drop("p")) == rows_of(read_csv(spark, path, columns=NAMES, numeric=()))
    assert [r.id for r in got.orderBy("p").collect()] == [r[0] for r in rows]


def test_one_cell_over_many_ranges(spark, small_ranges):
    path = write(tempfile.mkdtemp(prefix="rf-split-"), [["1", "x\n" * 500, "y"], ["2", "", ""], ["3", "\n" * 300, 'z"' * 99]])
    got = {r.id: r for r in read_csv(spark, path, columns=NAMES, numeric=(), split=True).collect()}
    assert set(got) == {"1", "2", "3"} and got["1"].name == "x\n" * 500 and got["3"].name == "\n" * 300 and got["3"].note == 'z"' * 99


def test_several_files_short_rows_blank_lines(spark, small_ranges):
    folder = tempfile.mkdtemp(prefix="rf-split-")
    write(folder, [["1", "a\nb", "c"]], name="a.csv")
    with open(write(folder, [], name="b.csv"), "a") as f:
        f.write('\n\n2,"x\ny"\n\n3')  # short rows are padded; no line end at the end of the file
    got = read_csv(spark, folder, columns=NAMES, numeric=(), split=True)
    assert rows_of(got) == [("1", "a\nb", "c"), ("2", "x\ny", None), ("3", None, None)]
    assert rows_of(got) == rows_of(read_csv(spark, folder, columns=NAMES, numeric=()))


def test_empty_table_and_bad_files(spark):
    folder = tempfile.mkdtemp(prefix="rf-split-")
    assert read_csv(spark, write(folder, []), columns=NAMES, numeric=(), split=True).count() == 0
    long = write(tempfile.mkdtemp(prefix="rf-split-"), [["1", "2", "3", "4"]])
    with pytest.raises(Exception, match="more cells than the header"):
        read_csv(spark, long, columns=NAMES, numeric=(), split=True).collect()
    write(folder, [["1", "2", "3"]], header=["name", "id", "note"], name="b.csv")
    with pytest.raises(Exception, match="another header"):
        read_csv(spark, folder, columns=NAMES, numeric=(), split=True).collect()
    stray = tempfile.mkdtemp(prefix="rf-split-")
    with open(write(stray, []), "a") as f:
        f.write('1,2" wide,3\n4,5,6\n7,"a\nb",8\n')
    with pytest.raises(Exception, match="quote inside an unquoted cell"):
        read_csv(spark, os.path.join(stray, "a.csv"), columns=NAMES, numeric=(), split=True).collect()
