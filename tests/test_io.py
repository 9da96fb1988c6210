"""CSV scan / sink round trip with quoting, multi-line cells and blanks."""

import os
import tempfile

from recordforge import config
from recordforge.sources.csv import read_csv, validate_schema, write_csv

import pytest


def test_roundtrip_keeps_text(spark):
    cols = config.REQUIRED_COLUMNS + ["extra"]
    rows = [
        ("007", ' say "hi" ', "N/A", "line1\nline2", None, 1.5, None, " medium ", "", "http://x.com/", "e"),
        ("008", "nan", "  ", "a, b", "g", None, -2.25, "NULL", "None", None, "f"),
    ]
    schema = ", ".join(f"{c} {'double' if c in ('latitude', 'longitude') else 'string'}" for c in cols)
    df = spark.createDataFrame(rows, schema)
    path = os.path.join(tempfile.mkdtemp(prefix="rf-csv-"), "out")
    write_csv(df, path)
    back = {r.id: r for r in read_csv(spark, path).collect()}
    a, b = back["007"], back["008"]
    assert a.name == ' say "hi" ' and a.city is None and a.display_address == "line1\nline2"
    assert a.latitude == 1.5 and a.longitude is None and a.price_point == " medium "
    assert a.primary_type is None  # empty cell is a load sentinel
    assert b.name is None and b.city == "  " and b.price_point is None and b.primary_type is None
    assert b.longitude == -2.25 and b.extra == "f"


def test_schema_check(spark):
    df = spark.createDataFrame([("1",)], "id string")
    with pytest.raises(ValueError, match="missing required columns"):
        validate_schema(df)


def test_missing_input_raises(spark):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        read_csv(spark, os.path.join(tempfile.mkdtemp(prefix="rf-none-"), "absent.csv")).count()


def _write(text):
    path = os.path.join(tempfile.mkdtemp(prefix="rf-csv-"), "in.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_short_rows_are_padded_and_long_rows_raise(spark):
    head = ",".join(config.REQUIRED_COLUMNS)
    got = read_csv(spark, _write(f"{head}\n2,A,B,C\n1,D\n")).orderBy("id").collect()
    assert [(r.id, r.name, r.city, r.website) for r in got] == [("1", "D", None, None), ("2", "A", "B", None)]
    for extra in (",x", ",x,y"):
        with pytest.raises(Exception, match="more cells"):
            read_csv(spark, _write(f"{head}\n1,2,3,4,5,6,7,8,9,10{extra}\n")).select("id").collect()


def test_position_orders_rows_as_in_the_file(spark):
    rows = "".join(f"{i},n{i}\n" for i in (5, 10, 2, 7))
    df = read_csv(spark, _write("id,name\n" + rows), columns=["id"], numeric=(), position="at", multi_line=False)
    assert [r.id for r in df.orderBy("at").collect()] == ["5", "10", "2", "7"]


def test_checkpoint_folder_only_made_on_a_local_master():
    from recordforge.session import is_local

    assert is_local("local") and is_local("local[4]") and is_local("local[*]")
    assert not is_local("local-cluster[3,2,1024]") and not is_local("yarn") and not is_local("spark://host:7077")


def test_nan_counts_as_null(spark):
    from recordforge.operators.profile import null_profile

    df = spark.createDataFrame([("a", float("nan")), (None, 1.0)], "s string, x double")
    assert {(r.column, r.nulls) for r in null_profile(df).collect()} == {("s", 1), ("x", 1)}


def test_venues_of_one_row_group_are_made_by_many_tasks(spark, tmp_path):
    """A table of one file and row group is dealt out in blocks of neighbours; the rows stay the same."""
    from pyspark.sql import functions as F

    from recordforge.sources.fixture import BLOCK, raw_venues, venues_from_customer

    n = 40 * BLOCK + 17
    keys = spark.range(n).select(F.when(F.col("id") % 1000 != 5, F.col("id") - F.col("id") % 7).alias("c_custkey"))  # some twice, some null
    keys.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    made = raw_venues(spark, str(tmp_path))
    tasks = made.groupBy(F.spark_partition_id().alias("t")).count().collect()
    assert len(tasks) > 4 and sum(r["count"] for r in tasks) == n and max(r["count"] for r in tasks) < n / 2
    want = venues_from_customer(spark, spark.read.parquet(str(tmp_path / "customer.parquet")))
    assert made.exceptAll(want).isEmpty() and made.count() == want.count()
