import pytest
from pyspark.sql import functions as F

from recordforge import config
from recordforge.plans.catalog import loaded
from recordforge.plans.cleaning import run_cleaning
from recordforge.plans.incremental import add, clean_table
from recordforge.sources.publish import publish, published, version

COLUMNS = config.REQUIRED_COLUMNS


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def venue(**given):
    row = dict.fromkeys(COLUMNS) | {"latitude": None, "longitude": None} | given
    return tuple(row[c] for c in COLUMNS)


def table(spark, *rows):
    kinds = ", ".join(f"{c} {'double' if c in ('latitude', 'longitude') else 'string'}" for c in COLUMNS)
    return spark.createDataFrame([venue(**r) for r in rows], kinds)


@pytest.mark.parametrize("batches", [[[0], [1, 2]], [[2, 0], [], [1]]])
def test_batches_equal_one_run(spark, sf_small, tmp_path, batches):
    raw = loaded(spark, sf_small)
    folder = str(tmp_path / "table")
    seen = 0
    for part in batches:
        took = add(spark, raw.filter((F.col("id").cast("bigint") % 3).isin(part)), folder)
        seen += took["rows_added"]
        assert took["rows_merged"] >= took["rows_added"] and (took["groups_merged"] > 0) == (took["rows_added"] > 0)
    assert seen == raw.count()
    assert rows_of(clean_table(spark, folder)) == rows_of(run_cleaning(raw))


def test_a_record_that_links_two_old_clusters(spark, tmp_path):
    folder = str(tmp_path / "table")
    a = {"id": "1", "name": "Alpha House", "city": "Rome", "display_address": "100 long mulberry street of the first quarter north"}
    b = {"id": "2", "name": "Omega Place", "city": "Rome", "display_address": "100 long mulberry street of the first quarterdeck n"}
    far = {"id": "3", "name": "Elsewhere", "city": "Oslo", "display_address": "9 quay"}
    link = {"id": "4", "name": "Omega Place", "city": "Rome", "display_address": "100 long mulberry street of the first quarter north"}
    batches = [table(spark, a, far), table(spark, b), table(spark, link), table(spark, {**link, "id": "5", "display_address": None})]
    took = [add(spark, x, folder) for x in batches]
    want = run_cleaning(batches[0].unionByName(batches[1]).unionByName(batches[2]).unionByName(batches[3]))
    assert rows_of(clean_table(spark, folder)) == rows_of(want)
    assert clean_table(spark, folder).count() == 2
    assert took[2]["groups_merged"] == 1 and took[2]["rows_merged"] == 3  # nothing of Oslo is merged again
    assert took[3]["rows_merged"] == 4


def test_only_touched_groups_are_merged_again(spark, tmp_path):
    folder = str(tmp_path / "table")
    old = [{"id": str(k), "name": f"name {k}", "city": "Rome", "google_place_id": f"p{k % 10}"} for k in range(40)]
    add(spark, table(spark, *old), folder)
    took = add(spark, table(spark, {"id": "900", "name": "n", "city": "Rome", "google_place_id": "p3"}, {"id": "901", "google_place_id": "new"}), folder)
    assert took == {"rows_added": 2, "groups_merged": 2, "rows_merged": 6}
    assert clean_table(spark, folder).count() == 11


def test_a_batch_that_fails_leaves_the_table(spark, tmp_path, monkeypatch):
    from recordforge.plans import incremental

    folder = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        clean_table(spark, folder)
    add(spark, table(spark, {"id": "1", "name": "one", "city": "Rome"}), folder)
    before, state = rows_of(clean_table(spark, folder)), published(spark, folder)

    def stop(*_, **__):
        raise OSError("the job stops while it writes")

    monkeypatch.setattr(incremental, "_relabelled", stop)
    with pytest.raises(OSError):
        add(spark, table(spark, {"id": "2", "name": "one", "city": "Rome"}), folder)
    monkeypatch.undo()
    assert published(spark, folder) == state and rows_of(clean_table(spark, folder)) == before
    add(spark, table(spark, {"id": "2", "name": "one", "city": "Rome"}), folder)
    assert [r[0] for r in rows_of(clean_table(spark, folder))] == ["1"]


def test_two_writers(spark, tmp_path):
    folder = str(tmp_path / "m")
    began = version(spark, folder)
    assert began == 0 and published(spark, folder) is None
    assert publish(spark, folder, {"a": 1}, expected=began) == 1
    with pytest.raises(RuntimeError):
        publish(spark, folder, {"a": 2}, expected=began)
    assert published(spark, folder) == {"a": 1}
    assert publish(spark, folder, {"a": "ü"}, expected=1) == 2 and published(spark, folder) == {"a": "ü"}
