"""The listing as a table: same files as a file scan, paged, pruned by prefix."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import GreaterThan, StringStartsWith

from newsflow.sources.files import all_files, plain_path
from newsflow.sources.listing import PUSHDOWN, Folder, ListingReader, PushedListingReader, file_page, listed_files

FILES = ["a/x=1/f1", "a/x=1/f2", "a/x=2/f1", "a.txt", "a b/%25+é", "c/d/e/f/g", "c-d/f", "z"]
HIDDEN = ["b/_hid/f", "b/.h", "_x"]


@pytest.fixture
def base(tmp_path):
    for name in FILES + HIDDEN + ["b/empty"]:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("" if name.endswith("empty") else name)
    return str(tmp_path)


def names(df, base):
    return [r["path"].removeprefix(f"file:{base}/") for r in df.collect()]


def test_same_rows_as_a_scan_and_files_without_bytes(spark, base):
    mine = listed_files(spark, base)
    scanned = all_files(spark, base).withColumn("path", plain_path(F.col("path")))
    assert sorted(names(mine, base)) == sorted([*FILES, "b/empty"])
    assert names(mine.exceptAll(scanned), base) == ["b/empty"] and scanned.exceptAll(mine).count() == 0
    assert listed_files(spark, f"{base}/nothing").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 100])
def test_pages_follow_each_other(spark, base, n):
    seen, key = [], None
    while page := [r["path"] for r in file_page(spark, base, n, key).collect()]:
        assert len(page) <= n
        seen, key = seen + page, page[-1]
    assert [p.removeprefix(f"file:{base}/") for p in seen] == sorted([*FILES, "b/empty"])


def test_folders_are_left_out_by_prefix_and_key(base):
    reader = PushedListingReader({"path": base})
    assert len(list(reader.pushFilters([StringStartsWith(("path",), f"file:{base}/a/x=2")]))) == 1
    assert reader.partitions() == [Folder(f"{base}/a", False), Folder(f"{base}/a/x=2", True)]
    reader = PushedListingReader({"path": base})
    list(reader.pushFilters([GreaterThan(("path",), f"file:{base}/c-d/f")]))
    assert {p.path for p in reader.partitions()} == {base, f"{base}/c-d", f"{base}/c"}


def test_conditions_hold_whether_pushed_down_or_not(spark, base):
    want = ["a/x=1/f1", "a/x=1/f2", "a/x=2/f1"]
    before = spark.conf.get(PUSHDOWN)
    for pushed in ("true", "false"):
        spark.conf.set(PUSHDOWN, pushed)
        try:
            assert sorted(names(listed_files(spark, base).filter(F.col("path").startswith(f"file:{base}/a/")), base)) == want
            assert sorted(names(listed_files(spark, base).filter(F.col("path") >= f"file:{base}/c/d"), base)) == ["c/d/e/f/g", "z"]
        finally:
            spark.conf.set(PUSHDOWN, before)


def test_a_task_holds_a_page_at_most(base, monkeypatch):
    from newsflow.sources import listing

    monkeypatch.setattr(listing, "PAGE", 2)
    many = os.path.join(base, "many")
    os.makedirs(many)
    for i in range(5):
        open(os.path.join(many, f"f{i}"), "w").close()
    assert [b.num_rows for b in ListingReader({"path": base}).read(Folder(many, True))] == [2, 2, 1]
    # With a limit a folder is not read further.
    assert sum(b.num_rows for b in ListingReader({"path": base, "max_keys": "3"}).read(Folder(many, True))) == 3


def test_stores_that_only_spark_opens(spark, base):
    """viewfs is such a store."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.listing.link./in", f"file://{base}")
    found = [r["path"] for r in listed_files(spark, "viewfs://listing/in/a").collect()]
    assert sorted(p.rsplit("/a/", 1)[1] for p in found) == ["x=1/f1", "x=1/f2", "x=2/f1"]
