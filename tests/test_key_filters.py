"""Filters of landed URLs: nothing landed is missed, days answered no are not read."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from newsflow.operators import key_filters as K
from newsflow.operators.incremental import drop_landed
from newsflow.sources import landing as L

DDL = "ticker string, date date, url string, content string, pos long"
DAY = dt.date(2024, 1, 1)


def batch(spark, pairs):
    """Rows of ``(ticker, days after the first, url)``."""
    return spark.createDataFrame([(t, DAY + dt.timedelta(d), u, f"text of {u}", i) for i, (t, d, u) in enumerate(pairs)], DDL)


def urls(rows):
    return sorted((r["ticker"], r["date"], r["url"].strip()) for r in rows.collect())


def test_no_landed_url_is_missed_on_days_of_one_and_of_many_pages(spark):
    made = spark.range(9000).select(
        F.lit("a").alias("ticker"), F.lit(DAY).alias("date"), F.concat(F.lit(" u"), F.col("id").cast("string")).alias("url")
    )
    small = made.limit(40).withColumn("ticker", F.lit("b"))
    filters = K.key_filters(made.unionByName(small))
    assert {(r["ticker"], r["pages"]) for r in filters.collect()} == {("a", 5), ("b", 1)}
    assert K.maybe_landed(made.unionByName(small), filters).count() == 9040
    unknown = made.withColumn("url", F.concat(F.lit("new"), F.col("url")))
    assert K.maybe_landed(unknown, filters).count() < 9000 * 0.02


def test_missing_keys_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, DAY, "u"), ("a", None, "u"), ("a", DAY, None)], "ticker string, date date, url string")
    filters = K.key_filters(rows)
    # A missing URL counts as an empty one; rows without ticker or day are in no filter.
    assert filters.count() == 1
    assert K.drop_landed_filtered(rows, rows, filters).count() == drop_landed(rows, rows).count() == 2
    none = rows.limit(0)
    assert K.key_filters(none).count() == 0
    assert K.days_to_read(rows, K.key_filters(none)).count() == 0
    assert K.drop_landed_filtered(rows, none, K.key_filters(none)).count() == 3


def test_days_answered_no_are_not_read(spark, tmp_path):
    base = str(tmp_path / "landed")
    filters = L.filter_path(base)
    L.land_by_date(batch(spark, [("a", 0, "u1"), ("a", 1, "u2"), ("b", 1, "u3")]), base, filters=filters).drop()
    # A day that were read would end the job.
    for path in glob.glob(f"{base}/ticker=a/date=2024-01-02/*.parquet"):
        with open(path, "wb") as file:
            file.write(b"broken")
    new = batch(spark, [("a", 0, " u1 "), ("a", 0, "u9"), ("a", 1, "u8"), ("b", 1, "u3"), ("b", 1, "u7")])
    landed = L.read_landed(spark, base, new.schema)
    held = L.read_key_filters(landed, filters)
    assert urls(K.days_to_read(new, held).withColumn("url", F.lit(""))) == [("a", DAY, ""), ("b", DAY + dt.timedelta(1), "")]
    rest = K.drop_landed_filtered(new, landed, held)
    assert urls(rest) == [("a", DAY, "u9"), ("a", DAY + dt.timedelta(1), "u8"), ("b", DAY + dt.timedelta(1), "u7")]
    L.land_by_date(new, base, filters=filters).drop()
    assert L.read_landed(spark, base, new.schema).filter("ticker = 'b'").count() == 2


def test_many_days_are_joined_with_the_same_rows(spark):
    landed = batch(spark, [(t, d, f"u{i}") for t in "ab" for d in range(4) for i in range(3)])
    days = batch(spark, [("a", 1, ""), ("b", 3, ""), ("c", 1, "")]).select("ticker", "date")
    named, joined = K.rows_of_days(landed, days), K.rows_of_days(landed, days, named=2)
    assert urls(named) == urls(joined) and named.count() == 6
    assert K.rows_of_days(landed, days.limit(0)).count() == 0


def test_filters_are_made_for_a_table_that_has_none(spark, tmp_path):
    base = str(tmp_path / "landed")
    old = batch(spark, [("a", d, f"u{i}") for d in range(3) for i in range(5)])
    L.land_by_date(old, base).drop()
    new = batch(spark, [("a", d, f"u{i}") for d in range(4) for i in range(3, 8)])
    landed = L.read_landed(spark, base, old.schema)
    want = urls(drop_landed(new, landed))
    landing = L.land_by_date(new, base, filters=L.filter_path(base))
    assert L.read_key_filters(landed, L.filter_path(base)).count() > 3
    assert urls(L.read_landed(spark, base, old.schema)) == sorted(urls(old) + want)
    landing.drop()
    # A batch that is landed again adds nothing.
    L.land_by_date(new, base, filters=L.filter_path(base)).drop()
    assert L.read_landed(spark, base, old.schema).count() == 15 + len(want)
