"""Files that cannot be read: found, reported, and no hindrance to the others."""

import datetime as dt
import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from newsflow.plans.analyze import Backends, backfill, choose_days
from newsflow.schemas import RAW_NEWS, RESULTS
from newsflow.sources.landing import read_landed, write_partitions
from newsflow.sources.probe import day_row_counts, probe_files

BACKENDS = Backends(sentiment_weights={"good": 1})


def stored(spark, base, days, n=40, text="good news. more text "):
    rows = [(f"u{i}", "t", text + str(i) * 50, 200, "", "run-1", None, i, ticker, dt.date(2024, 1, day)) for ticker, day in days for i in range(n)]
    write_partitions(spark.createDataFrame(rows, RAW_NEWS), base, "append")


def files_of(base, ticker, day):
    return sorted(glob.glob(f"{base}/ticker={ticker}/date=2024-01-{day:02d}/*.parquet"))


def overwrite(path, change):
    data = change(open(path, "rb").read())
    open(path, "wb").write(data)
    # The checksum beside the file would give the change away before it is read.
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def damage_pages(data):
    """Turn the pages of the second half of the columns into noise; the footer stays."""
    end = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
    return data[: end // 3] + b"\xff" * (end - end // 3) + data[end:]


BAD = {
    "no bytes": (lambda data: b"", "empty file"),
    "text": (lambda data: b"hello, this is text", "not a parquet file"),
    "cut off": (lambda data: data[:-10], "cut off: no footer at the end"),
    "wrong length": (lambda data: data[:-8] + b"\xff\xff\xff\x7fPAR1", "footer length is wrong"),
    "noise as footer": (lambda data: data[: len(data) - 60] + b"\x99" * 52 + data[-8:], "footer cannot be read"),
    "damaged pages": (damage_pages, "rows can be read"),
}


@pytest.mark.parametrize("case", BAD)
def test_an_unreadable_file_is_a_row_with_its_error(spark, tmp_path, case):
    base = str(tmp_path / "raw")
    stored(spark, base, [("A", 1), ("B C/%+", 2)])
    change, error = BAD[case]
    overwrite(files_of(base, "A", 1)[0], change)
    got = {r["ticker"]: r for r in probe_files(spark, base, RAW_NEWS, deep=True).collect()}
    assert set(got) == {"A", "B C/%+"}
    assert not got["A"]["readable"] and error in got["A"]["error"]
    assert got["A"]["row_count"] < 40
    assert got["B C/%+"]["readable"] and got["B C/%+"]["error"] is None and got["B C/%+"]["row_count"] == 40


def test_damage_below_an_intact_footer_needs_the_deep_probe(spark, tmp_path):
    base = str(tmp_path / "raw")
    stored(spark, base, [("A", 1)])
    overwrite(files_of(base, "A", 1)[0], damage_pages)
    assert probe_files(spark, base, RAW_NEWS).first()["readable"]
    assert not probe_files(spark, base, RAW_NEWS, deep=True).first()["readable"]


def test_a_file_without_rows_is_readable(spark, tmp_path):
    folder = tmp_path / "raw" / "ticker=A" / "date=2024-01-01"
    folder.mkdir(parents=True)
    pq.write_table(pa.table({"url": pa.array([], pa.string())}), folder / "none.parquet")
    row = probe_files(spark, str(tmp_path / "raw"), RAW_NEWS, deep=True).first()
    assert (row["readable"], row["row_count"], row["error"]) == (True, 0, None)
    assert probe_files(spark, str(tmp_path / "nothing"), RAW_NEWS).count() == 0


def test_probe_of_chosen_days_only(spark, tmp_path):
    base = str(tmp_path / "raw")
    stored(spark, base, [("A", 1), ("A", 2), ("B", 2)])
    days = spark.createDataFrame([("A", dt.date(2024, 1, 2))], "ticker string, date date")
    assert [(r["ticker"], r["date"].day) for r in probe_files(spark, base, RAW_NEWS, days=days).collect()] == [("A", 2)]


def outcomes(done):
    return {(r["ticker"], r["date"].day): (r["status"], r["row_count"], r["error"]) for r in done.outcomes.collect()}


@pytest.mark.parametrize("check_first", [False, True])
def test_a_bad_day_does_not_stop_the_others(spark, tmp_path, check_first):
    base, results = str(tmp_path / "raw"), str(tmp_path / "results")
    days = [("A", 1), ("A", 2), ("B", 2), ("B", 3)]
    stored(spark, base, days)
    overwrite(files_of(base, "A", 2)[0], lambda data: data[:100])
    # A sound file beside a bad one: the day is not analysed in part.
    stored(spark, base, [("A", 2)], n=3)
    done = backfill(spark, base, results, BACKENDS, check_first=check_first)
    assert outcomes(done) == {
        ("A", 1): ("done", 1, None),
        ("A", 2): ("failed", 0, "cut off: no footer at the end"),
        ("B", 2): ("done", 1, None),
        ("B", 3): ("done", 1, None),
    }
    assert read_landed(spark, results, RESULTS).select("ticker", "date").distinct().count() == 3
    # The failed day stays pending, the others are done.
    assert outcomes(backfill(spark, base, results, BACKENDS)) == {("A", 2): ("failed", 0, "cut off: no footer at the end")}
    # Mended, it is analysed.
    os.remove(next(f for f in files_of(base, "A", 2) if os.path.getsize(f) == 100))
    assert outcomes(backfill(spark, base, results, BACKENDS)) == {("A", 2): ("done", 1, None)}


def test_a_damaged_input_is_reported_though_its_footer_is_sound(spark, tmp_path):
    base, results = str(tmp_path / "raw"), str(tmp_path / "results")
    stored(spark, base, [("A", 1), ("A", 2)])
    overwrite(files_of(base, "A", 1)[0], damage_pages)
    got = outcomes(backfill(spark, base, results, BACKENDS))
    assert got[("A", 1)][0] == "failed" and "of 40 rows" in got[("A", 1)][2]
    assert got[("A", 2)] == ("done", 1, None)


def test_an_input_without_bytes_is_reported(spark, tmp_path):
    base, results = str(tmp_path / "raw"), str(tmp_path / "results")
    stored(spark, base, [("A", 1), ("A", 2)])
    overwrite(files_of(base, "A", 1)[0], lambda data: b"")
    assert outcomes(backfill(spark, base, results, BACKENDS)) == {("A", 1): ("failed", 0, "empty file"), ("A", 2): ("done", 1, None)}


def test_other_failures_are_raised(spark, tmp_path):
    base, results = str(tmp_path / "raw"), str(tmp_path / "results")
    stored(spark, base, [("A", 1)])
    broken = Backends(sentiment_weights={"good": 1}, summarise=lambda c: F.raise_error(F.lit("out of order")).cast("string"))
    with pytest.raises(Exception, match="out of order"):
        backfill(spark, base, results, broken)


def test_an_unreadable_or_empty_result_is_pending(spark, tmp_path):
    base, results = str(tmp_path / "raw"), str(tmp_path / "results")
    stored(spark, base, [("A", 1), ("A", 2), ("A", 3)])
    backfill(spark, base, results, BACKENDS)
    assert choose_days(spark, base, results).count() == 0
    overwrite(files_of(results, "A", 1)[0], lambda data: b"")
    pq.write_table(pa.table({"url": pa.array([], pa.string())}), files_of(results, "A", 2)[0])
    assert {r["date"].day for r in choose_days(spark, base, results).collect()} == {1, 2}
    assert {r["date"].day: r["row_count"] for r in day_row_counts(probe_files(spark, results, RESULTS)).collect()} == {1: 0, 2: 0, 3: 1}
    assert set(outcomes(backfill(spark, base, results, BACKENDS))) == {("A", 1), ("A", 2)}
    assert choose_days(spark, base, results).count() == 0
    assert read_landed(spark, results, RESULTS).count() == 3


def test_choosing_days_reads_no_article(spark, tmp_path):
    base, results = str(tmp_path / "raw"), str(tmp_path / "results")
    stored(spark, base, [("A", 1)])
    overwrite(files_of(base, "A", 1)[0], lambda data: b"no parquet")
    # Only the listing is asked, so nothing fails.
    assert choose_days(spark, base, results).count() == 1
    assert choose_days(spark, base, results, mode="all").count() == 1
    assert choose_days(spark, base, results, ticker="B").count() == 0
