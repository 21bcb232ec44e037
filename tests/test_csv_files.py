"""Broken CSV files count 0 and stop nothing; heads prefer parquet."""

import gzip

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from newsflow.sources.csv_files import csv_row_counts, legacy_url_heads

SCHEMA = "url string, title string, content string"
HEAD = "url,title,content\n"
FILES = {
    "sound.csv": (HEAD + 'u1,t,"a ""b"", c\nd"\nu2,,\n', 2, None),
    "fewer.csv": (HEAD + "u1,t\nu2\n", 2, None),
    "commas.csv": (HEAD + 'u1,t,"a,b,c,d,e"\nu1,"x\n,,,,",z\n', 2, None),
    "more.csv": (HEAD + "u1,t,c\nu2,t,c,d\nu3,t,c\n", 0, "1 records have more than 3 fields"),
    "more_empty.csv": (HEAD + "u1,t,c,\n", 0, "1 records have more than 3 fields"),
    "header.csv": (HEAD, 0, None),
    "nothing.csv": ("", 0, "empty file"),
    "odd.csv": (HEAD.encode() + b"u1,\xff\xfe,c\n", 0, "not UTF-8"),
    "packed.csv.gz": (gzip.compress((HEAD + "u1,t,c\n").encode()), 1, None),
    "broken.csv.gz": (b"\x1f\x8b no gzip", 0, "cannot be opened"),
}


def write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())


def test_one_count_per_listed_file(spark, tmp_path):
    for i, (name, (data, _, _)) in enumerate(FILES.items()):
        write(tmp_path / "raw" / f"part {i % 3}%" / name, data)
    write(tmp_path / "raw" / "other.txt", "no table")
    got = {r["path"].rsplit("/", 1)[1]: (r["row_count"], r["error"]) for r in csv_row_counts(spark, str(tmp_path / "raw"), SCHEMA).collect()}
    assert got == {name: (rows, error) for name, (_, rows, error) in FILES.items()}


def heads(spark, base, top_n):
    got = {}
    for r in legacy_url_heads(spark, str(base), top_n, SCHEMA).orderBy("ticker", "date", "rank").collect():
        got.setdefault((r["ticker"], r["date"].day), []).append(r["url"])
    return got


def test_heads_prefer_parquet_and_cut_csv_first(spark, tmp_path):
    base = tmp_path / "raw"
    csv = lambda urls: HEAD + "".join(f"{u},t,c\n" for u in urls)
    write(base / "A" / "2024-01-01" / "news.csv", csv([" u1 ", "", "", "u2", "u3"]))
    write(base / "A" / "2024-01-02" / "news.csv", csv(["c1", "c2"]))
    pq.write_table(pa.table({"content": ["x"] * 5, "url": ["p1", None, "p2 ", "p3", "p4"]}), base / "A" / "2024-01-02" / "news.parquet")
    write(base / "A" / "2024-01-03" / "news.csv", csv(["c1"]))
    write(base / "A" / "2024-01-03" / "news.parquet", b"no parquet")
    write(base / "B" / "2024-01-01" / "news.csv", HEAD + "u1,t,c\nu2,t,c,d\n")
    write(base / "B" / "2024-01-02" / "news.csv", csv(["u1", "u2", "u3", "u4"]) + "u5,t,c,d,e\n")
    write(base / "B" / "someday" / "news.csv", csv(["u1"]))
    write(base / "B" / "2024-01-04" / "news.csv", "")
    assert heads(spark, base, 2) == {
        # Four rows are looked at, two of them without URL.
        ("A", 1): ["u1", "u2"],
        ("A", 2): ["p1", "p2"],
        # The record with too many fields lies behind the rows that count.
        ("B", 2): ["u1", "u2"],
    }


def test_order_of_rows_in_long_files(spark, tmp_path):
    write(tmp_path / "raw" / "A" / "2024-01-01" / "news.csv", HEAD + "".join(f'u{i},t,"line\nbreak"\n' for i in range(3000)))
    assert heads(spark, tmp_path / "raw", 400) == {("A", 1): [f"u{i}" for i in range(400)]}
