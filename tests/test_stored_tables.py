"""Tables stored as one file or as a folder of parts, against the same SQL."""

import glob

import __spark_entry__ as entry
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from bindings import curation
from newsflow.operators import keywords
from newsflow.session import scratch_path
from tests.oracle import TABLES, compare, connect

SMALL = "/root/testdata/sf0.001"


def test_row_counts_of_tables_in_parts(spark, tmp_path):
    for name in TABLES:
        rows = pq.read_table(f"{SMALL}/{name}.parquet")
        folder = tmp_path / f"{name}.parquet"
        folder.mkdir()
        half = 0 if name == "region" else len(rows) // 2
        parts = [rows.slice(0, 0)] if name == "region" else [rows.slice(0, half), rows.slice(half)]
        for i, part in enumerate(parts):
            pq.write_table(part, folder / f"part-{i}.parquet")
    got = {r["name"]: r["row_count"] for r in curation.file_row_counts(spark, str(tmp_path)).collect()}
    want = dict(connect(SMALL).execute(entry.oracle_sql()["file_row_counts"]).fetchall())
    assert got == {**want, "region.parquet": 0}


@pytest.fixture
def shared(tmp_path):
    """The small tables with titles cut within a reference and two URLs that have several
    pages, of which some were not fetched."""
    for name in TABLES:
        rows = pq.read_table(f"{SMALL}/{name}.parquet").to_pydict()
        if name == "pages":
            rows["html"] = [h.replace("</h1>", "&amp</h1>") if i % 3 == 0 else h for i, h in enumerate(rows["html"])]
            for to, froms in ((1, (2, 5)), (10, (13,))):
                for i in froms:
                    rows["url"][i] = rows["url"][to]
        pq.write_table(pa.table(rows, schema=pq.read_schema(f"{SMALL}/{name}.parquet")), tmp_path / f"{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["page_title", "page_articles", "ingest_news", "ingest_errors", "two_stage_run"])
def test_several_pages_of_a_url(spark, shared, name):
    assert compare(spark, connect(shared), entry.queries()[name], entry.oracle_sql()[name], shared).startswith("ok")


def test_a_large_day_of_the_old_layout_is_in_parts(spark, monkeypatch):
    monkeypatch.setattr(curation, "LEGACY_PART_BYTES", 8_000)
    bases = []
    monkeypatch.setattr(curation, "scratch_path", lambda s, name: bases.append(scratch_path(s, name)) or bases[-1])
    assert compare(spark, connect(SMALL), curation.legacy_heads, entry.oracle_sql()["legacy_heads"], SMALL).startswith("ok")
    assert len(glob.glob(f"{bases[0].removeprefix('file:')}/en/2024-01-01/news.csv/part-*")) > 1


def test_keywords_with_a_few_common_terms(spark, monkeypatch):
    monkeypatch.setattr(keywords, "COMMON_TERMS", 200)
    assert compare(spark, connect(SMALL), entry.queries()["keywords_tfidf"], entry.oracle_sql()["keywords_tfidf"], SMALL).startswith("ok")
