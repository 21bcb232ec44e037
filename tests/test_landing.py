"""Landing, files, CSV and the jobs that write."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from newsflow.plans.analyze import Backends, analyze_news
from newsflow.plans.ingest import ingest_news
from newsflow.plans.two_stage import two_stage_run
from newsflow.schemas import RAW_NEWS, RESULTS
from newsflow.sources import files as FS
from newsflow.sources import landing as L
from newsflow.sources import news as N
from newsflow.streaming.continuous import start_analysis

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def article(url, date=D1, ticker="A", pos=0, content="text"):
    return (url, "t", content, 200, "2024-01-01T00:00:00", "r", None, pos, ticker, date)


def landed(spark, base):
    return {(r.ticker, r.date, r.url, r.content) for r in L.read_landed(spark, base, RAW_NEWS).collect()}


@pytest.mark.parametrize("rewrite", [False, True])
def test_landing_keeps_the_first_and_is_idempotent(spark, rows, tmp_path, rewrite):
    base = str(tmp_path / "raw")
    first = [article(" u1 ", pos=1, content="one"), article("u1", pos=2, content="two"), article("u2", date=D2),
             article(None), article("u3", date=None)]
    L.land_by_date(rows(first, RAW_NEWS), base, rewrite)
    want = {("A", D1, "u1", "one"), ("A", D2, "u2", "text")}
    assert landed(spark, base) == want
    # the same again adds nothing; a later day may hold the same URL; an old row wins
    again = L.land_by_date(rows(first, RAW_NEWS), base, rewrite)
    assert (again.added.count(), again.quarantined.count(), again.rejected.count()) == (0, 2, 3)
    assert landed(spark, base) == want
    second = [article("u1", content="late"), article("u1", date=D2, content="other day"), article("u9", ticker="B")]
    L.land_by_date(rows(second, RAW_NEWS), base, rewrite)
    assert landed(spark, base) == want | {("A", D2, "u1", "other day"), ("B", D1, "u9", "text")}
    assert L.read_landed(spark, base, RAW_NEWS).count() == 4
    assert L.landable(rows(first, RAW_NEWS))[1].count() == 2
    held = spark.read.parquet(L.quarantine_path(base)).groupBy("reason").count().collect()
    # Landed twice, quarantined once.
    assert {tuple(r) for r in held} == {("no url", 1), ("no date", 1)}


def test_landed_quarantined_and_rejected_are_the_batch(spark, rows, tmp_path):
    base = str(tmp_path / "raw")
    L.land_by_date(rows([article("u0")], RAW_NEWS), base)
    batch = [article(u, date=d, ticker=t, pos=i) for i, (u, d, t) in enumerate(
        [(u, d, t) for u in ("u0", "u1", " u1", None) for d in (D1, D2, None) for t in ("A", "B", None)])]
    out = L.land_by_date(rows(batch, RAW_NEWS), base, held=F.col("pos") == 9, why=F.lit("why"))
    parts = [{r.pos for r in part.collect()} for part in (out.added, out.quarantined, out.rejected)]
    assert sum(map(len, parts)) == len(batch) and set().union(*parts) == set(range(len(batch)))
    assert {r.reason for r in out.quarantined.collect()} == {"no url", "no date", "no ticker", "why"}
    folder = out.scratch.paths[0].removeprefix("file:")
    assert os.path.isdir(folder)
    out.drop()
    assert not os.path.exists(folder) and not out.scratch.paths


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from newsflow.session import scratch_path

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(RuntimeError):
        scratch_path(fake, "x")
    fake.conf = SimpleNamespace(get=lambda *_: "hdfs://shared/")
    assert scratch_path(fake, "x").startswith("hdfs://shared/newsflow/x-")


def test_landing_prunes_days(spark, rows, tmp_path):
    base = str(tmp_path / "raw")
    L.land_by_date(rows([article(f"u{i}", date=D1 + dt.timedelta(days=i)) for i in range(5)], RAW_NEWS), base)
    from newsflow.operators.incremental import in_partitions

    chosen = rows([("A", D2)], "ticker string, date date")
    plan = in_partitions(L.read_landed(spark, base, RAW_NEWS), chosen)._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "2024-01-02" in filters.split("PartitionFilters")[1]


def test_rewrite_leaves_other_partitions_alone(spark, rows, tmp_path):
    base = str(tmp_path / "raw")
    L.land_by_date(rows([article("u1"), article("u2", date=D2)], RAW_NEWS), base, rewrite=True)
    part = os.path.join(base, "ticker=A", f"date={D1}")
    before = sorted(os.listdir(part))
    L.land_by_date(rows([article("u3", date=D2)], RAW_NEWS), base, rewrite=True)
    assert sorted(os.listdir(part)) == before
    other = os.path.join(base, "ticker=A", f"date={D2}")
    assert len([f for f in os.listdir(other) if f.endswith(".parquet")]) == 1


def test_union_and_lineage(spark, rows):
    old = rows([("a", None)], "x string, y string")
    new = rows([("b", "c")], "x string, z string")
    assert {tuple(r) for r in L.union_by_name(old, new).select("x", "y", "z").collect()} == {("a", None, ""), ("b", "", "c")}
    assert L.complete_columns(new, ["x", "w"]).columns == ["x", "z", "w"]
    row = L.with_lineage(new, "run", F.lit(dt.datetime(2024, 1, 2, 3, 4, 5, 678))).collect()[0]
    assert (row.fetched_at, row.run_id) == ("2024-01-02T03:04:05", "run")


def test_results_round_trip(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    texts = [(" a, \"quoted\"\nline ", None, ["k1", "k2"]), ("", "pos", [])]
    df = rows(texts, "summary string, sentiment string, keywords array<string>")
    L.write_results(df, path)
    back = N.scan_csv(spark, path, "summary string, sentiment string, keywords string").na.fill("")
    assert {tuple(r) for r in back.collect()} == {('a, "quoted"\nline', "", "k1, k2"), ("", "pos", "")}


def test_legacy_csv(spark, tmp_path):
    one, two = tmp_path / "raw" / "A" / "2024-01-01", tmp_path / "raw" / "A" / "2024-01-02"
    one.mkdir(parents=True), two.mkdir(parents=True)
    (one / "news.csv").write_text('url,content\nu1," two\nlines ""q"" "\nu2,\n')
    (two / "news.csv").write_text("url,content\n")
    base = str(tmp_path / "raw")
    got = N.scan_legacy_news(spark, base, "url string, content string").orderBy("url").collect()
    assert [(r.ticker, r.date, r.url, r.content) for r in got] == [
        ("A", D1, "u1", 'two\nlines "q"'), ("A", D1, "u2", ""),
    ]
    counts = FS.file_row_counts(N.scan_csv(spark, f"{base}/*/*/news.csv", "url string, content string"))
    facts = FS.file_facts(FS.all_files(spark, base), counts, "raw").orderBy("s3_key").collect()
    assert [r.row_count for r in facts] == [2, 0]
    assert N.normalise_news(spark.createDataFrame([("u",)], "url string")).collect()[0].content == ""
    assert N.normalise_news(spark.createDataFrame([(1,)], "content int")).collect()[0].content == ""


def test_legacy_results(spark, tmp_path):
    folder = tmp_path / "results" / "A"
    folder.mkdir(parents=True)
    (folder / "2024-01-01.csv").write_text('summary,sentiment,keywords\n"s, one",positive,"a, b"\n')
    (folder / "2024-01-02.csv").write_text("summary,sentiment,keywords\n")
    got = N.scan_legacy_results(spark, str(tmp_path / "results")).collect()
    assert [tuple(r) for r in got] == [("s, one", "positive", "a, b", "A", D1)]


def test_files(spark, tmp_path):
    for name in ("b", "a", "c"):
        (tmp_path / name).write_text("x" * (ord(name) - 96))
    base = str(tmp_path)
    listed = FS.file_inventory(spark, base, max_keys=2).collect()
    assert [(r.path[-1], r["size"]) for r in listed] == [("a", 1), ("b", 2)]
    assert tuple(FS.find_file(spark, f"{base}/c").collect()[0]) == (True, 3)
    assert tuple(FS.find_file(spark, f"{base}/nope").collect()[0]) == (False, None)
    with pytest.raises(Exception):
        N.scan_news(spark, f"{base}/missing").count()


PAGE = '<h1>{0}</h1><article><p>{0} is good.</p></article><time datetime="2024-01-{1}T20:00:00Z">'


def tables(rows):
    cards = rows(
        [("A", 0, "/n/1", "2024-01-05T00:00:00Z"), ("A", 1, "/n/1", None), ("A", 2, "/n/old", "2024-01-01T00:00:00Z"),
         ("A", 3, "/n/2", None), ("A", 4, "", None), ("A", 5, "/n/missing", None), ("A", 6, "/n/stale", None),
         ("B", 0, "/n/2", None), ("A", 7, "/n/broken", None)],
        "ticker string, pos int, href string, datetime string",
    )
    host = "https://finance.yahoo.com"
    pages = rows(
        [(host + "/n/1", PAGE.format("one", "05"), 200), (host + "/n/2", PAGE.format("two", "06"), 404),
         (host + "/n/old", PAGE.format("old", "07"), 200), (host + "/n/stale", PAGE.format("stale", "01"), 200),
         (host + "/n/broken", None, 200)],
        "url string, html string, status_code int",
    )
    return cards, pages


OPTIONS = {"as_of": dt.date(2024, 1, 9), "run_id": "r2"}


def options():
    return {**OPTIONS, "fetched_at": F.lit(dt.datetime(2024, 1, 9))}


def test_ingest_twice(spark, rows, tmp_path):
    base = str(tmp_path / "raw")
    cards, pages = tables(rows)
    L.land_by_date(rows([article("https://finance.yahoo.com/n/0", date=dt.date(2024, 1, 3))], RAW_NEWS), base)
    got = ingest_news(cards, pages, L.read_landed(spark, base, RAW_NEWS), base, **options()).added.collect()
    # /n/old is older than the last date, /n/stale turns out to be; broken pages wait
    assert {(r.ticker, r.date.day, r.url[-3:], r.title, r.status_code) for r in got} == {
        ("A", 6, "n/1", "one", 200), ("A", 7, "n/2", "two", 404), ("B", 7, "n/2", "two", 404),
    }
    held = spark.read.parquet(L.quarantine_path(base)).collect()
    assert {(r.url[-7:], r.reason == "not fetched") for r in held} == {("missing", True), ("/broken", False)}
    again = ingest_news(cards, pages, L.read_landed(spark, base, RAW_NEWS), base, **options())
    assert again.added.count() == 0
    errors = ingest_news(
        cards, pages, L.read_landed(spark, base, RAW_NEWS), base, land_errors=True, **options()
    ).added.collect()
    assert {(r.url[-7:], r.date, r.content, bool(r.error)) for r in errors} == {
        ("/broken", OPTIONS["as_of"], "", True), ("missing", OPTIONS["as_of"], "", True)
    }


def test_one_article_for_several_fetches(spark, rows, tmp_path):
    host = "https://finance.yahoo.com"
    cards = rows([("A", 0, "/n/1", None), ("A", 1, "/n/2", None)], "ticker string, pos int, href string, datetime string")
    long = '<h1>late</h1><article><p>' + "long " * 9 + '</p></article><time datetime="2024-01-07T01:00:00Z">'
    early, late = dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 9)
    pages = [(host + "/n/1", PAGE.format("thin", "05"), 200, "http", early), (host + "/n/1", long, 201, "browser", late),
             (host + "/n/2", PAGE.format("late", "06"), 200, "http", late), (host + "/n/2", PAGE.format("early", "05"), 404, "http", early),
             (host + "/n/2", None, 500, "http", early)]
    for number, order in enumerate((pages, pages[::-1])):
        table = rows(order, "url string, html string, status_code int, fetch_kind string, fetched_at timestamp")
        base = str(tmp_path / f"raw{number}")
        got = ingest_news(cards, table, L.read_landed(spark, base, RAW_NEWS), base, **options()).added.collect()
        assert {(r.url[-3:], r.title, r.status_code, r.date.day) for r in got} == {("n/1", "late", 200, 7), ("n/2", "early", 404, 6)}


def test_two_stages(spark, rows, tmp_path):
    _, pages = tables(rows)
    base, results = str(tmp_path / "raw"), str(tmp_path / "results")
    card = '<section data-testid="storyitem"><a href="{}">x</a></section>'
    listings = rows([("A", card.format("/n/1") + card.format("/n/missing")), ("B", card.format("/n/2") * 2)], "ticker string, html string")
    L.land_by_date(rows([article("u0", ticker="C", content="Old good day.")], RAW_NEWS), base)
    backends = Backends(sentiment_weights={"good": 1.0})
    out = two_stage_run(listings, pages, base, results, backends, **options())
    assert {(r.ticker, r.url[-3:], r.summary, r.sentiment) for r in out.collect()} == {
        ("A", "n/1", "one is good.", "positive"), ("B", "n/2", "two is good.", "positive"),
        ("C", "u0", "Old good day.", "positive"),
    }
    with pytest.raises(ValueError):
        analyze_news(L.read_landed(spark, base, RAW_NEWS))


def test_winners_do_not_depend_on_row_order(spark, rows, tmp_path):
    two = [article("b", content="Same."), article("a", content="Same.")]
    weights = Backends(sentiment_weights={"good": 1.0})
    for number, order in enumerate((two, two[::-1])):
        base = str(tmp_path / f"raw{number}")
        L.land_by_date(rows(order, RAW_NEWS).coalesce(1), base)
        assert [r.url for r in analyze_news(L.read_landed(spark, base, RAW_NEWS), backends=weights).collect()] == ["a"]
        assert analyze_news(rows(order, RAW_NEWS), rows(order, RAW_NEWS).selectExpr(
            "url", "fetched_at", "run_id", "pos", "content as summary", "'neutral' as sentiment", "'' as keywords", "ticker", "date"
        ), weights, dedup=()).count() == 2


def test_stream_equals_batch_and_replays_nothing(spark, rows, tmp_path):
    base, results, check = (str(tmp_path / n) for n in ("raw", "results", "check"))
    backends = Backends(sentiment_weights={"good": 1.0})
    L.land_by_date(rows([article("u1", content="Good day. More."), article("u2", content="Good day. Else.", pos=1)], RAW_NEWS), base)
    start_analysis(spark, base, results, check, backends).awaitTermination()
    L.land_by_date(rows([article("u3", content="Bad day.", pos=2), article("u4", date=D2, content="Good day.")], RAW_NEWS), base)
    start_analysis(spark, base, results, check, backends).awaitTermination()
    start_analysis(spark, base, results, check, backends).awaitTermination()
    have = {(r.date, r.url, r.summary, r.sentiment) for r in L.read_landed(spark, results, RESULTS).collect()}
    batch = analyze_news(L.read_landed(spark, base, RAW_NEWS), backends=backends)
    assert have == {(r.date, r.url, r.summary, r.sentiment) for r in batch.collect()}
    assert have == {(D1, "u1", "Good day.", "positive"), (D1, "u3", "Bad day.", "neutral"), (D2, "u4", "Good day.", "positive")}


def test_stored_backfill_follows_the_files(spark, rows, tmp_path):
    from newsflow.plans.analyze import run_backfill

    base, results = str(tmp_path / "raw"), str(tmp_path / "results")
    backends = Backends(sentiment_weights={"good": 1.0})
    L.land_by_date(rows([article("u1", content="Good day."), article("u2", date=D2, content=" ")], RAW_NEWS), base)
    assert {r.url for r in run_backfill(spark, base, results, backends).collect()} == {"u1"}
    # nothing is newer; a day without results stays pending and still yields none
    assert run_backfill(spark, base, results, backends).count() == 0
    assert {r.url for r in run_backfill(spark, base, results, backends, date="2024-01-01").collect()} == {"u1"}
    L.land_by_date(rows([article("u3", content="Late day.", pos=4)], RAW_NEWS), base)
    later = 4102444800
    for folder, _, names in os.walk(os.path.join(base, "ticker=A", f"date={D1}")):
        for name in names:
            os.utime(os.path.join(folder, name), (later, later))
    spark.catalog.clearCache()
    assert {r.url for r in run_backfill(spark, base, results, backends, ticker="A").collect()} == {"u1", "u3"}
    assert L.read_landed(spark, results, RESULTS).count() == 2


def test_command_line(spark, rows, tmp_path):
    from newsflow.__main__ import main

    cards, pages = tables(rows)
    where = {n: str(tmp_path / n) for n in ("cards", "pages", "raw", "results")}
    cards.write.parquet(where["cards"]), pages.write.parquet(where["pages"])
    main(["ingest", "--cards", where["cards"], "--pages", where["pages"], "--base", where["raw"], "--as-of", "2024-01-09"])
    weights = tmp_path / "weights.json"
    weights.write_text('{"good": 1}')
    main(["analyze", "--base", where["raw"], "--results", where["results"], "--mode", "all", "--weights", str(weights)])
    assert {r.summary for r in L.read_landed(spark, where["results"], RESULTS).collect()} >= {"one is good.", "two is good."}


def test_stream_and_backfill_read_their_days_only(spark, rows, tmp_path, monkeypatch):
    """Both choose from stored tables through ``in_partitions``, which filters both sides."""
    from newsflow.operators import incremental
    from newsflow.plans import analyze
    from newsflow.streaming import continuous

    seen = []

    def watched(table, chosen):
        out = incremental.in_partitions(table, chosen)
        plan = out._jdf.queryExecution().executedPlan().toString()
        seen.append([line for line in plan.splitlines() if "PartitionFilters" in line and "date#" in line])
        return out

    monkeypatch.setattr(analyze, "in_partitions", watched)
    monkeypatch.setattr(continuous, "in_partitions", watched)
    base, results, check = (str(tmp_path / n) for n in ("raw", "results", "check"))
    backends = Backends(sentiment_weights={"good": 1.0})
    L.land_by_date(rows([article("u1"), article("u2", date=D2)], RAW_NEWS), base)
    analyze.run_backfill(spark, base, results, backends, date="2024-01-02")
    L.land_by_date(rows([article("u3", date=D2)], RAW_NEWS), base)
    start_analysis(spark, base, results, check, backends).awaitTermination()
    filters = [line.split("PartitionFilters: [")[1] for lines in seen for line in lines]
    tables = [f for f in filters if not f.startswith("]")]
    assert len(tables) >= 3 and all(">= 2024-01-0" in f for f in tables)
