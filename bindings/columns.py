"""Text, date and URL columns over documents, events and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.tables import (
    AS_OF,
    LINKS,
    NEWS,
    big,
    day,
    links,
    news,
    second,
    sql_chars,
    table,
)
from newsflow.functions import dates as D
from newsflow.functions import text as X
from newsflow.functions import urls as U
from newsflow.operators import incremental as I
from newsflow.operators.pages import frontier as frontier_of
from newsflow.sources import landing as L
from newsflow.sources import news as N

_WS = sql_chars(X.WHITESPACE)
SQL_STRIP = f"coalesce(trim({{c}}, {_WS}), '')"
SQL_CLEAN = f"regexp_replace({SQL_STRIP}, '[' || {_WS} || ']+', ' ', 'g')"


def sql_strip(c: str) -> str:
    return SQL_STRIP.format(c=c)


def sql_clean(c: str) -> str:
    return SQL_CLEAN.format(c=c)


def scan_news(spark, sf_dir):
    rows = N.normalise_news(news(spark, sf_dir))
    return rows.select("ticker", day("date").alias("date"), "url", "content")


def strip_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    padded = F.concat(F.lit(" \t　"), "text", F.lit(" \n "))
    return docs.select("doc_id", X.strip(padded).alias("text"))


def clean_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", X.clean(F.col("text")).alias("text"))


def truncate_lower(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        X.truncate(X.strip(F.col("text"))).alias("head"),
        X.normalise_label(F.concat(F.lit(" "), F.upper("lang"), F.lit("\t"))).alias("label"),
    )


def default_content(spark, sf_dir):
    """Every title and text, cut to what stands before its first e, blank in many rows."""
    head = lambda c: F.substring_index(c, "e", 1)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        X.default_title(F.when(F.length("lang") > 0, head(F.col("lang")))).alias("title"),
        X.default_content(F.concat(head(F.col("text")), F.substring_index("text", " ", -1))).alias("content"),
        X.default_content(F.nullif(head(F.col("lang")), F.lit("d"))).alias("from_null"),
    )


def base_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    summary = F.when(F.col("lang") == "en", "").when(F.col("lang") == "fr", F.col("source"))
    return docs.select("doc_id", X.base_text(summary, F.col("text")).alias("base"))


def non_empty(spark, sf_dir):
    """Every word of every text counts for one row; texts of markup alone have none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    tails = docs.select(F.col("doc_id") + 10**9, F.substring_index("content", ".", -1))
    return docs.union(tails).filter(~X.is_blank(F.col("content"))).select("doc_id")


def date_guess(spark, sf_dir):
    stamp = D.iso_seconds(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", D.date_guess(stamp).alias("guess"))


def local_date(spark, sf_dir):
    """Both forms: the zone-less column, and text with an offset."""
    rows = table(spark, sf_dir, "events")
    zulu = F.concat(D.iso_seconds(F.col("ts")), F.lit("Z"))
    west = F.concat(D.iso_seconds(F.col("ts")), F.lit("-0500"))
    return rows.select(
        "event_id",
        day(D.utc_to_local_date(F.col("ts"))).alias("from_column"),
        day(D.local_date(zulu)).alias("from_text"),
        day(D.local_date(west)).alias("from_west"),
        day(D.local_date(D.iso_seconds(F.col("ts")))).alias("from_zoneless"),
    )


def union_by_name(spark, sf_dir):
    """Columns one side lacks are filled; nulls of columns both have stay."""
    sup = table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("name"), F.col("s_acctbal").alias("acctbal")
    )
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("acctbal"), F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
    )
    return L.union_by_name(sup, cust)


def lineage(spark, sf_dir):
    rows = news(spark, sf_dir).select("ticker", "url")
    return L.with_lineage(rows, "run-1", F.lit("2024-01-30 12:34:56").cast("timestamp_ntz"))


def object_keys(spark, sf_dir):
    days = N.ticker_dates(links(spark, sf_dir))
    return days.select(
        U.raw_key(F.col("ticker"), F.col("date")).alias("raw_key"),
        U.result_key(F.col("ticker"), F.col("date")).alias("result_key"),
    )


def frontier(spark, sf_dir):
    return frontier_of(table(spark, sf_dir, "customer"), "c_mktsegment")


def ticker_dates(spark, sf_dir):
    days = N.ticker_dates(table(spark, sf_dir, "events"), "user_id", F.to_date("ts"))
    return days.select("ticker", day("date").alias("date"))


def last_date(spark, sf_dir):
    return I.last_dates(links(spark, sf_dir)).select("ticker", day("last_date").alias("last_date"))


def articles_per_day(spark, sf_dir):
    from newsflow.operators.stats import articles_per_day as count_days

    return count_days(links(spark, sf_dir)).select("ticker", day("date").alias("date"), "articles")


def url_head(spark, sf_dir):
    heads = N.url_heads(two_runs(links(spark, sf_dir)), 3)
    return heads.select("ticker", day("date").alias("date"), "url", big("rank"))


_PURCHASES = "SELECT ticker, max(date) AS last_date FROM links WHERE event_type = 'purchase' GROUP BY ticker"


def since_last(spark, sf_dir):
    """Views without a date, purchases as what has landed."""
    rows = links(spark, sf_dir)
    last = I.last_dates(rows.filter("event_type = 'purchase'"))
    cards = rows.filter("event_type <> 'purchase'").withColumn(
        "date", F.when(F.col("event_type") != "view", F.col("date"))
    )
    loose = I.since_last(cards, last, "date", keep_null=True).select("pos", F.lit("loose").alias("form"))
    strict = I.since_last(cards, last, "date", keep_null=False).select("pos", F.lit("strict").alias("form"))
    return loose.unionByName(strict)


def _stats(spark, sf_dir):
    rows = links(spark, sf_dir)
    inputs = I.partition_stats(rows.filter("event_type <> 'purchase'"), "ts")
    outputs = I.partition_stats(rows.filter("event_type = 'purchase'"), "ts")
    return inputs, outputs


_STATS = """inputs AS (SELECT ticker, date, count(*) AS row_count, max(ts) AS mtime FROM links
            WHERE event_type <> 'purchase' GROUP BY ticker, date),
  outputs AS (SELECT ticker, date, count(*) AS row_count, max(ts) AS mtime FROM links
            WHERE event_type = 'purchase' GROUP BY ticker, date)"""


def pending_partitions(spark, sf_dir):
    pending = I.pending_partitions(*_stats(spark, sf_dir))
    return pending.select("ticker", day("date").alias("date"), "row_count", second("mtime").alias("mtime"))


def select_partitions(spark, sf_dir):
    """The four ways to choose, tagged."""
    inputs, outputs = _stats(spark, sf_dir)
    ways = {
        "all": I.select_partitions(inputs, outputs, mode="all"),
        "ticker": I.select_partitions(inputs, outputs, ticker="8", mode="pending"),
        "date": I.select_partitions(inputs, outputs, date="2024-01-15"),
        "pending": I.select_partitions(inputs, outputs),
    }
    tagged = [d.select(F.lit(w).alias("way"), "ticker", day("date").alias("date")) for w, d in ways.items()]
    result = tagged[0]
    for part in tagged[1:]:
        result = result.unionByName(part)
    return result


_PENDING = """SELECT i.* FROM inputs i LEFT JOIN outputs o ON i.ticker = o.ticker AND i.date = o.date
  WHERE o.row_count IS NULL OR i.mtime > o.mtime OR o.row_count = 0"""


def _today():
    return F.lit(AS_OF).cast("date")


def two_runs(rows, pos="pos"):
    """Rows of two runs whose positions both begin at zero and repeat."""
    return rows.withColumns({"run_id": F.concat(F.lit("r"), (F.col(pos) % 2).cast("string")), "pos": F.col(pos) % 7})


TWO_RUNS = "(SELECT * REPLACE (pos % 7 AS pos), 'r' || (pos % 2) AS run_id FROM {source})"


def stop_set(spark, sf_dir):
    stop = I.stop_set(two_runs(links(spark, sf_dir)), _today())
    return stop.select("ticker", "url", day("date").alias("date"), big("rank"))


SQL_STOP = """heads AS (
    SELECT * FROM (SELECT *,
      row_number() OVER (PARTITION BY ticker, date ORDER BY {order}) AS k FROM {source}
      WHERE date_diff('day', date, DATE '{today}') <= 7) WHERE k <= 15),
  firsts AS (SELECT * FROM (SELECT * EXCLUDE (k),
      row_number() OVER (PARTITION BY ticker, url ORDER BY date DESC, {order}) AS k FROM heads) WHERE k = 1),
  stop AS (SELECT * FROM (SELECT ticker, url, date,
      row_number() OVER (PARTITION BY ticker ORDER BY date DESC, {order}) AS rank FROM firsts) WHERE rank <= 15)"""


def stop_anti(spark, sf_dir):
    """Links of a ticker against the stop set of its purchases."""
    rows = links(spark, sf_dir).withColumn(
        "url", F.concat(F.lit("item/"), F.element_at(F.split("url", "/"), -1))
    )
    stop = I.stop_set(rows.filter("event_type = 'purchase'"), _today())
    fresh = I.drop_stopped(rows.filter("event_type <> 'purchase'"), stop)
    return fresh.select("ticker", "url", "pos")


_ITEMS = "items AS (SELECT ticker, date, 'item/' || split_part(url, '/', 2) AS url, pos, event_type FROM links)"


def cap_per_ticker(spark, sf_dir):
    from newsflow.operators.ranking import cap_per_ticker as cap

    return cap(links(spark, sf_dir), 40).select("ticker", "url", "pos")


QUERIES = {
    "scan_news": (
        scan_news,
        f"""WITH {NEWS} SELECT ticker, strftime(date, '%Y-%m-%d') AS date, url,
        {sql_strip('content')} AS content FROM news""",
    ),
    "strip_text": (
        strip_text,
        f"SELECT doc_id, {sql_strip('chr(160) || chr(9) || chr(12288) || text || chr(32) || chr(10) || chr(8195)')} AS text FROM documents",
    ),
    "clean_text": (clean_text, f"SELECT doc_id, {sql_clean('text')} AS text FROM documents"),
    "truncate_lower": (
        truncate_lower,
        f"SELECT doc_id, substr({sql_strip('text')}, 1, 512) AS head, coalesce(lower(lang), 'unknown') AS label FROM documents",
    ),
    "default_content": (
        default_content,
        """SELECT doc_id, split_part(lang, 'e', 1) AS title,
        coalesce(nullif(split_part(text, 'e', 1) || list_last(string_split(text, ' ')), ''), '본문 없음') AS content,
        coalesce(nullif(nullif(split_part(lang, 'e', 1), 'd'), ''), '본문 없음') AS from_null FROM documents""",
    ),
    "base_text": (
        base_text,
        """SELECT doc_id, coalesce(nullif(CASE lang WHEN 'en' THEN '' WHEN 'fr' THEN source END, ''), text) AS base
        FROM documents""",
    ),
    "non_empty": (
        non_empty,
        f"""SELECT doc_id FROM documents WHERE {sql_strip('text')} <> '' UNION ALL
        SELECT doc_id + 1000000000 FROM documents WHERE {sql_strip("list_last(string_split(text, '.'))")} <> ''""",
    ),
    "date_guess": (
        date_guess,
        "SELECT event_id, split_part(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 'T', 1) AS guess FROM events",
    ),
    "local_date": (
        local_date,
        """SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS from_column,
        strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS from_text,
        strftime(ts + INTERVAL 14 HOUR, '%Y-%m-%d') AS from_west,
        CAST(NULL AS VARCHAR) AS from_zoneless FROM events""",
    ),
    "union_by_name": (
        union_by_name,
        """SELECT CASE WHEN s_acctbal > 0 THEN s_name END AS name, s_acctbal AS acctbal, '' AS segment FROM supplier
        UNION ALL SELECT c_name, c_acctbal, nullif(c_mktsegment, 'BUILDING') FROM customer""",
    ),
    "lineage": (
        lineage,
        f"WITH {NEWS} SELECT ticker, url, '2024-01-30T12:34:56' AS fetched_at, 'run-1' AS run_id FROM news",
    ),
    "object_keys": (
        object_keys,
        f"""WITH {LINKS} SELECT DISTINCT 'raw/' || ticker || '/' || strftime(date, '%Y-%m-%d') || '/news.csv' AS raw_key,
        'results/' || ticker || '/' || strftime(date, '%Y-%m-%d') || '.csv' AS result_key FROM links""",
    ),
    "frontier": (
        frontier,
        """SELECT DISTINCT c_mktsegment AS ticker,
        'https://finance.yahoo.com/quote/' || c_mktsegment || '/news?p=' || c_mktsegment AS url FROM customer""",
    ),
    "ticker_dates": (
        ticker_dates,
        "SELECT DISTINCT user_id AS ticker, strftime(ts, '%Y-%m-%d') AS date FROM events",
    ),
    "last_date": (
        last_date,
        f"WITH {LINKS} SELECT ticker, strftime(max(date), '%Y-%m-%d') AS last_date FROM links GROUP BY ticker",
    ),
    "articles_per_day": (
        articles_per_day,
        f"WITH {LINKS} SELECT ticker, strftime(date, '%Y-%m-%d') AS date, count(*) AS articles FROM links GROUP BY ticker, links.date",
    ),
    "url_head": (
        url_head,
        f"""WITH {LINKS} SELECT ticker, strftime(date, '%Y-%m-%d') AS date, url, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY run_id, pos, url) AS rank
        FROM {TWO_RUNS.format(source='links')}) WHERE rank <= 3""",
    ),
    "since_last": (
        since_last,
        f"""WITH {LINKS}, last AS ({_PURCHASES}),
        cards AS (SELECT ticker, pos, CASE WHEN event_type <> 'view' THEN date END AS date
                  FROM links WHERE event_type <> 'purchase'),
        j AS (SELECT c.pos, c.date, l.last_date FROM cards c LEFT JOIN last l ON c.ticker = l.ticker)
        SELECT pos, 'loose' AS form FROM j WHERE last_date IS NULL OR date IS NULL OR date >= last_date
        UNION ALL
        SELECT pos, 'strict' FROM j WHERE last_date IS NULL OR date >= last_date""",
    ),
    "pending_partitions": (
        pending_partitions,
        f"""WITH {LINKS}, {_STATS} SELECT ticker, strftime(date, '%Y-%m-%d') AS date, row_count,
        strftime(mtime, '%Y-%m-%d %H:%M:%S.%f') AS mtime FROM ({_PENDING})""",
    ),
    "select_partitions": (
        select_partitions,
        f"""WITH {LINKS}, {_STATS}, pending AS ({_PENDING}),
        chosen AS (SELECT 'all' AS way, ticker, date FROM inputs
          UNION ALL SELECT 'ticker', ticker, date FROM pending WHERE ticker = '8'
          UNION ALL SELECT 'date', ticker, date FROM inputs WHERE date = DATE '2024-01-15'
          UNION ALL SELECT 'pending', ticker, date FROM pending)
        SELECT way, ticker, strftime(date, '%Y-%m-%d') AS date FROM chosen""",
    ),
    "stop_set": (
        stop_set,
        f"""WITH {LINKS}, {SQL_STOP.format(source=TWO_RUNS.format(source='links'), today=AS_OF, order='run_id, pos, url')}
        SELECT ticker, url, strftime(date, '%Y-%m-%d') AS date, rank FROM stop""",
    ),
    "stop_anti": (
        stop_anti,
        f"""WITH {LINKS}, {_ITEMS}, {SQL_STOP.format(source="(SELECT * FROM items WHERE event_type = 'purchase')", today=AS_OF, order='pos, url')}
        SELECT ticker, url, pos FROM items i WHERE event_type <> 'purchase'
        AND NOT EXISTS (SELECT 1 FROM stop s WHERE s.ticker = i.ticker AND s.url = i.url)""",
    ),
    "cap_per_ticker": (
        cap_per_ticker,
        f"""WITH {LINKS} SELECT ticker, url, pos FROM (
        SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY pos) AS k FROM links) WHERE k <= 40""",
    ),
}
