"""Chunks, summaries, sentiment, keywords, vectors and the analysis jobs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from bindings.columns import sql_clean, sql_strip, two_runs
from bindings.tables import LABELLED, NEWS, big, day, labelled, news, table
from newsflow.functions.text import STOP_WORDS, WORD_GAP
from newsflow.operators import keywords as K
from newsflow.operators import stats as S
from newsflow.operators import summaries as M
from newsflow.operators.incremental import partition_stats
from newsflow.operators.inference import model_column
from newsflow.operators.ranking import ranked_join
from newsflow.operators.sentiment import lexicon_label, model_label
from newsflow.plans.analyze import Backends, analysis_backfill as backfill, analyze_news as analyze

# Words common in the tables' invented languages, as stand-in for a word list.
WEIGHTS = {
    "the": 1.0, "and": -1.0, "of": -1.0, "de": 1.0, "la": -1.0, "que": -2.0, "le": 1.0,
    "der": 2.0, "und": -1.0, "die": -1.0, "en": 1.0, "es": -1.0, "is": 1.0, "that": -2.0,
    "it": 0.5, "was": -0.5, "with": 1.0,
}
BACKENDS = Backends(sentiment_weights=WEIGHTS)

_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"


def sql_chunks(source: str) -> str:
    """CTEs ``chunked(id, k, chunk)`` from ``source(id, t)`` of cleaned texts.

    Every place where a line may end is a row: before a space, after a hyphen between
    letters, at the end. Each step takes the furthest such place within 1100 characters.
    No word here is longer than a line, and none holds a double hyphen.
    """
    return f"""chars AS (
    SELECT id, i, c, lag(c, 1) OVER w AS p1, lag(c, 2) OVER w AS p2, lag(c, 3) OVER w AS p3,
           lead(c, 1) OVER w AS n1, lead(c, 2) OVER w AS n2, lead(c, 3) OVER w AS n3
    FROM (SELECT id, unnest(string_split(t, '')) AS c, generate_subscripts(string_split(t, ''), 1) AS i
          FROM {source} WHERE t <> '')
    WINDOW w AS (PARTITION BY id ORDER BY i)),
  ends AS (
    SELECT id, i - 1 AS e, i + 1 AS nxt FROM chars WHERE c = ' '
    UNION ALL
    SELECT id, i, i + 1 FROM chars WHERE c = '-' AND regexp_matches(p1, '[\\p{{L}}_]')
      AND (regexp_matches(p2, '[\\p{{L}}_]') OR (p2 = '-' AND regexp_matches(p3, '[\\p{{L}}_]')))
      AND regexp_matches(n1, '[\\p{{L}}_]')
      AND (regexp_matches(n2, '[\\p{{L}}_]') OR (n2 = '-' AND regexp_matches(n3, '[\\p{{L}}_]')))
    UNION ALL
    SELECT id, length(t), length(t) + 1 FROM {source} WHERE t <> ''),
  walk AS (
    SELECT id, 0 AS k, CAST(1 AS BIGINT) AS s, max(e) AS e, max(nxt) AS nxt
      FROM ends WHERE e <= 1100 GROUP BY id
    UNION ALL
    SELECT w.id, w.k + 1, w.nxt, max(b.e), max(b.nxt)
      FROM walk w JOIN ends b ON b.id = w.id AND b.e BETWEEN w.nxt AND w.nxt + 1099
      GROUP BY w.id, w.k, w.nxt),
  chunked AS (
    SELECT w.id, w.k, substr(t, w.s, w.e - w.s + 1) AS chunk FROM walk w JOIN {source} USING (id))"""


_LEAD = sql_strip("regexp_extract(chunk, '^(.*?[.!?])(?:\\s|$)|^(.*)$', 0)")
SQL_SUMMED = f"""summed AS (
    SELECT id, {sql_strip("string_agg(" + _LEAD + ", ' ' ORDER BY k)")} AS summary
    FROM chunked GROUP BY id)"""


def sql_terms(source: str) -> str:
    """CTE ``terms(id, term, tf)`` from ``source(id, base)``."""
    return f"""terms AS (
    SELECT id, term, count(*) AS tf FROM (
      SELECT id, unnest(list_filter(regexp_split_to_array(lower(base), '{WORD_GAP}'),
             lambda x: length(x) >= 2 AND NOT list_contains({_STOP}, x))) AS term FROM {source})
    GROUP BY id, term)"""


SQL_TOP = """kw AS (
    SELECT id, string_agg(term, ', ' ORDER BY tf DESC, term) AS keywords FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY tf DESC, term) AS k FROM terms)
    WHERE k <= 5 GROUP BY id)"""


def sql_sentiment(source: str) -> str:
    """CTE ``felt(id, sentiment)`` from ``source(id, base)``."""
    weight = "CASE w " + " ".join(f"WHEN '{w}' THEN {v}" for w, v in WEIGHTS.items()) + " ELSE 0.0 END"
    head = sql_strip("base")
    return f"""felt AS (
    SELECT id, CASE WHEN blank THEN 'unknown' WHEN total > 0 THEN 'positive'
      WHEN total < 0 THEN 'negative' ELSE 'neutral' END AS sentiment
    FROM (SELECT id, {sql_strip('base')} = '' AS blank,
      list_sum(list_transform(regexp_split_to_array(lower({head}), '{WORD_GAP}'), lambda w: {weight})) AS total
      FROM {source}))"""


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))


_TEXTS = f"texts AS (SELECT doc_id AS id, {sql_clean('text')} AS t FROM documents)"
_BASES = "bases AS (SELECT doc_id AS id, text AS base FROM documents)"


def chunks(spark, sf_dir):
    return M.chunk_table(_documents(spark, sf_dir), ["doc_id"]).select("doc_id", big("chunk_pos"), "chunk")


def chunk_invariants(spark, sf_dir):
    """Characters other than blanks survive the wrapping, and no chunk is too long."""
    rows = M.chunk_table(_documents(spark, sf_dir), ["doc_id"])
    solid = F.length(F.replace("chunk", F.lit(" "), F.lit("")))
    return rows.groupBy("doc_id").agg(
        F.sum(solid).alias("solid_chars"), (F.max(F.length("chunk")) <= 1100).alias("fits")
    )


def summaries(spark, sf_dir):
    return M.summarize_in_rows(_documents(spark, sf_dir)).select("doc_id", "summary")


def _echo_model():
    """A stand-in for a summariser that shows which texts it was given."""
    return lambda texts: [f"<{t.replace(' ', '_')}>" for t in texts]


def model_summaries(spark, sf_dir):
    """The batched model path with its regrouping, through a stand-in model."""
    return M.summarize_with_model(_documents(spark, sf_dir), ["doc_id"], model_column(_echo_model), spread=16)


def sentiment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", lexicon_label(F.col("text"), WEIGHTS).alias("sentiment"))


def keywords_tf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", K.joined_keywords(K.frequent_terms(F.col("text"))).alias("keywords"))


def keywords_tfidf(spark, sf_dir):
    return K.tfidf_keywords(_documents(spark, sf_dir), ["doc_id"])


def top_keywords(spark, sf_dir):
    """Top terms of a source from the term table of its documents."""
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", F.col("text").alias("content"))
    terms = K.term_table(docs, ["source", "doc_id"]).groupBy("source", "term").agg(F.sum("tf").alias("tf"))
    return ranked_join(terms, ["source"], "term", [F.desc("tf"), F.col("term")], 5)


def _letters():
    """A small deterministic embedder: counts of the letters a to z."""

    def embed(texts):
        rows = np.zeros((len(texts), 26))
        for row, text in zip(rows, texts):
            codes = np.frombuffer(text.lower().encode("ascii", "ignore"), dtype=np.uint8)
            letters = codes[(codes >= 97) & (codes <= 122)] - 97
            row += np.bincount(letters, minlength=26)
        return rows

    return embed


def keywords_similar(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", K.joined_keywords(K.similar_terms(F.col("text"), _letters)).alias("keywords")
    )


_SIMILAR = f"""WITH letters AS (SELECT chr(CAST(96 + i AS INTEGER)) AS l FROM range(1, 27) t(i)),
  {_BASES}, {sql_terms('bases')},
  words AS (SELECT DISTINCT term FROM terms),
  word_parts AS (SELECT term, l, length(term) - length(replace(term, l, '')) AS n FROM words, letters),
  doc_parts AS (SELECT id, l, length(base) - length(replace(base, l, '')) AS n
                FROM (SELECT id, lower(base) AS base FROM bases), letters),
  word_norm AS (SELECT term, sqrt(sum(n * n)) AS size FROM word_parts GROUP BY term),
  doc_norm AS (SELECT id, sqrt(sum(n * n)) AS size FROM doc_parts GROUP BY id),
  dots AS (SELECT t.id, t.term, sum(w.n * d.n) AS dot FROM terms t
           JOIN word_parts w ON w.term = t.term AND w.n > 0
           JOIN doc_parts d ON d.id = t.id AND d.l = w.l GROUP BY t.id, t.term),
  scored AS (SELECT t.id, t.term, round(coalesce(dot / nullif(a.size * b.size, 0), 0.0), 6) AS score
             FROM terms t LEFT JOIN dots USING (id, term) JOIN word_norm a ON a.term = t.term
             JOIN doc_norm b ON b.id = t.id),
  best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, term) AS k FROM scored),
  kw AS (SELECT id, string_agg(term, ', ' ORDER BY k) AS keywords FROM best WHERE k <= 5 GROUP BY id)
SELECT doc_id, coalesce(keywords, '') AS keywords FROM documents LEFT JOIN kw ON kw.id = doc_id"""


def cosine_topk(spark, sf_dir):
    """The vectors closest to the mean vector of their label, every vector a candidate."""
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("vector")
    )
    best = K.cosine_top_k(rows, K.mean_vector(rows, ["label"]), ["label"], "vec_id")
    return best.select(big("label"), "vec_id", "score", big("rank"))


_COSINE = """WITH cells AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i,
      CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
  means AS (SELECT label, i, round(avg(v), 9) AS m FROM cells GROUP BY label, i),
  scored AS (SELECT label, vec_id, round(sum(v * m) / (sqrt(sum(v * v)) * sqrt(sum(m * m))), 6) AS score
    FROM cells JOIN means USING (label, i) GROUP BY label, vec_id)
SELECT CAST(label AS BIGINT) AS label, vec_id, score, rank FROM (SELECT *, row_number() OVER (
  PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5"""


def sentiment_stats(spark, sf_dir):
    rows = news(spark, sf_dir).join(labelled(spark, sf_dir), "doc_id", "left")
    ratios = S.sentiment_stats(rows)
    names = [c for c in ratios.columns if c.startswith("sentiment")]
    return ratios.select(
        "ticker", day("date").alias("date"), *[F.col(n).cast("double").alias(n) for n in names]
    )


def _ratio(condition: str) -> str:
    return (
        f"CAST(CAST(coalesce(avg(CASE WHEN sentiment IS NOT NULL THEN {condition} END), 0) "
        "AS DECIMAL(5,4)) AS DOUBLE)"
    )


def keyword_count(spark, sf_dir):
    rows = news(spark, sf_dir).select(
        "ticker", "date", K.frequent_terms(F.col("content")).alias("keywords")
    )
    return S.keyword_counts(rows).select(
        "ticker", day("date").alias("date"), big("keywords"), big("different")
    )


def _failing_model():
    """A stand-in for a labeller that cannot read some texts."""

    def predict(texts):
        bad = [t for t in texts if t.count("e") % 5 == 0]
        if bad:
            raise ValueError(f"no label for {len(bad[0])} characters")
        return [" POSITIVE" if t.count("e") % 2 else "negative " for t in texts]

    return predict


def model_errors(spark, sf_dir):
    """Labels of a model that fails on some texts: an error is the value of its text only."""
    label = model_label(F.col("text"), model_column(_failing_model))
    return table(spark, sf_dir, "documents").select("doc_id", label.alias("sentiment"))


def _out(results):
    return results.select(
        "ticker", day("date").alias("date"), "url", "summary", "sentiment", "keywords"
    )


def analyze_news(spark, sf_dir):
    """Positions of two runs repeat, so that run and URL decide between some articles."""
    return _out(analyze(two_runs(news(spark, sf_dir)), backends=BACKENDS))


SQL_ANALYZED = f"""kept AS (SELECT doc_id AS id, * FROM news WHERE {sql_strip('content')} <> ''),
  texts AS (SELECT id, {sql_clean('content')} AS t FROM kept),
  {sql_chunks('texts')},
  {SQL_SUMMED},
  bases AS (SELECT k.id, coalesce(nullif(summary, ''), {sql_strip('content')}) AS base
            FROM kept k LEFT JOIN summed USING (id)),
  {sql_sentiment('bases')},
  {sql_terms('bases')},
  {SQL_TOP},
  analyzed AS (SELECT k.ticker, k.date, k.url, k.pos, coalesce(summary, '') AS summary, sentiment,
      coalesce(keywords, '') AS keywords
    FROM kept k LEFT JOIN summed USING (id) JOIN felt USING (id) LEFT JOIN kw USING (id))"""


def analysis_backfill(spark, sf_dir):
    """Pending days only: outputs are older than the inputs or missing, by language."""
    rows = news(spark, sf_dir)
    catalog = partition_stats(rows.filter("lang = 'en'"), "doc_id")
    outputs = partition_stats(rows.filter("lang <> 'en'"), "doc_id")
    earlier = rows.filter("lang = 'de'").select(
        "ticker", "date", "url", "pos", F.lit("earlier").alias("summary"),
        F.lit("unknown").alias("sentiment"), F.lit("").alias("keywords"),
    )
    return _out(backfill(rows, catalog, outputs, earlier, BACKENDS))


_BACKFILL = f"""WITH RECURSIVE {NEWS},
  ins AS (SELECT ticker, date, max(doc_id) AS m FROM news WHERE lang = 'en' GROUP BY ticker, date),
  outs AS (SELECT ticker, date, max(doc_id) AS m FROM news WHERE lang <> 'en' GROUP BY ticker, date),
  chosen AS (SELECT ins.ticker, ins.date FROM ins LEFT JOIN outs USING (ticker, date)
             WHERE outs.m IS NULL OR ins.m > outs.m),
  {SQL_ANALYZED},
  merged AS (
    SELECT ticker, date, url, pos, 'earlier' AS summary, 'unknown' AS sentiment, '' AS keywords, 0 AS src
    FROM news WHERE lang = 'de'
    UNION ALL SELECT ticker, date, url, pos, summary, sentiment, keywords, 1 FROM analyzed)
SELECT ticker, strftime(date, '%Y-%m-%d') AS date, url, summary, sentiment, keywords FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, date, summary ORDER BY src, pos) AS k
  FROM merged SEMI JOIN chosen USING (ticker, date)) WHERE k = 1"""

QUERIES = {
    "chunks": (
        chunks,
        f"WITH RECURSIVE {_TEXTS}, {sql_chunks('texts')} SELECT id AS doc_id, CAST(k AS BIGINT) AS chunk_pos, chunk FROM chunked",
    ),
    "chunk_invariants": (
        chunk_invariants,
        f"WITH {_TEXTS} SELECT id AS doc_id, length(replace(t, ' ', '')) AS solid_chars, true AS fits FROM texts WHERE t <> ''",
    ),
    "summaries": (
        summaries,
        f"WITH RECURSIVE {_TEXTS}, {sql_chunks('texts')}, {SQL_SUMMED} SELECT t.id AS doc_id, coalesce(summary, '') AS summary FROM texts t LEFT JOIN summed s ON s.id = t.id",
    ),
    "model_summaries": (
        model_summaries,
        f"""WITH RECURSIVE {_TEXTS}, {sql_chunks('texts')}, summed AS (SELECT id,
        {sql_strip("string_agg('<' || replace(chunk, ' ', '_') || '>', ' ' ORDER BY k)")} AS summary FROM chunked GROUP BY id)
        SELECT t.id AS doc_id, coalesce(summary, '') AS summary FROM texts t LEFT JOIN summed s ON s.id = t.id""",
    ),
    "sentiment": (
        sentiment,
        f"WITH {_BASES}, {sql_sentiment('bases')} SELECT id AS doc_id, sentiment FROM felt",
    ),
    "keywords_tf": (
        keywords_tf,
        f"""WITH {_BASES}, {sql_terms('bases')}, {SQL_TOP}
        SELECT doc_id, coalesce(keywords, '') AS keywords FROM documents LEFT JOIN kw ON kw.id = doc_id""",
    ),
    "keywords_tfidf": (
        keywords_tfidf,
        f"""WITH {_BASES}, {sql_terms('bases')},
        freq AS (SELECT term, count(*) AS df FROM terms GROUP BY term),
        scored AS (SELECT id, term, round(tf * (ln((SELECT count(*) + 1 FROM documents) / (df + 1)) + 1), 6) AS tf
                   FROM terms JOIN freq USING (term)),
        best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tf DESC, term) AS k FROM scored)
        SELECT id AS doc_id, string_agg(term, ', ' ORDER BY k) AS keywords FROM best WHERE k <= 5 GROUP BY id""",
    ),
    "top_keywords": (
        top_keywords,
        f"""WITH bases AS (SELECT source AS id, text AS base FROM documents), {sql_terms('bases')}, {SQL_TOP}
        SELECT id AS source, keywords FROM kw""",
    ),
    "keywords_similar": (keywords_similar, _SIMILAR),
    "cosine_topk": (cosine_topk, _COSINE),
    "sentiment_stats": (
        sentiment_stats,
        f"""WITH {NEWS}, {LABELLED} SELECT ticker, strftime(date, '%Y-%m-%d') AS date,
        {_ratio("CASE sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END")} AS sentiment_avg,
        {_ratio("CASE WHEN sentiment = 'positive' THEN 1 ELSE 0 END")} AS sentiment_positive_ratio,
        {_ratio("CASE WHEN sentiment = 'negative' THEN 1 ELSE 0 END")} AS sentiment_negative_ratio,
        {_ratio("CASE WHEN sentiment = 'neutral' THEN 1 ELSE 0 END")} AS sentiment_neutral_ratio
        FROM news LEFT JOIN labelled USING (doc_id) GROUP BY ticker, news.date""",
    ),
    "keyword_count": (
        keyword_count,
        f"""WITH {NEWS}, {_BASES}, {sql_terms('bases')},
        best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tf DESC, term) AS k FROM terms),
        per_day AS (SELECT ticker, date, count(term) AS keywords, count(DISTINCT term) AS different
          FROM news LEFT JOIN (SELECT * FROM best WHERE k <= 5) b ON b.id = doc_id GROUP BY ticker, date)
        SELECT ticker, strftime(date, '%Y-%m-%d') AS date, keywords, different FROM per_day""",
    ),
    "model_errors": (
        model_errors,
        f"""SELECT doc_id, CASE WHEN head = '' THEN 'unknown'
          WHEN (length(head) - length(replace(head, 'e', ''))) % 5 = 0 THEN 'error: no label for ' || length(head) || ' characters'
          WHEN (length(head) - length(replace(head, 'e', ''))) % 2 = 1 THEN 'positive' ELSE 'negative' END AS sentiment
        FROM (SELECT doc_id, substr({sql_strip('text')}, 1, 512) AS head FROM documents)""",
    ),
    "analyze_news": (
        analyze_news,
        f"""WITH RECURSIVE {NEWS}, {SQL_ANALYZED}
        SELECT ticker, strftime(date, '%Y-%m-%d') AS date, url, summary, sentiment, keywords FROM (
          SELECT *, row_number() OVER (PARTITION BY ticker, date, summary ORDER BY pos % 2, pos % 7, url) AS k FROM analyzed)
        WHERE k = 1""",
    ),
    "analysis_backfill": (analysis_backfill, _BACKFILL),
}
