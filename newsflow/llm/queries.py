"""One query per operator over its whole table, next to its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_personal_data(spark, sf_dir):
    from newsflow.llm import personal_data

    return personal_data.report(personal_data.find_personal_data(table(spark, sf_dir, "documents")))


def op4_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from newsflow.llm import bpe

    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_secrets(spark, sf_dir):
    from newsflow.llm import secrets

    return secrets.report(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op6_decontaminate(spark, sf_dir):
    from newsflow.llm import decontaminate

    return decontaminate.digest(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(13, len(words)) AS k, array_to_string(words[i : i + least(13, len(words)) - 1], ' ') AS win
  FROM (SELECT item, words, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS i FROM b WHERE len(words) > 0)),
dw AS (
  SELECT doc_id, k, i, array_to_string(words[i : i + k - 1], ' ') AS win
  FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i
        FROM w, (SELECT DISTINCT k FROM bw))),
hits AS (SELECT doc_id, item, i, k FROM dw JOIN bw USING (k, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""


def op7_token_counts(spark, sf_dir):
    import public_tokenizers

    from newsflow.llm import token_counts

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_language_model(spark, sf_dir):
    from newsflow.llm import language_model

    return language_model.score_texts(table(spark, sf_dir, "documents"))


def op8_vector_dedup(spark, sf_dir):
    from newsflow.llm import vector_dedup

    return vector_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY x),
n AS (SELECT x AS vec_id, count(*) AS n_links FROM l GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)"""


def op9_quality(spark, sf_dir):
    from newsflow.llm import quality

    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_substrings(spark, sf_dir):
    from newsflow.llm import substrings

    return substrings.repeated_words_digest(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(words[i : i + 19], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w)),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM win)
  WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (
  SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.p) AS kept, count(*) AS n
  FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def op1_near_dedup(spark, sf_dir):
    from newsflow.llm import near_dedup

    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).withColumn("kept", F.col("doc_id") == F.col("class_id"))


def op11_centroid_clusters(spark, sf_dir):
    from newsflow.llm import centroids

    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def _nearest_sql(centroids: str) -> str:
    """Every vector with ``16 * distance + number`` of its nearest centroid."""
    distance = "list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"(SELECT r, e, min(d * 16 + c) AS m FROM (SELECT v.r, v.e, c.c, {distance} AS d FROM v, {centroids} c) GROUP BY r, e)"


def _round_sql(i: int) -> str:
    return f"""
s{i} AS (SELECT c, dim, sum(x) AS s, count(*) AS n
         FROM (SELECT m % 16 AS c, unnest(e) AS x, unnest(range(64)) AS dim FROM {_nearest_sql(f"c{i - 1}")}) GROUP BY c, dim),
c{i} AS (SELECT o.c, coalesce(m.e, o.e) AS e FROM c{i - 1} o LEFT JOIN
         (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY dim) AS e FROM s{i} GROUP BY c) m USING (c)),"""


OP11_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), e) - 1 AS c, e FROM v WHERE vec_id IS NOT NULL QUALIFY c < 16),
{_round_sql(1)}{_round_sql(2)}{_round_sql(3)}
last AS (SELECT r, CAST(m % 16 AS INTEGER) AS cluster, CAST(m // 16 AS BIGINT) AS distance FROM {_nearest_sql("c3")})
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c3.e, ',')) AS centroid_sha256
FROM last JOIN v USING (r) JOIN c3 ON c3.c = cluster"""


def op12_manifest(spark, sf_dir):
    from newsflow.llm import manifest

    return manifest.check_tampering(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE
doc AS (
  SELECT doc_id, lang, row_number() OVER () AS r, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, text,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
             lambda acc, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(acc, b)),
             4294967295), 4294967295) AS crc
  FROM documents),
leaf AS (
  SELECT doc_id, lang, r, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || CASE WHEN crc % 3 = 0 THEN coalesce(strlen(low) || ':' || low, '-') ELSE coalesce(strlen(text) || ':' || text, '-') END) AS claim
  FROM doc),
tree AS (SELECT lang, n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM (SELECT lang, count(*) AS n FROM leaf GROUP BY lang)),
placed AS (
  SELECT l.*, t.tree, t.n, row_number() OVER (PARTITION BY t.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM leaf l JOIN tree t ON l.lang IS NOT DISTINCT FROM t.lang),
node AS (
  SELECT tree, 0 AS level, idx, leaf AS h, n FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8 FROM node WHERE n > 1 GROUP BY tree, level, idx // 8, n),
upper AS (
  SELECT -1 AS tree, 0 AS level, tree AS idx, h, (SELECT count(*) FROM tree) AS n FROM node WHERE n = 1
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8 FROM upper WHERE n > 1 GROUP BY tree, level, idx // 8, n),
run AS (
  SELECT tree, level, idx // 8 AS idx, list(h ORDER BY idx) AS hs, (n + 7) // 8 AS n
  FROM (FROM node UNION ALL FROM upper) WHERE n > 1 GROUP BY tree, level, idx // 8, n),
climb AS (
  SELECT r, 0 AS step, claim AS h, '' AS proof, CASE WHEN n = 1 THEN -1 ELSE tree END AS tree, 0 AS level, CASE WHEN n = 1 THEN tree ELSE idx END AS idx
  FROM placed
  UNION ALL
  SELECT c.r, c.step + 1, sha256(array_to_string(hs[1 : c.idx % 8], '') || c.h || array_to_string(hs[c.idx % 8 + 2 : 8], '')),
         c.proof || array_to_string(hs[1 : c.idx % 8], '') || array_to_string(hs[c.idx % 8 + 2 : 8], ''),
         CASE WHEN n = 1 THEN -1 ELSE c.tree END,
         CASE WHEN n = 1 AND c.tree >= 0 THEN 0 ELSE c.level + 1 END,
         CASE WHEN n = 1 AND c.tree >= 0 THEN c.tree ELSE run.idx END
  FROM climb c JOIN run ON run.tree = c.tree AND run.level = c.level AND run.idx = c.idx // 8),
ended AS (SELECT r, arg_max(h, step) AS h, arg_max(proof, step) AS proof FROM climb GROUP BY r)
SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM placed p JOIN ended e USING (r) JOIN node s ON s.tree = p.tree AND s.n = 1 JOIN upper t ON t.n = 1"""


def op13_piece_bpe(spark, sf_dir):
    import public_tokenizers

    from newsflow.llm import piece_bpe

    return piece_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_near_dedup": (op1_near_dedup, None),
    "op2_language_model": (op2_language_model, None),
    "op3_personal_data": (op3_personal_data, None),
    "op4_byte_bpe": (op4_byte_bpe, None),
    "op5_secrets": (op5_secrets, None),
    "op6_decontaminate": (op6_decontaminate, OP6_SQL),
    "op7_token_counts": (op7_token_counts, None),
    "op8_vector_dedup": (op8_vector_dedup, OP8_SQL),
    "op9_quality": (op9_quality, None),
    "op10_substrings": (op10_substrings, OP10_SQL),
    "op11_centroid_clusters": (op11_centroid_clusters, OP11_SQL),
    "op12_manifest": (op12_manifest, OP12_SQL),
    "op13_piece_bpe": (op13_piece_bpe, None),
}
